"""Label expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import BENIGN, LABEL_FAMILIES

MAX_CLASSES = 10_000  # size bound for class lists pulled to the driver


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_label(c) -> Column:
    """P1."""
    return F.trim(_c(c))


def fix_label_typos(c) -> Column:
    """Any run of non-alphanumerics after 'Web Attack' becomes ' - '.

    Covers the double-blank form, the U+FFFD replacement character and the
    proper ' - ' alike."""
    return F.regexp_replace(_c(c), r"^Web Attack[^A-Za-z0-9]+", "Web Attack - ")


def ascii_scrub(c) -> Column:
    """U+FFFD -> '-', then drop every non-ASCII character."""
    return F.regexp_replace(F.replace(_c(c), F.lit("�"), F.lit("-")), r"[^\x00-\x7F]", "")


def normalise_label(c) -> Column:
    return fix_label_typos(trim_label(c))


def label_family(c, families: dict | None = None) -> Column:
    """Raw class -> family; an unmapped label raises at run time."""
    fam = families or LABEL_FAMILIES
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(fam.items())])
    c = _c(c)
    return F.coalesce(m[c], F.raise_error(F.concat(F.lit("unmapped label: "), c.cast("string"))))


def binary_label(c, benign: str = BENIGN) -> Column:
    """P5: 0 for benign, 1 for any attack."""
    return (_c(c) != F.lit(benign)).cast("int")


def binary_name(c, benign: str = BENIGN) -> Column:
    """P6."""
    return F.when(_c(c) == F.lit(benign), "Benign").otherwise("Attack")


def class_list(df: DataFrame, label: str) -> list:
    """Sorted distinct labels; the list is bounded by MAX_CLASSES (checked)."""
    rows = df.select(label).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return sorted(r[0] for r in rows if r[0] is not None)


class LabelEncoder:
    """Alphabetical dense codes 0..k-1, fitted on a DataFrame.

    Fitting pulls only the distinct labels (bounded, checked); the mapping is
    applied as a literal map, so no join is needed."""

    def __init__(self, classes: list | None = None):
        self.classes = list(classes) if classes is not None else None

    def fit(self, df: DataFrame, label: str) -> "LabelEncoder":
        self.classes = class_list(df, label)
        return self

    def encode(self, c) -> Column:
        m = F.create_map(*[F.lit(x) for x in chain.from_iterable(
            (k, i) for i, k in enumerate(self.classes))])
        return m[_c(c)]

    def decode(self, c) -> Column:
        """Inverse (IndexToString)."""
        return F.element_at(F.array(*[F.lit(x) for x in self.classes]), _c(c).cast("int") + 1)


def one_vs_rest(c, classes) -> Column:
    """Indicator array (y == class) over a known class list."""
    c = _c(c)
    return F.array(*[(c == F.lit(k)).cast("int") for k in classes])


def one_hot_drop_first(df: DataFrame, cols, max_levels: int = MAX_CLASSES) -> DataFrame:
    """One 0/1 column per level except the first (alphabetical), for the
    given categorical columns; levels are bounded and checked.  Numeric-only
    tables pass through unchanged (empty column list)."""
    out = df
    for c in cols:
        levels = class_list(df, c) if max_levels else []
        for lv in levels[1:]:
            out = out.withColumn(f"{c}_{lv}", (F.col(c) == F.lit(lv)).cast("double"))
        out = out.drop(c)
    return out
