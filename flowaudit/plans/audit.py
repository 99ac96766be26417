"""Audit pipeline (pipeline B): EDA findings, duplicate audit, leakage-aware cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import LabelEncoder, binary_label
from ..functions.missing import replace_infs
from ..operators import clean as C
from ..operators import correlation as K
from ..operators import duplicates as U
from ..operators import profile as A
from ..operators.fitted import MedianImputer
from ..schema import FlowSchema
from ..session import cut_lineage


def clean_audit(df: DataFrame, schema: FlowSchema, fit_df: DataFrame | None = None):
    """C1 -> C5 -> C9 -> C10 -> P7 -> P5.

    Statistics (medians, constant and identical columns, the class list) are
    learned on ``fit_df`` - the training rows by default in the split
    experiments; ``fit_df=None`` fits on ``df`` itself (parity with the
    reference, which fits before splitting).  Returns (frame, constant
    columns, duplicate columns, encoder)."""
    feats = list(schema.features)
    cleaned = replace_infs(df, feats)
    # five statistics read the rows to fit on: written once, whatever they come from
    fit_src = cut_lineage(cleaned if fit_df is None else replace_infs(fit_df, feats))
    if fit_df is None:
        cleaned = fit_src
    imputer = MedianImputer(inputCols=feats).fit(fit_src)
    cleaned = imputer.transform(cleaned)
    fitted = imputer.transform(fit_src)
    constants = C.constant_column_list(fitted, feats)
    rest = [c for c in feats if c not in constants]
    duplicates = C.duplicate_column_list(fitted.select(*rest), rest)
    keep = [c for c in rest if c not in duplicates]
    enc = LabelEncoder().fit(fit_src, schema.label)
    out = cleaned.drop(*constants, *duplicates).withColumns({
        "multi_label": enc.encode(schema.label), "binary_label": binary_label(schema.label)})
    return out, constants, duplicates, enc, schema.with_features(keep)


def run_eda(df: DataFrame, schema: FlowSchema) -> dict[str, DataFrame]:
    """The EDA findings as tidy DataFrames."""
    feats = list(schema.features)
    return {
        "shape": A.shape(df, schema.label),
        "missing_values": A.missing_counts(df, only_positive=True),
        "infinite_values": A.inf_counts(df, feats),
        "constant_features": A.constant_columns(df, feats),
        "near_constant_features": A.near_constant_columns(df, feats),
        "duplicate_rows": U.exact_duplicate_count(df, schema),
        "class_distribution": A.label_counts(df, schema.label),
        "duplicate_columns": K.duplicate_column_pairs(df, feats),
    }


def duplicate_audit(df: DataFrame, schema: FlowSchema) -> dict:
    """U1-U6 as the reference's dictionary: counts plus per-day and per-class maps.
    The maps hold one entry per day / class (bounded)."""
    s = U.audit_summary(df, schema).first()
    per_day = {r[0]: r[1] for r in U.duplicates_by(df, schema, schema.day).collect()} if schema.day else {}
    per_cls = {r[0]: r[1] for r in U.duplicates_by(df, schema, schema.label).collect()}
    return {"exact_duplicates": s["exact_duplicates"], "feature_duplicates_ignoring_label": s["feature_duplicates"],
            "conflicting_label_vectors": s["conflicting_label_vectors"], "duplicates_per_day": per_day,
            "duplicates_per_class": per_cls}


def load_flows(spark, path: str, sample_frac: float = 1.0, seed: int = 42, min_class_rows: int = 6):
    """S1 + S2 + S4 + S6 + P1/P2 + P9 + T1: every CSV under ``path`` (names
    trimmed, day from the file name, labels normalised).  With ``sample_frac``
    below 1, classes of at most five rows are removed and a stratified sample
    of the rest is taken; 1.0 keeps every row.  ``row_id`` follows from the
    rows' contents (:func:`..sources.flows.content_ids`), so it does not
    depend on how files are split over tasks."""
    from ..operators.splits import stratified_sample
    from ..sources.flows import content_ids, read_flows
    df = read_flows(spark, path, names="strip", label="Label")
    df = content_ids(df, "row_id")
    if sample_frac < 1.0:
        df = C.filter_rare_classes(df, "Label", min_class_rows)
        df = stratified_sample(df, "Label", "row_id", sample_frac, seed)
    return df
