"""Paper pipeline (pipeline A): drop-based cleaning, family labels, 60/20/20
split, quantile scaling fitted on train, persisted split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import LabelEncoder, label_family
from ..operators import clean as C
from ..operators.fitted import QuantileUniform
from ..operators.splits import paper_split
from ..session import cut_lineage
from ..sources.store import write_split


def clean_paper(df: DataFrame, features, label: str, day: str | None = None,
                std_threshold: float = 0.01, corr_threshold: float = 0.98):
    """C3 (drop every copy) -> C2 -> C1 -> C2 -> C7 -> C11 -> P4.
    Returns (frame with ``label_category``, kept features).  The rows that are left
    are written once; the statistics and the result read that table."""
    feats = list(features)
    keys = feats + [label] + ([day] if day else [])
    d = C.drop_all_copies(df, keys)
    d = C.drop_missing_rows(d, feats)
    d = cut_lineage(C.drop_inf_rows(d, feats))
    low = C.low_std_columns(d, feats, std_threshold)
    rest = [c for c in feats if c not in low]
    corr = C.correlated_column_list(d, rest, corr_threshold, "signed_earlier")
    keep = [c for c in rest if c not in corr]
    out = d.drop(*low, *corr).withColumn("label_category", label_family(label))
    return out, keep


def prepare_paper_split(df: DataFrame, features, key: str, path: str | None = None,
                        n_quantiles: int = 1000, seed: int = 42, balance: tuple[dict, dict] | None = None):
    """T4 split, C15 quantile scaling fitted on train only, P7 family codes; written
    with S10 when ``path`` is given.  ``balance``: (rows kept, rows grown to) per
    family; adds the part ``train_balanced`` (B9 on the scaled training rows)."""
    sp = paper_split(df, "label_category", key, seed=seed)
    scaler = QuantileUniform(inputCols=list(features), nQuantiles=n_quantiles).fit(sp.where("split = 'train'"))
    enc = LabelEncoder().fit(sp.where("split = 'train'"), "label_category")
    out = scaler.transform(sp).withColumn("label", enc.encode("label_category"))
    out = out.select(key, *features, "label", "split")
    if balance:
        code = {c: i for i, c in enumerate(enc.classes)}
        under, over = ({code[c]: n for c, n in part.items()} for part in balance)
        out = out.unionByName(balanced_part(out.where("split = 'train'"), features, key, under, over, seed))
    if path:
        write_split(out, path)
    return out, scaler, enc


def balanced_part(train: DataFrame, features, key: str, under: dict, over: dict, seed: int = 42) -> DataFrame:
    """The training rows under- and over-sampled (B9), as the part ``train_balanced``;
    synthetic rows carry the key of the row they grew from."""
    from ..operators.smote import under_then_smote
    grown = under_then_smote(train, "label", key, list(features), under, over, seed=seed)
    return grown.select(F.col("base_key").alias(key), *features, "label", F.lit("train_balanced").alias("split"))


def write_projected_split(split: DataFrame, features, key: str, path: str, target: float = 0.99):
    """Every part projected on the components that explain ``target`` of the
    training variance, written like the split itself; returns the fitted projection."""
    from ..operators.fitted import CentredPCA
    pca = CentredPCA(inputCols=list(features), k=0, target=target).fit(split.where("split = 'train'"))
    projected = pca.transform(split)
    names = [c for c in projected.columns if c not in split.columns]
    write_split(projected.select(key, *names, "label", "split"), path)
    return pca


def run_paper_pipeline(spark, data_path: str, out_path: str, seed: int = 42):
    """Paper pipeline end to end: read (snake-case names, repeated header
    dropped) -> C19 -> T4 split -> C15 scaling fitted on train -> S10 write."""
    from ..sources.flows import content_ids, read_flows
    df = read_flows(spark, data_path, names="snake", label="Label", add_day=False)
    df = content_ids(df, "row_id")
    feats = [c for c in df.columns if c not in ("label", "row_id")]
    cleaned, keep = clean_paper(df, feats, "label")
    return prepare_paper_split(cleaned, keep, "row_id", out_path, seed=seed)
