"""Training corpus from ``documents``: five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of their input.  A stage decides on the rows that its
predecessor kept and on nothing else (toxicity also reads ``labels``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowaudit.llm import harmonic_packing, minhash_dedup, mixing, suffix_dedup, toxicity
from flowaudit.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not find toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    return toxicity.score(scored, model).where("predicted = 0").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8): the one of least doc_id.

    Rows are told apart by a number of their own, so repeated rows, rows that
    share an id and rows without one (last in that order) count one by one;
    rows without words or text are in no group and stay."""
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = minhash_dedup.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), width=5, percent=80)
    members = rows.select("_row", "doc_id").join(found.select(F.col("doc_id").alias("_row"), "component_id"), "_row")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"]
    stays = members.groupBy("component_id").agg(least.alias("_row"))
    gone = members.select("_row").join(stays.select("_row"), "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that documents of smaller id hold; ``n_chars`` follows."""
    cut = suffix_dedup.drop_repeats(docs, whole_characters=True)
    text = F.col("kept").cast("string")
    new = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[new[c].alias(c) if c in new else F.col("rest")[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it, which may be never."""
    mixed = mixing.mix(docs, carry=True).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048."""
    return harmonic_packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("suffix_dedup", cut_repeats),
          ("mixing", mix_sources), ("packing", pack)]

#: Classifier, signatures and tokens are beyond SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
