"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table
from .exact_dedup import duplicates_sql
from .licenses import scan, scan_sql
from .merkle import manifest_sql
from .mixing import mix, mix_sql
from .prefix_trie import trie_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_minhash_near_dedup")
def op1(spark, sf_dir):
    from .minhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query("op8_suffix_array_dedup")
def op8(spark, sf_dir):
    from .suffix_dedup import drop_repeats
    out = drop_repeats(table(spark, sf_dir, "documents"), carry=False)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_mix_sources", sql=mix_sql())
def op4(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op9_harmonic_packing")
def op9(spark, sf_dir):
    from .harmonic_packing import pack
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def remainder(doc_id, n: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % n


@query("op6_toxicity")
def op6(spark, sf_dir):
    from .toxicity import fit, score
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), usable=lambda i: remainder(i, 4) != 2)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op3_quality_rules")
def op3(spark, sf_dir):
    from .quality import fit, judge
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))


@query("op5_language_id")
def op5(spark, sf_dir):
    from .language import fit, predict
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, usable=lambda i: remainder(i, 5) != 0)
    return predict(docs, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_license_scan", sql=scan_sql())
def op7(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2(spark, sf_dir):
    from .best_fit_packing import pack_matrix
    return pack_matrix(table(spark, sf_dir, "documents")).select(
        "sequence_id", "n_tokens", F.size("doc_ids").alias("n_segments"), F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"), "cu_seqlens", "doc_ids", "doc_starts")


@query("op10_hnsw_neighbours")
def op10(spark, sf_dir):
    from .hnsw import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op12_merkle_manifest", sql=manifest_sql())
def op12(spark, sf_dir):
    from .merkle import manifest, proof_digest
    return manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof_digest("steps").alias("proof_sha256"), "folded_root", "verified")


@query("op13_exact_dedup", sql=duplicates_sql())
def op13(spark, sf_dir):
    from .exact_dedup import duplicates
    return duplicates(table(spark, sf_dir, "documents"))


@query("op11_conversation_trie", sql=trie_sql())
def op11(spark, sf_dir):
    from .prefix_trie import rebuild, trie
    return trie(*rebuild(table(spark, sf_dir, "conversations")))
