"""Operator 12: Merkle manifest of a document table by nested-struct rollup.

Every row is a leaf.  Within a source the leaves are ranked by doc_id; the
base-3 digits of the rank become columns, and blocks of ``ARITY ** levels``
leaves are grouped by (source, block, digits), one digit fewer each time: the
nodes that share the remaining digits become the child structs of their
parent, whose digest is hashed from theirs.  The data is dealt by (source,
block) once, so the successive groupings need no further shuffle, and a row
never nests more than one block.  Block digests are the leaves of the next
round until one block is left per source, and the subroots of the sources are
rolled up in the same way.

Proofs come back down: a block meets the proof of its own digest by grouping
the two rows of one (source, block) key, then nested transforms walk from the
block's digest to its leaves, noting the siblings before and after each step,
and an explode gives one row per leaf.  No table is joined for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import crc32_sql, ranked, stage

ARITY = 3
LEVELS = 6
STEP = "array<struct<before:string,after:string>>"


def sha(text) -> Column:
    return F.sha2(text, 256)


def field(col) -> Column:
    """``-`` for a null, else UTF-8 byte count, colon and value."""
    s = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(doc_id, source, lang, n_chars, text) -> Column:
    return sha(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]))


def nest(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, block, n, digest, kids) of the blocks of ``nodes`` (tree, place, n, digest, item).

    ``place`` counts a tree's nodes from 0 and ``n`` is their number.  A level
    that has one node only is passed through unhashed, as its tree ends there.
    """
    digits = [f"g{j}" for j in range(levels, 0, -1)]
    cur = nodes.withColumn("block", F.floor(F.col("place") / F.lit(ARITY ** levels).cast("decimal(18,0)")).cast("long"))
    cur = cur.select("tree", "block", "n", *[
        F.pmod(F.floor(F.col("place") / F.lit(ARITY ** (j - 1)).cast("decimal(18,0)")), F.lit(ARITY)).cast("int").alias(f"g{j}")
        for j in range(levels, 0, -1)], F.struct("digest", "item").alias("node")).repartition("tree", "block")
    for j in range(1, levels + 1):
        child = F.struct(F.col(f"g{j}").alias("digit"), F.col("node").alias("node"))
        kids = F.transform(F.sort_array(F.collect_list(child)), lambda x: x["node"])
        grouped = cur.groupBy("tree", "block", "n", *digits[:levels - j]).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda x: x["digest"]), "")
        digest = F.when(F.col("n") > ARITY ** (j - 1), sha(joined)).otherwise(F.col("kids")[0]["digest"])
        cur = grouped.select("tree", "block", "n", *digits[:levels - j],
                             F.struct(digest.alias("digest"), F.col("kids")).alias("node"))
    return cur.select("tree", "block", "n", F.col("node.digest").alias("digest"), F.col("node.kids").alias("kids"))


def grow(nodes: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """The blocks of ``nodes``, of the block digests above them, and so on until every tree is one block."""
    size, rounds = ARITY ** levels, []
    while True:
        rounds.append(stage(nest(nodes, levels), f"{name}{len(rounds)}"))
        above = rounds[-1].where(F.col("n") > size)
        if above.isEmpty():
            return rounds
        nodes = above.select("tree", F.col("block").alias("place"),
                             F.ceil(F.col("n") / F.lit(size).cast("decimal(18,0)")).cast("long").alias("n"), "digest",
                             F.col("block").alias("item"))


def tops(rounds: list[DataFrame], levels: int) -> DataFrame:
    """(tree, round, digest) of every tree's last node."""
    last = [r.where(F.col("n") <= ARITY ** levels).select("tree", F.lit(i).alias("round"), "digest")
            for i, r in enumerate(rounds)]
    out = last[0]
    for d in last[1:]:
        out = out.unionAll(d)
    return out


def steps(kids, n, levels: int, above) -> Column:
    """(item, steps) of every leaf under ``kids``; ``steps`` from the leaf's level upwards, then ``above``."""
    digests = F.transform(kids, lambda x: x["digest"])

    def visit(x, i):
        join = lambda a: F.array_join(a, "")                                                     # noqa: E731
        step = F.struct(join(F.slice(digests, F.lit(1), i)).alias("before"),
                        join(F.slice(digests, i + 2, F.size(digests))).alias("after"))
        path = F.when(n > ARITY ** (levels - 1), F.concat(F.array(step), above)).otherwise(above)
        if levels == 1:
            return F.struct(x["item"].alias("item"), path.alias("steps"))
        return steps(x["kids"], n, levels - 1, path)

    found = F.transform(kids, visit)
    return found if levels == 1 else F.flatten(found)


def descend(rounds: list[DataFrame], uppers: DataFrame, levels: int, name: str) -> DataFrame:
    """(tree, item, steps, carry) of every leaf of ``rounds``.

    ``uppers`` (tree, round, steps, carry) has, for every tree, the proof of
    its last node and what its leaves shall carry.
    """
    coming = None
    for i in range(len(rounds) - 1, -1, -1):
        above = uppers.where(F.col("round") == i).select("tree", F.lit(0).cast("long").alias("block"), "steps", "carry")
        if coming is not None:
            above = above.unionAll(coming.select("tree", F.col("item").alias("block"), "steps", "carry"))
        both = rounds[i].select("tree", "block", "n", "kids").unionByName(above, allowMissingColumns=True)
        met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                                                  for c in ("n", "kids", "steps", "carry")])
        found = met.select("tree", "carry", F.explode(steps(F.col("kids"), F.col("n"), levels, F.col("steps"))).alias("leaf"))
        coming = found.select("tree", "leaf.item", "leaf.steps", "carry")
        if i:
            coming = stage(coming, f"{name}-down{i}")
    return coming


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Merkle manifest of ``docs`` (doc_id, source, lang, n_chars, text), with a proof and a tamper check of each row.

    Returns doc_id, leaf, subroot (of the row's source), root, steps (siblings
    before and after the path, from the leaf's level to the root's; a step
    without siblings has two empty texts), tampered_leaf (the leaf of the text
    without line feeds, where 2 divides the crc32 of the decimal doc_id, else
    the leaf), folded_root (tampered_leaf hashed up along the steps) and
    verified (folded_root equals root).

    A null field is written ``-``, so it differs from an empty text.  Rows
    without doc_id come first in their source and are not tampered with; rows
    of one doc_id are ordered by leaf, and equal rows are leaves of their own,
    whose places are interchangeable.  Texts of any length are hashed whole.
    An empty table gives an empty result; other columns are ignored.
    """
    doc_id, text = F.col("doc_id"), F.col("text").cast("string")
    rest = (F.col("source"), F.col("lang"), F.col("n_chars"))
    odd = (F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0) & text.contains("\n")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"), doc_id,
        leaf(doc_id, *rest, text).alias("digest"),
        F.when(odd, leaf(doc_id, *rest, F.replace(text, F.lit("\n"), F.lit("")))).alias("tampered"))
    item = F.struct("doc_id", F.col("digest").alias("leaf"), F.coalesce("tampered", "digest").alias("tampered"))
    nodes = ranked(rows, ["tree"], ["doc_id", "digest"]).select(
        "tree", (F.col("rank") - 1).alias("place"), F.col("total").alias("n"), "digest", item.alias("item"))
    sources = grow(nodes, levels, "merkle")
    subroots = ranked(tops(sources, levels).withColumn("all", F.lit("")), ["all"], ["tree"]).select(
        F.col("all").alias("tree"), (F.col("rank") - 1).alias("place"), F.col("total").alias("n"), "digest",
        F.struct("tree", "round", F.col("digest").alias("subroot")).alias("item"))
    whole = grow(subroots, levels, "merkle-top")
    roots = tops(whole, levels).select("tree", "round", F.array().cast(STEP).alias("steps"),
                                       F.struct(F.col("digest").alias("root")).alias("carry"))
    uppers = stage(descend(whole, roots, levels, "merkle-top").select(
        "item.tree", "item.round", "steps", F.struct("item.subroot", "carry.root").alias("carry")), "merkle-subroots")
    found = descend(sources, uppers, levels, "merkle")
    folded = F.aggregate("steps", F.col("item.tampered"), lambda acc, s: sha(F.concat(s["before"], acc, s["after"])))
    return found.select("item.doc_id", "item.leaf", "carry.subroot", "carry.root", "steps",
                        F.col("item.tampered").alias("tampered_leaf"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(steps_col) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return sha(F.array_join(F.transform(steps_col, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest_sql(table: str = "documents", depth: int = 13) -> str:
    """DuckDB twin of the query (up to ``3 ** depth`` leaves a source and as many sources)."""
    def f(c):
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    fields = " || ".join(f(c) for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [f"""
WITH RECURSIVE {crc32_sql(f"SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM {table} WHERE doc_id IS NOT NULL")},
base AS MATERIALIZED (
  SELECT doc_id, source, sha256({fields} || {f('text')}) AS leaf, CASE WHEN CAST(doc_id AS VARCHAR) IN (SELECT s FROM crcs WHERE crc % 2 = 0)
    THEN sha256({fields} || {f("replace(text, chr(10), '')")}) ELSE sha256({fields} || {f('text')}) END AS bad FROM {table}),
l0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM base),
n0 AS (SELECT source AS k, place AS p, leaf AS h FROM l0)"""]

    def climb(nodes):
        for j in range(1, depth + 1):
            parts.append(f"""{nodes}{j} AS MATERIALIZED (
  SELECT k, p // 3 AS p, CASE WHEN max(m) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE max(h) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY k) AS m FROM {nodes}{j - 1}) GROUP BY k, p // 3)""")

    def fold(rows, nodes):
        for j in range(1, depth + 1):
            parts.append(f"""{rows}{j} AS MATERIALIZED (
  SELECT r.* EXCLUDE (pos, proof, cur), r.pos // 3 AS pos, r.proof || s.bef || s.aft AS proof,
         CASE WHEN s.m > 1 THEN sha256(s.bef || r.cur || s.aft) ELSE r.cur END AS cur
  FROM {rows}{j - 1} r JOIN (
    SELECT x.k, x.p, max(x.m) AS m, coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p < x.p), '') AS bef,
           coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p > x.p), '') AS aft
    FROM (SELECT *, count(*) OVER (PARTITION BY k) AS m FROM {nodes}{j - 1}) x
    JOIN {nodes}{j - 1} y ON x.k IS NOT DISTINCT FROM y.k AND x.p // 3 = y.p // 3
    GROUP BY x.k, x.p) s ON r.k IS NOT DISTINCT FROM s.k AND r.pos = s.p)""")

    climb("n")
    parts.append(f"""t0 AS MATERIALIZED (
  SELECT '' AS k, k AS source, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS p, h FROM n{depth})""")
    climb("t")
    parts.append("a0 AS (SELECT doc_id, source AS k, leaf, place AS pos, '' AS proof, bad AS cur FROM l0)")
    fold("a", "n")
    parts.append(f"""b0 AS MATERIALIZED (
  SELECT a.doc_id, '' AS k, a.leaf, t.h AS subroot, t.p AS pos, a.proof, a.cur
  FROM a{depth} a JOIN t0 t ON a.k IS NOT DISTINCT FROM t.source)""")
    fold("b", "t")
    return ",\n".join(parts) + f"""
SELECT b.doc_id, b.leaf, b.subroot, t.h AS root, sha256(b.proof) AS proof_sha256, b.cur AS folded_root, b.cur = t.h AS verified
FROM b{depth} b CROSS JOIN t{depth} t"""
