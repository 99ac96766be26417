"""Operator 11: prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first ``d`` turns.  Its name is (conv_id,
depth): the smallest conversation that passes through it owns it, so names are
two integers and a conversation's rows give the path to every node it owns.

**Prefixes.**  Turns are hashed; within blocks of ``BLOCK`` turns each hash is
chained with the one before, and the chains' ends are chained over the blocks
in the same way, block by block, so that no conversation is read by one task.

**Rollup.**  The trie is a forest of parent edges whose node weight is the
number of conversations through the node; the weight below a node is then
known by counting rows.  A component's centroid is the lowest node that holds
more than half of its weight, and the nodes that hold more than half are just
the path from there to the component's top.  The centroid's total (its own
values and those of the components below it) is added along that path, the
component is split there, and the parts go on by themselves, each with at most
half of the weight.  Large components are split by Spark, all at once per
round, where a node finds its new component by looking up the path of its
owner one step below the centroid; components of at most ``small`` nodes are
finished in numpy, many per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import crc32_sql, groups, join_busy, ranked, stage

BLOCK = 64
SMALL = 4096
#: Nodes that a numpy batch gathers before it is solved.
GATHER = 200_000
#: Leading bits of conv_id that one piece of a list of members spans.
SPAN = 13


def rebuild(turns: DataFrame, modulus: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share first turns: (conv_id, turn, digest, n_bytes) and (conv_id, length).

    ``turns`` (conv_id, turn, role, text) of a conversation c become the first
    h turns of conversation ``c - c % modulus`` (all if there are fewer, none if
    it is absent), then c's own after its first h; h is the unsigned crc32 of
    the decimal c, modulo ``heads``.  Turns are ordered by turn, null first, and
    numbered from 1; turns of one number are ordered by digest, and repeated
    rows are turns of their own.  Rows without conv_id belong to no
    conversation.  A null role or text counts as empty.  The digest stands for
    role and text: only hashes are moved.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))                               # noqa: E731
    digest = F.sha2(F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), 256)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.substring(F.unhex(digest), 1, 16).alias("digest"),
        F.octet_length(text("text")).cast("long").alias("n_bytes"))
    own = stage(ranked(rows, ["conv_id"], ["turn", "digest"]), "turns")
    first = lambda c: F.crc32(c.cast("string").cast("binary")) % heads                            # noqa: E731
    base = lambda c: c - c % modulus                                                              # noqa: E731
    had = own.where("rank = 1").select("conv_id", "total")
    sizes = had.withColumn("h", first(F.col("conv_id"))).withColumn("base", base(F.col("conv_id"))) \
        .join(had.select(F.col("conv_id").alias("base"), F.col("total").alias("of_base")), "base", "left") \
        .withColumn("lead", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = stage(sizes.select("conv_id", "lead", (F.col("lead") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
                               .alias("length")), "conversations")
    after = join_busy(own.where(F.col("rank") > first(F.col("conv_id"))), convs.select("conv_id", "lead", "length"),
                      ["conv_id"], "length", own.count()).select(
        "conv_id", (F.col("rank") - first(F.col("conv_id")) + F.col("lead")).alias("turn"), "digest", "n_bytes")
    near = F.array(*[F.try_add(F.col("conv_id"), F.lit(k).cast("long")) for k in range(1 - modulus, modulus)])
    given = own.where(F.col("rank") < heads).where(F.col("conv_id") % modulus == 0) \
        .select(F.col("conv_id").alias("of"), F.explode(near).alias("conv_id"), F.col("rank").alias("turn"), "digest", "n_bytes") \
        .where((base(F.col("conv_id")) == F.col("of")) & (F.col("turn") <= first(F.col("conv_id")))) \
        .join(convs.select("conv_id"), "conv_id", "left_semi").drop("of")
    return after.unionByName(given), convs.select("conv_id", "length")


def chained(turns: DataFrame, block: int) -> DataFrame:
    """``turns`` (conv_id, turn from 1, digest, ...) with ``prefix``, a hash of all turns up to this one."""
    rest = [c for c in turns.columns if c not in ("conv_id", "turn", "digest")]
    at = F.floor((F.col("turn") - 1) / F.lit(block).cast("decimal(18,0)")).cast("long")
    item = F.struct("turn", "digest", *rest)
    by = turns.groupBy("conv_id", at.alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    link = lambda acc, x: F.array_append(acc, _hash(F.concat(F.element_at(acc, -1), x["digest"])))
    chain = F.aggregate("items", F.array(F.lit(bytes(16))), link)
    by = stage(by.withColumn("chain", F.slice(chain, F.lit(2), F.size("items"))), "blocks")
    rows = by.select("conv_id", "block", F.explode(F.arrays_zip("items", "chain")).alias("e")).select(
        "conv_id", "block", "e.items.*", F.col("e.chain").alias("prefix"))
    ends = by.where(F.size("items") == block).select(
        "conv_id", (F.col("block") + 1).alias("turn"), F.element_at("chain", -1).alias("digest"))
    far = rows.where("block > 0")
    if far.isEmpty():
        return rows.drop("block")
    before = chained(ends, block).select("conv_id", F.col("turn").alias("block"), F.col("prefix").alias("before"))
    far = far.join(before, ["conv_id", "block"]).withColumn("prefix", _hash(F.concat("before", "prefix")))
    return rows.where("block = 0").unionByName(far.drop("before")).drop("block")


def _hash(col) -> Column:
    return F.substring(F.unhex(F.sha2(col, 256)), 1, 16)


def members_digest(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) of ``ends`` (owner, depth, conv_id).

    The ids of one span of 2^13 values are joined to one text first; where a
    node has several spans, these texts are hashed in order as a stream."""
    pieces = stage(ends.groupBy("owner", "depth", F.shiftright("conv_id", SPAN).alias("span")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")), "ends")
    counts = pieces.groupBy("owner", "depth").agg(F.count("*").alias("n"), F.max("ids").alias("ids"))
    one = counts.where("n = 1").select("owner", "depth", F.sha2("ids", 256).alias("ends_sha256"))
    more = pieces.join(counts.where("n > 1").select("owner", "depth"), ["owner", "depth"], "left_semi") \
        .repartition("owner", "depth").sortWithinPartitions("owner", "depth", "span") \
        .select("owner", "depth", "ids").mapInArrow(_stream, "owner long, depth long, ends_sha256 string")
    return one.unionAll(more)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    last, state = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64()),
                                           pa.array([state.hexdigest()])], ["owner", "depth", "ends_sha256"])
    for b in batches:
        for owner, depth, ids in zip(*(c.to_pylist() for c in b.columns)):
            if last != (owner, depth):
                if last is not None:
                    yield out()
                last, state = (owner, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if last is not None:
        yield out()


def centroid_rollup(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the subtrees of a forest.

    ``parent`` is the index of each node's parent, its own at a top; ``weight``
    the positive weight of its subtree.  All components are split at their
    centroids at once, in log2(weight) rounds.
    """
    weight, out = weight.copy(), np.zeros_like(values)
    own = np.arange(len(parent))
    top = _tops(parent.copy())
    live = own
    while len(live):
        comp = top[live]
        on = 2 * weight[live] > weight[comp]
        path = live[on]
        order = np.lexsort((weight[path], top[path]))
        path = path[order]
        lowest = np.ones(len(path), bool)
        lowest[1:] = top[path[1:]] != top[path[:-1]]
        centre = np.full(len(parent), -1)
        centre[top[path[lowest]]] = path[lowest]
        g = centre[comp]
        # parts: what hangs below the centroid gets its own tops, the rest keeps the old one
        up = parent[live].copy()
        cut = (up == g) | (live == comp)
        up[cut] = live[cut]
        step = own.copy()
        step[live] = up
        step = _tops(step, live)
        below = (live == g) | (step[live] != comp)
        gained = np.zeros_like(values)
        np.add.at(gained, g[below], values[live[below]])
        above = path[~lowest]
        out[path] += gained[centre[top[path]]]
        weight[above] -= weight[centre[top[above]]]
        live = live[live != g]
        top[live] = step[live]
    return out


def _tops(step: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """Where following ``step`` ends, by pointer jumping."""
    live = np.arange(len(step)) if live is None else live
    while True:
        far = step[step[live]]
        if (far == step[live]).all():
            return step
        step[live] = far


VALUES = ["n_leaves", "saved_tokens"]
SUMS = "owner long, depth long, n_leaves long, saved_tokens long"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of whole components, which arrive sorted by component, gathered to batches."""
    def solve(held):
        t = pa.concat_tables(held)
        owner, depth, above, weight, a, b, comp, comp_d = (
            t[c].to_numpy() for c in ("owner", "depth", "above", "weight", *VALUES, "comp", "comp_depth"))
        # nodes in the order of their names; a parent is one depth less under its own owner
        ids, code = np.unique(np.concatenate((owner, above)), return_inverse=True)
        n, span = len(owner), int(depth.max()) + 2
        name, want = code[:n] * span + depth + 1, code[n:] * span + depth
        order = np.argsort(name, kind="stable")
        parent = order[np.minimum(np.searchsorted(name, want, sorter=order), n - 1)]
        is_top = (owner == comp) & (depth == comp_d)
        parent[is_top] = np.flatnonzero(is_top)
        sums = centroid_rollup(parent, weight, np.stack((a, b), 1))
        return pa.RecordBatch.from_arrays([pa.array(owner), pa.array(depth), pa.array(sums[:, 0].copy()),
                                           pa.array(sums[:, 1].copy())], ["owner", "depth", *VALUES])
    held, n = [], 0
    for t in groups(batches, ["comp", "comp_depth"]):
        held.append(t)
        n += t.num_rows
        if n >= GATHER:
            yield solve(held)
            held, n = [], 0
    if held:
        yield solve(held)


def rollup(nodes: DataFrame, path: DataFrame, small: int) -> DataFrame:
    """(owner, depth, sums of VALUES over the subtree) of ``nodes``.

    ``nodes``: owner, depth, above (owner of the parent), weight (of the
    subtree) and VALUES; ``path`` (conv_id, turn, owner): the nodes on the way
    of each conversation.  A component is named by its top.
    """
    key = ["comp", "comp_depth"]
    tops = nodes.where("above IS NULL").select("owner", "depth")
    first = tops.first()
    if first is None:                                     # no conversation, no node
        return nodes.select("owner", "depth", *VALUES)
    live = nodes.withColumn("comp", F.lit(first[0])).withColumn("comp_depth", F.lit(first[1])) \
        .withColumn("above", F.coalesce("above", "owner"))
    ready, sums, size = [], [], nodes.count()
    while True:
        live = stage(live, "components")
        parts = live.groupBy(*key).agg(F.count("*").alias("n"), F.max("weight").alias("whole"))
        large = stage(parts.where(F.col("n") > small), "large")
        n_large = large.count()
        near = _with(live, large, key, n_large)
        ready.append(near.where("n IS NULL").drop("n", "whole"))
        if n_large == 0:
            break
        split = near.where("n IS NOT NULL")
        on = F.col("weight") * 2 > F.col("whole")
        centre = split.where(on).groupBy(*key).agg(
            F.min(F.struct("weight", F.col("depth").alias("g_depth"), F.col("owner").alias("g"))).alias("c")) \
            .select(*key, "c.g", "c.g_depth", F.col("c.weight").alias("g_weight"))
        split = _with(split, centre, key, n_large)
        is_g = (F.col("owner") == F.col("g")) & (F.col("depth") == F.col("g_depth"))
        # the node one step below the centroid on the way to a node, if that way passes the centroid
        split = split.withColumn("look", F.when(F.col("depth") > F.col("g_depth"), F.col("owner"))) \
            .withColumn("look_at", F.col("g_depth") + 1)
        looks = split.where("look IS NOT NULL")
        ways = path.select(F.col("conv_id").alias("look"), F.col("turn").alias("look_at"), F.col("owner").alias("way"),
                           F.col("above").alias("way_above")).join(
            looks.groupBy("look", "look_at").agg(F.count("*").alias("met")), ["look", "look_at"])
        placed = stage(split.where("look IS NULL").withColumn("way", F.lit(None).cast("long")).withColumn("way_above", F.col("way"))
                       .unionByName(join_busy(looks, ways, ["look", "look_at"], "met", size))
                       .withColumn("below", F.coalesce(F.col("way_above") == F.col("g"), F.lit(False)))
                       .withColumn("is_g", is_g).withColumn("on", on).drop("look", "look_at"), "split")
        gained = placed.where("below OR is_g").groupBy(*key).agg(*[F.sum(v).alias(f"g_{v}") for v in VALUES])
        along = _with(placed.where("on"), gained, key, n_large)
        sums.append(stage(along.select("owner", "depth", *[F.col(f"g_{v}").alias(v) for v in VALUES]), "sums"))
        live = placed.where("NOT is_g").withColumns({
            "weight": F.when(F.col("on"), F.col("weight") - F.col("g_weight")).otherwise(F.col("weight")),
            "comp": F.when(F.col("below"), F.col("way")).otherwise(F.col("comp")),
            "comp_depth": F.when(F.col("below"), F.col("g_depth") + 1).otherwise(F.col("comp_depth"))}) \
            .select(*live.columns)
    rest = ready[0]
    for d in ready[1:]:
        rest = rest.unionByName(d)
    out = rest.repartition(*key).sortWithinPartitions(*key).mapInArrow(_solve, SUMS)
    for d in sums:
        out = out.unionByName(d)
    return out.groupBy("owner", "depth").agg(*[F.sum(v).alias(v) for v in VALUES])


def _with(rows: DataFrame, parts: DataFrame, key: list[str], n: int) -> DataFrame:
    """Left join of per-component facts; broadcast while there are at most 10,000 components."""
    return rows.join(F.broadcast(parts) if n <= 10_000 else parts, key, "left")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, small: int = SMALL) -> DataFrame:
    """Nodes of the prefix trie of ``turns`` (conv_id, turn, digest, n_bytes) of ``convs`` (conv_id, length).

    Turns are numbered from 1 without gaps; equal digests mean equal turns.  A
    conversation without turns ends in the root.  Returns per node conv_id
    (the smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves (childless nodes of the subtree, itself included),
    saved_tokens (over the subtree, members beyond the first times the bytes of
    the last text) and ends_sha256 (of the comma-joined ids of the members that
    end here, ascending).  Without conversations there is no node.
    """
    total = convs.agg(F.sum("length"), F.min("conv_id"), F.count("*")).first()
    length = convs.select("conv_id", "length", F.col("length").alias("met"))
    rows = stage(join_busy(chained(turns, block), length, ["conv_id"], "met", total[0] or 0)
                 .withColumn("below", F.col("length") - F.col("turn") + 1).drop("length", "digest"), "prefixes")
    nodes = stage(rows.groupBy("turn", "prefix").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.sum("below").alias("weight")), "nodes")
    names = nodes.select("turn", "prefix", F.col("conv_id").alias("owner"), "n_convs")
    owned = stage(join_busy(rows.select("conv_id", "turn", "prefix", "below"), names, ["turn", "prefix"], "n_convs",
                            total[0] or 0).select("conv_id", "turn", "owner", "below"), "owners")
    before = owned.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("owner").alias("above"))
    # a way needs its parent for the look-up; ways of the first turn start at the root
    path = stage(owned.where("turn > 1").join(before, ["conv_id", "turn"]).unionByName(
        owned.where("turn = 1").withColumn("above", F.lit(total[1]).cast("long"))), "path")
    named = nodes.select(F.col("conv_id").alias("owner"), F.col("turn").alias("depth"), "n_convs", "n_bytes", "weight") \
        .join(path.select(F.col("conv_id").alias("owner"), F.col("turn").alias("depth"), "above"), ["owner", "depth"])
    root = convs.agg(F.min("conv_id").alias("owner"), F.lit(0).cast("long").alias("depth"), F.count("*").alias("n_convs"),
                     F.lit(0).cast("long").alias("n_bytes"), F.sum(F.col("length") + 1).alias("weight"),
                     F.lit(None).cast("long").alias("above")).where("owner IS NOT NULL")
    named = stage(named.unionByName(root), "named")
    children = named.where("above IS NOT NULL").groupBy(F.col("above").alias("owner"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count("*").alias("n_children"))
    full = stage(named.join(children, ["owner", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                 "children")
    leaf = (F.col("n_children") == 0).cast("long")
    sums = rollup(full.select("owner", "depth", "above", "weight", leaf.alias("n_leaves"),
                              ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")), path, small)
    ends = owned.where("below = 1").select("owner", F.col("turn").alias("depth"), "conv_id").unionByName(
        convs.where("length = 0").select(F.lit(total[1]).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id"))
    return full.select("owner", "depth", "above", "n_convs", "n_children").join(sums, ["owner", "depth"]) \
        .join(members_digest(ends), ["owner", "depth"], "left") \
        .select(F.col("owner").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children",
                "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def trie_sql(table: str = "conversations", modulus: int = 5, heads: int = 9) -> str:
    """DuckDB twin of :func:`rebuild` and :func:`trie`."""
    return f"""
WITH RECURSIVE {crc32_sql(f"SELECT DISTINCT CAST(conv_id AS VARCHAR) AS s FROM {table} WHERE conv_id IS NOT NULL")},
hashed AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS b, sha256(
    octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM {table} WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS r, x, b FROM hashed),
had AS (SELECT c, max(r) AS n, c - c % {modulus} AS base, any_value(crc % {heads}) AS h
        FROM own JOIN crcs ON s = CAST(c AS VARCHAR) GROUP BY c),
conv AS MATERIALIZED (SELECT a.c, a.base, a.h, least(a.h, coalesce(z.n, 0)) AS lead FROM had a LEFT JOIN had z ON z.c = a.base),
turns AS MATERIALIZED (
  SELECT v.c, o.r - v.h + v.lead AS d, o.x, o.b FROM conv v JOIN own o ON o.c = v.c AND o.r > v.h
  UNION ALL SELECT v.c, o.r, o.x, o.b FROM conv v JOIN own o ON o.c = v.base AND o.r <= v.h),
prefixes AS MATERIALIZED (SELECT c, d, b, sha256(string_agg(x, '') OVER (PARTITION BY c ORDER BY d)) AS p FROM turns),
nodes AS MATERIALIZED (SELECT d, p, min(c) AS o, count(*) AS n, max(b) AS b FROM prefixes GROUP BY d, p),
path AS MATERIALIZED (
  SELECT c, d, o FROM prefixes JOIN nodes USING (d, p) UNION ALL SELECT c, 0, (SELECT min(c) FROM conv) FROM conv),
named AS MATERIALIZED (
  SELECT n.o, n.d, n.n, n.b, a.o AS above FROM nodes n JOIN path a ON a.c = n.o AND a.d = n.d - 1
  UNION ALL SELECT min(c), 0, count(*), 0, NULL FROM conv HAVING count(*) > 0),
child AS (SELECT above AS o, d - 1 AS d, count(*) AS k FROM named WHERE above IS NOT NULL GROUP BY ALL),
tree AS MATERIALIZED (SELECT n.*, coalesce(k, 0) AS k FROM named n LEFT JOIN child USING (o, d)),
sums AS (
  SELECT a.o, a.d, CAST(count_if(t.k = 0) AS BIGINT) AS leaves, CAST(sum((t.n - 1) * t.b) AS BIGINT) AS saved
  FROM tree t JOIN path a ON a.c = t.o AND a.d <= t.d GROUP BY a.o, a.d),
last AS (SELECT c, max(d) AS d FROM path GROUP BY c),
ends AS (SELECT o, d, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM last JOIN path USING (c, d) GROUP BY o, d)
SELECT o AS conv_id, CAST(d AS BIGINT) AS depth, above AS parent_conv_id, n AS n_convs, k AS n_children, leaves AS n_leaves,
       saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM tree JOIN sums USING (o, d) LEFT JOIN ends USING (o, d)"""
