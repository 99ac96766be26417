"""Operator 1: MinHash near-duplicates by a signature-coordinate inverted join.

1. Every document's distinct ``width``-word shingles give ``coords`` minima
   (one per seeded hash).  Documents with the same shingle set form one class,
   a single node of what follows.
2. A node's tokens are its (coordinate, value) pairs.  Two nodes are
   candidates if they collide in ``matches`` coordinates or more.  Tokens held
   by one node never collide and are not posted; a node with fewer than
   ``matches`` shared tokens has no partner at all.  Of the others only the
   prefix is posted: the ``shared - matches + 1`` rarest tokens, one of which
   any candidate pair must have in common.
3. First merge: every posting list is linked to its hub (the node with the
   most common tokens), and each link confirmed on the full shingle sets.
   One pair per posting, however large the list.
4. Second merge, skipping lists that are already one component: nodes outside
   the list's main component meet all other nodes of the list, in blocks of
   bounded size; collisions are counted on signatures, a pair is examined only
   at its first common posted token, and links are confirmed on full sets.
   A node stops being compared with a component once linked to it, since
   further links there cannot change the result.

The signature threshold is the only approximate step: for a pair at the link
threshold the chance of fewer than ``matches`` of ``coords`` collisions is
below 1e-5 with the defaults (85 of 100, 40 of 64), and lower for closer pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, groups, shuffle_width, stage
from .shingles import shingle_sets
from .textops import U64, column_bytes, mix64, sub_batches

COORDS, MATCHES = 64, 40
BLOCK = 2048
STEP = 1 << 20            # bytes of text hashed at once


def _multipliers(coords: int) -> np.ndarray:
    return mix64(np.arange(1, coords + 1, dtype=U64)) | U64(1)


def _signatures(hashes: np.ndarray, offsets: np.ndarray, coords: int) -> np.ndarray:
    """Minima of non-empty sets, one row per set."""
    out = np.empty((len(offsets) - 1, coords), np.uint32)
    for k, a in enumerate(_multipliers(coords)):
        out[:, k] = np.minimum.reduceat((hashes * a) >> U64(32), offsets[:-1]).astype(np.uint32)
    return out


def sketch(docs: DataFrame, width: int, coords: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the shingle set), sig; node and sig are null for an empty set."""
    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(1))
            for i, j in sub_batches(off, STEP):
                h, so = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)
                n = np.diff(so)
                full = np.flatnonzero(n)
                node = np.zeros(j - i, np.int64)
                sig = np.zeros((0, coords), np.uint32)
                if len(full):
                    node[full] = np.add.reduceat(mix64(h), so[full]).view(np.int64)
                    sig = _signatures(h, np.append(so[full], len(h)), coords)
                at = np.concatenate(([0], np.cumsum(np.where(n > 0, coords, 0)))).astype(np.int32)
                sigs = pa.ListArray.from_arrays(pa.array(at), pa.array(sig.ravel().view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)),
                     pa.array(node, mask=n == 0), sigs], ["doc_id", "n_shingles", "node", "sig"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_shingles long, node long, sig array<int>")


def _posted(nodes: DataFrame, matches: int) -> DataFrame:
    """node, posted (the prefix of its shared tokens, rarest first), weight (how common its tokens are).

    A token's order key is the bit length of its number of holders, then a
    hash; tokens whose keys coincide share a posting list, which costs time
    but loses nothing."""
    tokens = nodes.select("node", F.posexplode("sig").alias("k", "v")) \
        .select("node", F.xxhash64("k", "v").alias("token"))
    held = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    key = F.shiftleft(F.length(F.bin("held")).cast("long"), 57) + \
        F.col("token").bitwiseAND(F.lit((1 << 57) - 1))
    own = tokens.join(held, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(key)).alias("keys"), F.sum(F.log2("held")).alias("weight"))
    shared = F.size("keys")
    return own.where(shared >= matches).select(
        "node", F.slice("keys", F.lit(1), shared - (matches - 1)).alias("posted"),
        F.round("weight", 3).alias("weight"))


def _full_sets(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Adds each node's whole shingle set, recomputed from the text of its first document."""
    def run(batches):
        for batch in batches:
            buf, off = column_bytes(batch.column(batch.schema.get_field_index("text")))
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("node", "posted", "sig", "weight")]
            node = rest[0].to_numpy()
            for i, j in sub_batches(off, STEP):
                h, so = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)
                # a repeated doc_id may bring another text along: keep the node's own
                total = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(h), dtype=U64)))
                same = pa.array((total[so[1:]] - total[so[:-1]]).view(np.int64) == node[i:j])
                sets = pa.LargeListArray.from_arrays(pa.array(so), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in rest), sets.cast(pa.list_(pa.int64()))],
                                                 ["node", "posted", "sig", "weight", "shingles"]).filter(same)
    text = docs.select(F.col("doc_id").cast("long").alias("first_doc"), F.col("text").cast("string").alias("text"))
    return nodes.join(text, "first_doc") \
        .mapInArrow(run, "node long, posted array<long>, sig array<int>, weight double, shingles array<long>") \
        .dropDuplicates(["node"])


def _linked(sa, sb, percent: int):
    both = F.size(F.array_intersect(sa, sb)).cast("long")
    return 100 * both >= percent * (F.size(sa) + F.size(sb) - both)


def _hub_links(sets: DataFrame, postings: DataFrame, percent: int, matches: int) -> DataFrame:
    hubs = postings.groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    pairs = postings.join(hubs, "key").where("node != hub").select("node", "hub").distinct()
    one = sets.select("node", "sig", "shingles")
    two = sets.select(F.col("node").alias("hub"), F.col("sig").alias("sig_b"), F.col("shingles").alias("shingles_b"))
    hits = F.size(F.filter(F.zip_with("sig", "sig_b", lambda x, y: x == y), lambda x: x))
    return pairs.join(one, "node").join(two, "hub").where(hits >= matches) \
        .where(_linked(F.col("shingles"), F.col("shingles_b"), percent)) \
        .select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _block_links(percent: int, matches: int):
    """Links between nodes of different components within each (list, block, block) group."""
    def group(t: pa.Table):
        col = lambda c: t.column(c).combine_chunks()                          # noqa: E731
        node, comp, role = (col(c).to_numpy() for c in ("node", "component", "role"))
        main, key = col("main")[0].as_py(), col("key")[0].as_py()
        sig = col("sig").flatten().to_numpy().reshape(len(node), -1)
        posted, sets = col("posted"), col("shingles")
        p_at, p_val = posted.offsets.to_numpy(), posted.flatten().to_numpy()
        s_at, s_val = sets.offsets.to_numpy(), sets.flatten().to_numpy()
        p_at, s_at = p_at - p_at[0], s_at - s_at[0]
        earlier = p_val < key                       # a common one makes the pair another list's
        p_owner = np.repeat(np.arange(len(node)), np.diff(p_at))
        joined: dict[int, int] = {}

        def root(c):
            while c in joined:
                c = joined[c]
            return c

        target = (role & 1) == 1
        for x in np.flatnonzero(role & 2):
            ok = target & (comp != comp[x]) & ((comp == main) | (node > node[x]))
            ys = np.flatnonzero(ok)
            if not len(ys):
                continue
            hits = (sig[ys] == sig[x]).sum(axis=1)
            ys, hits = ys[hits >= matches], hits[hits >= matches]
            if not len(ys):
                continue
            mine = p_val[p_at[x]:p_at[x + 1]]
            seen = np.zeros(len(node), bool)
            seen[p_owner[earlier & np.isin(p_val, mine[mine < key])]] = True
            ys = ys[np.argsort(-hits, kind="stable")]
            ys = ys[~seen[ys]]
            own = s_val[s_at[x]:s_at[x + 1]]
            for y in ys:
                if root(comp[x]) == root(comp[y]):
                    continue
                other = s_val[s_at[y]:s_at[y + 1]]
                short, long = (own, other) if len(own) <= len(other) else (other, own)
                if 100 * len(short) < percent * len(long):
                    continue
                both = int(np.isin(short, long, assume_unique=True).sum())
                if 100 * both >= percent * (len(own) + len(other) - both):
                    joined[root(comp[x])] = root(comp[y])
                    yield int(node[x]), int(node[y])

    def run(batches):
        for t in groups(batches, ["key", "i", "j"]):
            found = list(group(t))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)],
                                                 ["a", "b"])
    return run


def _rest_links(sets: DataFrame, postings: DataFrame, label: DataFrame, percent: int, matches: int,
                block: int) -> DataFrame:
    here = postings.join(label, "node", "left") \
        .withColumn("component", F.coalesce("component", "node")).select("key", "node", "component")
    lists = here.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.sum("c").alias("n"), F.max("c").alias("most"), F.count("*").alias("parts"),
        F.max_by("component", F.struct("c", "component")).alias("main")).where("parts > 1") \
        .select("key", "main", F.ceil(F.col("n") / block).cast("int").alias("nt"),
                F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("nq"))
    rows = here.join(lists, "key").withColumn("asks", F.col("component") != F.col("main")) \
        .withColumn("t", F.pmod(F.xxhash64("node", F.lit(1)), F.col("nt")).cast("int")) \
        .withColumn("q", F.pmod(F.xxhash64("node", F.lit(2)), F.col("nq")).cast("int"))
    as_target = F.transform(F.sequence(F.lit(0), F.col("nq") - 1), lambda i: F.struct(
        i.alias("i"), F.col("t").alias("j"), F.when(F.col("asks") & (i == F.col("q")), 3).otherwise(1).alias("role")))
    as_query = F.transform(F.filter(F.sequence(F.lit(0), F.col("nt") - 1),
                                    lambda j: F.col("asks") & (j != F.col("t"))),
                           lambda j: F.struct(F.col("q").alias("i"), j.alias("j"), F.lit(2).alias("role")))
    dealt = rows.select("key", "main", "node", "component", F.explode(F.concat(as_target, as_query)).alias("x")) \
        .select("key", "main", "node", "component", "x.i", "x.j", "x.role")
    width = shuffle_width(sets.sparkSession)
    return dealt.join(sets.select("node", "sig", "posted", "shingles"), "node") \
        .repartition(width, "key", "i", "j").sortWithinPartitions("key", "i", "j") \
        .mapInArrow(_block_links(percent, matches), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, coords: int = COORDS,
                    matches: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: near-duplicate groups of ``docs`` (doc_id, text).

    Two documents are linked if 100 * |A & B| >= percent * |A | B| on their
    sets of ``width``-word shingles; ``component_id`` is the smallest doc_id
    reachable by links, ``kept`` marks that document.  Repeated rows each get
    a row.  Null or empty texts have no shingles, no links, and are kept as
    their own component.  A row without doc_id is linked with nothing: its
    component is null and it is kept.  An empty table gives an empty result;
    other columns are ignored.  Sets are held as 64-bit
    shingle hashes and classes as 64-bit hashes of the set.

    ``matches`` defaults to the count that a pair at the threshold misses with
    probability below about 1e-5.
    """
    if matches is None:
        p = percent / 100
        matches = max(1, int(coords * p - 5 * (coords * p * (1 - p)) ** 0.5))
    marked = stage(sketch(docs, width, coords), "sketch")
    nodes = stage(marked.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "nodes")
    posted = _posted(nodes, matches)
    sets = stage(_full_sets(nodes.join(posted, "node"), docs, width), "sets")
    postings = sets.select(F.explode("posted").alias("key"), "node", "weight")
    postings = stage(postings, "postings")
    links = stage(_hub_links(sets, postings, percent, matches), "links")
    rest = _rest_links(sets, postings, stage(components(links), "label"), percent, matches, block)
    label = components(links.unionAll(rest))
    # the smallest document of every component, then of every class that is not a lone document
    named = nodes.select("node", "first_doc", "copies").join(label, "node", "left") \
        .where("copies > 1 OR component IS NOT NULL") \
        .withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    ids = named.join(least, "component").select("node", "component_id")
    return marked.drop("sig").join(ids, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
