"""SimHash near-dedup: vantage-point trees over the distinct fingerprints.

Fingerprints are made where the texts are read; equal ones become one node,
named by its smallest document id.  A shallow vantage-point tree, fitted on
a bounded sample, deals the nodes into shards: at each inner vertex those
within the median Hamming distance of the vantage point go one way, the rest
the other.  A node is at home in one shard.  By the triangle bound its partners
can be elsewhere only where its distance is within ``max_bits`` of a
vertex's radius, so copies of it visit just the shards beyond such boundaries.
Each shard runs its own tree, splitting until few are left and comparing those
exactly, and returns a spanning forest of its links instead of all pairs.
Links of all shards are then joined into components by rounds of small joins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import as_array, id_or_null, ids_of

#: Nodes aimed at per shard.
SHARD_ROWS = 20_000
#: Fingerprints that the shards' tree is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Pairs compared at once within a shard.
SMALL = 1 << 16
_SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over the XXH64 of word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = (map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle
             else [b" ".join(words)])
    h = np.array([xxhash.xxh64_intdigest(p, _SEED) for p in parts], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id`` (null: after all others) and ``fp``, the fingerprint's bits as a long."""
    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids_of(batch.column(0))), pa.array(made.view(np.int64))],
                                             names=["id", "fp"])
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "id long, fp long"))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def fit_tree(sample: np.ndarray, shards: int, seed: int = _SEED):
    """Vantage points and radii of a tree with about ``shards`` leaves:
    nested ``(point, radius, inside, outside)``; a leaf is its number."""
    rng, count = np.random.default_rng(seed), iter(range(1 << 62))

    def grow(points: np.ndarray, leaves: int):
        if leaves > 1 and len(points) > 1:
            point = points[rng.integers(len(points))]
            d = _distance(points, point)
            radius = int(np.median(d))
            if (d > radius).any():
                within = points[d <= radius]
                part = min(leaves - 1, max(1, round(leaves * len(within) / len(points))))
                return point, radius, grow(within, part), grow(points[d > radius], leaves - part)
        return next(count)

    return grow(sample, shards)


def deal(tree, fp: np.ndarray, max_bits: int):
    """Index, shard and whether it is its home, for each visit of a node.

    Of two partners on different sides of a vertex's radius, the outer visits the
    inner's side, so each pair meets in one home shard."""
    out = []

    def walk(node, at: np.ndarray, home: np.ndarray):
        if not len(at):
            return
        if not isinstance(node, tuple):
            out.append((at, np.full(len(at), node), home))
            return
        point, radius, inside, outside = node
        d = _distance(fp[at], point).astype(np.int64)
        near = d <= radius + max_bits
        walk(inside, at[near], home[near] & (d[near] <= radius))
        # a node at home inside leaves the meeting to its outer partner
        far = (d > radius) | (~home & (d > radius - max_bits))
        walk(outside, at[far], home[far] & (d[far] > radius))

    walk(tree, np.arange(len(fp)), np.ones(len(fp), bool))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(map(np.concatenate, zip(*out)))


class Forest:
    """Disjoint sets over the rows of a shard; the root is the smallest row."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while (self.up[r] != r).any():
            r = self.up[r]
        self.up[x] = r
        return r


def link_within(fp: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Root of each row in the forest of links between rows of one shard, of
    which at least one is at home there."""
    rng, forest = np.random.default_rng(_SEED), Forest(len(fp))

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, SMALL // max(1, len(b)))
        for i in range(0, len(a), step):
            x, y = np.nonzero(_distance(fp[a[i:i + step], None], fp[b][None, :]) <= max_bits)
            forest.link(a[i + x], b[y])

    def cross(a: np.ndarray, b: np.ndarray) -> None:
        """Links between the rows of a and those of b."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if len(a) * len(b) <= SMALL or min(len(a), len(b)) < 8:
                compare(a, b)
                continue
            point = fp[a[rng.integers(len(a))]]
            da, db = (_distance(fp[x], point).astype(np.int64) for x in (a, b))
            radius = int(np.median(da))
            if (da <= radius).all():
                if (da == radius).all():
                    near = np.abs(db - radius) <= max_bits
                    if near.all():
                        compare(a, b)
                    else:
                        todo.append((a, b[near]))
                    continue
                radius -= 1
            todo.append((a[da <= radius], b[db <= radius + max_bits]))
            todo.append((a[da > radius], b[db > radius - max_bits]))

    todo = [np.flatnonzero(home)]
    while todo:
        at = todo.pop()
        if len(at) ** 2 <= SMALL:
            compare(at, at)
            continue
        d = _distance(fp[at], fp[at[rng.integers(len(at))]]).astype(np.int64)
        radius = int(np.median(d))
        if (d <= radius).all():  # the vantage point itself has distance 0
            radius -= 1
        within, beyond = d <= radius, d > radius
        todo += [at[within], at[beyond]]
        cross(at[within & (d > radius - max_bits)], at[beyond & (d <= radius + max_bits)])
    cross(np.flatnonzero(~home), np.flatnonzero(home))
    return forest.roots(np.arange(len(fp)))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges (a, b)``, root being the smallest
    node that it is connected with.

    Alternates two steps until nothing changes: each node hangs its larger
    neighbours on its smallest one, then its smaller ones.  A step only groups
    and joins edges, and never holds a node's neighbours in one place."""
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = cut_lineage(edges), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = least(large)
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = cut_lineage(small)
        # a star forest is reached when a round leaves the edges as they were
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Fingerprint and component of each text: ``doc_id, fingerprint`` (16 hex
    digits), ``component_id`` (the smallest id reachable over links).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer than
    ``shingle`` words is one shingle; null or empty texts have fingerprint zero.
    Texts link at ``max_bits`` or fewer differing bits.  One row per input
    row.  Nodes are fingerprints, so rows with equal or null ids link by their texts alone; a null
    id counts as larger than any other.  Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    made = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    nodes = cut_lineage(made.groupBy("fp").agg(F.min("id").alias("least")))
    n = nodes.count()
    share = SAMPLE_ROWS / max(n, 1)
    sample = nodes.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    points = np.array([r.fp for r in sample.orderBy(F.xxhash64("fp")).limit(SAMPLE_ROWS).select("fp").collect()],
                      np.int64).view(np.uint64)
    shards = max(spark.sparkContext.defaultParallelism, -(-n // SHARD_ROWS))
    tree = spark.sparkContext.broadcast(fit_tree(points, shards))

    def visits(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            at, shard, home = deal(tree.value, fp.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(fp[at]), pa.array(home)], names=["shard", "fp", "home"])

    def link(table: pa.Table) -> pa.Table:
        node = as_array(table["fp"]).to_numpy()
        order = np.argsort(node, kind="stable")
        node = node[order]
        fp = node.view(np.uint64)
        home = as_array(table["home"]).to_numpy(zero_copy_only=False)[order]
        root = link_within(fp, home, max_bits)
        linked = root != np.arange(len(root))
        return pa.table({"a": node[linked], "b": node[root[linked]]})

    links = (nodes.select("fp").mapInArrow(visits, "shard long, fp long, home boolean")
             .groupBy("shard").applyInArrow(link, "a long, b long"))
    rooted = nodes.join(components(links), F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    # the smallest id of each component; a component is as large as its fingerprints, so these meet map-side first
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    found = made.join(rooted.join(first, "root").select("fp", "first"), "fp")

    def show(batches):
        for batch in batches:
            fp = batch.column(1).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [id_or_null(batch.column(0).to_numpy()), pa.array([f"{x:016x}" for x in fp.tolist()], pa.string()),
                 id_or_null(batch.column(2).to_numpy())], names=["doc_id", "fingerprint", "component_id"])
    return found.select("id", "fp", "first").mapInArrow(
        show, "doc_id long, fingerprint string, component_id long")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The input rows, with their own columns, of each component's smallest id.  Rows with one id stay or go
    together: they go if each of them is near a row of a smaller id."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    drop = found.groupBy(F.col("doc_id").alias("id")).agg(F.bool_or(stays).alias("stays")).where(~F.col("stays"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("id"))
    return rows.join(drop, rows["id"].eqNullSafe(drop["id"]), "left_anti").select("row.*")
