"""Exact Jaccard self-join of word n-gram sets with a count-vector R-tree.

A document is the set of its distinct ``n``-word shingles (64-bit hashes).
Hashing the shingles into ``COORDINATES`` groups and counting each group gives
a point; the overlap of two sets is at most the sum of the coordinate minima of
their points.  An R-tree over such points prunes a subtree when even its upper
corner can't reach the overlap that the threshold asks for; what survives is
verified on the shingles themselves.

Stages
------
1. *Points* (narrow): set size, set hash, point and block signatures of each
   document, written once.  Equal sets are one node, named by the smallest id.
2. *Blocks*: the tree's root level, cut so that no partner is lost.  (Upper corners
   alone can't serve as that level: in 128 dimensions the corner of a few unrelated
   documents already dominates every other document, so each would be routed
   everywhere.)  Sets with Jaccard >= t and sizes in one band differ in at most d
   shingles, so of more than d shingle groups at most d differ.  Order a set's
   groups by size, the largest first, and by number: before the first one that both
   sets have in common stand at most d others, in either set.  The content hashes of
   the first d + 1 groups are therefore block keys enough; a set has keys for every
   band that a smaller partner's size may lie in.  As a key is the whole content
   of a large group, a passage that many documents share doesn't bring unrelated
   documents together.  Blocks of the same nodes are one.
3. *First partners*: each block is bulk-loaded into R-trees, and each node asks for
   the entry of smallest id that its bound allows.  Blocks of more than ``PART``
   nodes are dealt out in parts, each with the block's first part beside it: work
   grows with the nodes of a block, a block of near copies included.  These pairs
   are verified, links merge into components.
4. *Rest*: in blocks that still hold several components, all nodes of different
   components are searched through R-trees, each part with every other.  Survivors
   are verified; final components follow.

Pairs are verified on their whole sets of 64-bit shingle hashes.

Nothing is capped: a pair is skipped only if its bound rules it out or its ends
are already in one component.

Edge cases: null texts, and texts without words, have an empty set and link with
nothing; a text of fewer than ``n`` words is one shingle; rows that share an id
are one node of the graph; a null id links with nothing and has a null
component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .store import discard, written

COORDINATES = 128
BAND = 1.5
LEAF = 16  # entries of an R-tree node
PART = 256
_POINTS = "doc_id long, n_shingles long, h1 long, h2 long, point binary, keys array<long>"


def band_edges(limit: int = 1 << 40) -> np.ndarray:
    edges, x = [1], 1.0
    while edges[-1] < limit:
        x *= BAND
        edges.append(max(edges[-1] + 1, int(np.ceil(x))))
    return np.array(edges, np.int64)


_EDGES = band_edges()


def differences(band: int, t: Fraction) -> int:
    """Most shingles by which a set of this band can differ from a partner that isn't smaller: the union is at most size / t."""
    most = int(_EDGES[band + 1]) - 1
    return int((1 - t) * most / t)


def groups(band: int, t: Fraction) -> int:
    """Shingle groups of a band; more than the differences, so that the smallest groups need no key."""
    d = differences(band, t)
    return d + 3 + 3 * d // 5


def shingle_sets(s: K.Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and their offsets."""
    data = K.fold(s.data)
    start, end, offsets = K.runs(data, s.offsets, K.SPACE_WORDS)
    word = K.hash_runs(data, start, end)
    size = np.diff(offsets)
    full = K.window_hash(word, n)
    parts, lengths = [], np.zeros(s.rows, np.int64)
    for i, (a, m) in enumerate(zip(offsets[:-1].tolist(), size.tolist(), strict=True)):
        if m == 0:
            continue
        if m < n:
            h = K.mix(K.window_hash(word[a : a + m], m) + np.uint64(m))
        else:
            h = np.sort(full[a : a + m - n + 1])
            if len(h) > 1:
                h = h[np.concatenate([[True], h[1:] != h[:-1]])]
        parts.append(h)
        lengths[i] = len(h)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(lengths)])


def points_of(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Count vectors, one row for each set."""
    rows = len(offsets) - 1
    cell = K.doc_of(offsets) * COORDINATES + (h & np.uint64(COORDINATES - 1)).astype(np.int64)
    return np.bincount(cell, minlength=rows * COORDINATES).reshape(rows, COORDINATES).astype(np.uint32)


def block_keys(h: np.ndarray, t: Fraction) -> np.ndarray:
    """Keys of one set (sorted hashes)."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint64)
    least = -(-n * t.numerator // t.denominator)  # size of the smallest partner
    low, high = (int(x) - 1 for x in np.searchsorted(_EDGES, [least, n], side="right"))
    bands = range(high, low - 1, -1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(h))])
    out = []
    for b in bands:
        g = groups(b, t)
        group = ((h >> np.uint64(32)) * np.uint64(g)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        last = np.append(first[1:], n)
        size = last - first
        best = np.lexsort((group[first], -size))[: differences(b, t) + 1]
        content = total[last[best]] - total[first[best]] + size[best].astype(np.uint64)
        salt = np.uint64((b + 1) << 32)
        out.append(K.mix(content ^ K.mix(group[first[best]] + salt)))
        lacking = differences(b, t) + 1 - len(best)
        if lacking > 0:
            missing = np.setdiff1d(np.arange(g, dtype=np.uint64), group[first])[:lacking]
            out.append(K.mix(K.mix(missing + salt)))
    return np.concatenate(out)


def _points(n: int, t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in K.slices(batch.column(1)):
                h, offsets = shingle_sets(s, n)
                size = np.diff(offsets)
                both = []
                for salt in (0x1F, 0x2E):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(h + np.uint64(salt)))])
                    both.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
                point = points_of(h, offsets)
                keys = [block_keys(h[a:b], t) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                counts = np.fromiter(map(len, keys), np.int32, len(keys))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(np.concatenate(keys).view(np.int64) if len(keys) else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.rows), pa.array(size, pa.int64()), pa.array(both[0]), pa.array(both[1]), pa.array([p.tobytes() for p in point], pa.binary()), lists], names=["doc_id", "n_shingles", "h1", "h2", "point", "keys"])

    return run


def need(a: np.ndarray, b: np.ndarray, t: Fraction) -> np.ndarray:
    """Least overlap of sets of sizes a and b: t / (1 + t) of the sum, rounded up."""
    p, q = t.numerator, t.numerator + t.denominator
    return -(-(a + b) * p // q)


class RTree:
    """Packed R-tree of count vectors (sorted by size, then by the widest coordinates), searched for many points at once."""

    def __init__(self, points: np.ndarray):
        size = points.sum(1).astype(np.int64)
        spread = np.argsort(-points.var(0), kind="stable")[:2] if len(points) else np.zeros(2, np.int64)
        self.order = np.lexsort((points[:, spread[1]], points[:, spread[0]] // 4, size)) if len(points) else np.zeros(0, np.int64)
        self.points, self.size = points[self.order].astype(np.int64), size[self.order]
        self.levels = []  # upper corner and least size of each node, leaves' parents first
        high, least = self.points, self.size
        while len(high) > 1:
            cut = np.arange(0, len(high), LEAF)
            high, least = np.maximum.reduceat(high, cut, axis=0), np.minimum.reduceat(least, cut)
            self.levels.append((high, least))

    def search(self, points: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, entry) whose bound reaches the threshold."""
        points = points.astype(np.int64)
        size = points.sum(1)
        if not len(points) or not len(self.points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = len(self.levels[-1][0]) if self.levels else len(self.points)
        query, node = np.repeat(np.arange(len(points)), top), np.tile(np.arange(top), len(points))
        for level in range(len(self.levels) - 1, -2, -1):
            high, least = self.levels[level] if level >= 0 else (self.points, self.size)
            keep = []
            for at in range(0, len(query), 1 << 15):
                q, m = query[at : at + (1 << 15)], node[at : at + (1 << 15)]
                bound = np.minimum(points[q], high[m]).sum(1)
                keep.append(bound >= need(size[q], least[m], t))
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            query, node = query[keep], node[keep]
            if level >= 0:
                below = len(self.levels[level - 1][0]) if level else len(self.points)
                first = node * LEAF
                count = np.minimum(first + LEAF, below) - first
                query = np.repeat(query, count)
                node = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return query, self.order[node]


def _verified(n: int, t: Fraction):
    """Keeps the pairs whose shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in K.slices(batch.column(2)):
                part = batch.slice(s.first, s.rows)
                h, offsets = shingle_sets(s, n)
                ok, i = np.zeros(s.rows, bool), 0
                for other in K.slices(part.column(3)):
                    g, at = shingle_sets(other, n)
                    for j in range(other.rows):
                        x, y = h[offsets[i] : offsets[i + 1]], g[at[j] : at[j + 1]]
                        if len(x) and len(y):
                            spot = np.minimum(np.searchsorted(x, y), len(x) - 1)
                            both = int((x[spot] == y).sum())
                            ok[i] = both * t.denominator >= t.numerator * (len(x) + len(y) - both)
                        i += 1
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), part.column(1).filter(pa.array(ok))], names=["a", "b"])

    return run


def _first_partners(rows: list, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """For each node the one of smallest id, smaller than its own, that the tree finds."""
    node = np.array([r[0] for r in rows])
    point = np.frombuffer(b"".join(r[1] for r in rows), np.uint32).reshape(-1, COORDINATES)
    q, e = RTree(point).search(point, t)
    q, e = node[q], node[e]
    q, e = q[e < q], e[e < q]
    order = np.lexsort((e, q))
    q, e = q[order], e[order]
    first = np.append(True, q[1:] != q[:-1])[: len(q)]
    return e[first], q[first]


def _across(rows: list, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of different components that the tree finds between two parts, or within one."""
    node, side, component = (np.array([r[i] for r in rows]) for i in (0, 2, 3))
    point = np.frombuffer(b"".join(r[1] for r in rows), np.uint32).reshape(-1, COORDINATES)
    left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    q, e = RTree(point[right]).search(point[left], t)
    q, e = left[q], right[e]
    keep = component[q] != component[e]
    q, e = node[q[keep]], node[e[keep]]
    return np.minimum(q, e), np.maximum(q, e)


def _searched(t: Fraction, search):
    """``search`` of the rows of each block part; they arrive sorted by (block, p, q), a part may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        found, held = [], 0

        def emit() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for block, p, q, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, p, q) != key:
                    if len(rows) > 1:
                        found.append(search(rows, t))
                        held += len(found[-1][0])
                        if held > 1 << 16:
                            yield emit()
                            found, held = [], 0
                    key, rows = (block, p, q), []
                rows.append(rest)
        if len(rows) > 1:
            found.append(search(rows, t))
        if found:
            yield emit()

    return run


def _links(pairs: DataFrame, texts: DataFrame, n: int, t: Fraction) -> DataFrame:
    a, b = (texts.select(F.col("node").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    full = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    return full.mapInArrow(_verified(n, t), "a long, b long")


def link_components(documents: DataFrame, *, n: int = 3, threshold: Fraction = Fraction(9, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id reachable by links of Jaccard >= threshold."""
    t = Fraction(threshold)
    source = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    points = written(source.mapInArrow(_points(n, t), _POINTS), "points")
    # written, so that the join's exchanges serve nothing else and Spark may split a large group of exact copies
    sets = written(points.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("node")), "sets")
    members = points.select("doc_id", "n_shingles", "h1", "h2").join(sets, ["n_shingles", "h1", "h2"], "left")
    members = written(members.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("node")), "members")
    nodes = members.where("doc_id = node AND n_shingles > 0").select("node").distinct()
    # rows that share an id, and equal documents that share one with a node, may give a node several rows: all of them count
    keyed = points.select(F.col("doc_id").alias("node"), "point", "keys").join(nodes, "node", "left_semi")
    keys, block = keyed.select("node", F.explode("keys").alias("key")), Window.partitionBy("key")
    met = keys.select("key", "node", F.min("node").over(block).alias("low"), F.max("node").over(block).alias("high"))
    blocks = written(met.where("low < high").select("key", "node").distinct(), "blocks")
    point = written(keyed.join(blocks.select("node").distinct(), "node", "left_semi").select("node", "point"), "node-points")
    discard(points, sets)  # all that is still needed of them is in members, blocks and point
    texts = source.withColumnRenamed("doc_id", "node").join(blocks.select("node").distinct(), "node", "left_semi")

    def described(state: DataFrame, *more) -> DataFrame:
        """Size and signature of each block's nodes."""
        return state.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("x"), *more)

    def alone(sums: DataFrame) -> DataFrame:
        """``key, parts``: of blocks with the same nodes one is enough."""
        return sums.groupBy("size", "s", "x").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("size") / PART).cast("int").alias("parts"))

    part = F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts")).cast("int")

    def survivors(rows: DataFrame, search, *more: str) -> DataFrame:
        """Pairs (a, b) that the trees of each (key, p, q) give."""
        spread = rows.join(point, "node").select("key", "p", "q", "node", "point", *more).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
        return spread.mapInArrow(_searched(t, search), "a long, b long").distinct()

    dealt = blocks.join(alone(described(blocks)), "key").withColumn("part", part)
    # every part has the first part beside it
    beside = F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    first = written(survivors(dealt.select("key", F.lit(0).alias("p"), F.explode(beside).alias("q"), "node"), _first_partners), "first-partners")
    links = written(_links(first, texts, n, t).distinct(), "links")
    found = components(links)

    state = blocks.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = described(state, F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
    rest = state.join(alone(mixed), "key").withColumn("part", part)
    # a part meets itself and every other part once: (p, q) with p <= q
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "node", F.col("part").alias("side"), "component")
    tried = survivors(rest, _across, "side", "component").join(first, ["a", "b"], "left_anti")
    late = written(_links(tried, texts, n, t).distinct(), "late-links")
    final = written(components(links.union(late)), "components")
    discard(blocks, point, first, links, late)
    return members.join(final, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def keep_one(documents: DataFrame, *, n: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, with all their columns, without those linked with one of smaller id (repeated rows: one stays)."""
    parts = link_components(documents, n=n, threshold=threshold, id_col=id_col, **options)
    free = "_kept"
    while free.lower() in {c.lower() for c in documents.columns}:
        free += "_"
    kept = parts.where("component_id = doc_id OR doc_id IS NULL").select(F.col("doc_id").alias(free)).distinct()
    own = F.col(f"`{id_col}`")
    out = documents.join(kept, own.cast("long").eqNullSafe(F.col(free)), "left_semi")
    order = Window.partitionBy(own).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in documents.columns)))
    named = out.where(own.isNotNull()).withColumn(free, F.row_number().over(order)).where(F.col(free) == 1).drop(free)
    return named.unionByName(out.where(own.isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + least(len(w), 3) - 1], 'string_agg', ' ') AS shingle
  FROM d, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)"""
