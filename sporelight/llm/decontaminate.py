"""Benchmark decontamination with suffix arrays over the training documents.

Each worker holds a shard of the documents (the slice of rows it is reading),
builds a word-level suffix array of it and binary-searches every suffix of
every benchmark item: the suffixes of the shard that agree with at least a
window of the test suffix form one range of the array.  Each location in that
range is then extended to its longest verbatim match.  A document lies in one
shard as a whole, so results need no shuffle, and a passage that a third of all
documents share is just a long range in every shard.

The suffix array is kept to what can match: only stretches of words that all
occur in the benchmark and are as long as its shortest window get sorted; a
suffix beginning elsewhere has no match of that length.  Sorting (prefix
doubling) stops at the longest item's length.

Window: ``n`` consecutive words of an item; an item with fewer words, but not
none, is one window.  Words are runs of ``[0-9a-z]`` and non-ASCII characters
after lower-casing A-Z.

The benchmark goes to the workers in blocks of at most ``block_bytes`` of text,
each a broadcast of that size; further blocks follow as further narrow passes.

Edge cases: null or empty text has no words and no hits; items with null text
do nothing, items with a null id mark words but are not named; repeated rows are
judged alike; an empty benchmark marks nothing; further columns are ignored, and
:func:`clean` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from . import kernel as K

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 6 << 20
_MATCHES = ArrayType(StructType().add("item_id", "string").add("item_start", "integer").add("start", "integer").add("length", "integer"))
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("length", pa.int32())]))


class Index(NamedTuple):
    """A block of the benchmark: its words as numbers, item by item, each item followed by -2."""

    vocabulary: np.ndarray  # sorted word hashes
    words: np.ndarray  # int32 word numbers
    query: np.ndarray  # start of each searched suffix in words
    window: np.ndarray  # words that must agree, by suffix
    query_item: np.ndarray
    query_start: np.ndarray  # position of the suffix in its item
    ids: list  # item ids as text
    least: int  # shortest window
    longest: int  # longest item


def build_index(ids: list, texts: list, n: int = WINDOW) -> Index | None:
    column = pa.array(texts, pa.large_string())
    hashes, items, sizes = [], [], []
    for s in K.slices(column):
        data = K.fold(s.data)
        start, end, offsets = K.runs(data, s.offsets, K.ALNUM_WORDS)
        h = K.hash_runs(data, start, end)
        for i in range(s.rows):
            if offsets[i + 1] > offsets[i]:
                hashes.append(h[offsets[i] : offsets[i + 1]])
                items.append(s.first + i)
    if not hashes:
        return None
    sizes = np.array([len(h) for h in hashes])
    vocabulary, number = np.unique(np.concatenate(hashes), return_inverse=True)
    first = np.cumsum(sizes + 1) - sizes - 1
    words = np.full(int((sizes + 1).sum()), -2, np.int32)
    words[np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = number
    window = np.minimum(sizes, n)
    count = sizes - window + 1
    item = np.repeat(np.arange(len(items)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    named = [None if ids[i] is None else str(ids[i]) for i in items]
    return Index(vocabulary, words, first[item] + within, window[item], item, within, named, int(window.min()), int(sizes.max()))


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in order of their suffixes, compared over at least ``depth`` symbols (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
    h = 1
    while h < depth:
        later = np.zeros(n, np.int64)
        later[: max(0, n - h)] = rank[h:]
        key = rank * (n + 2) + later
        new = np.unique(key, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
        if new.max(initial=0) == n:
            rank = new
            break
        rank, h = new, 2 * h
    return np.argsort(rank, kind="stable")


def _bounds(text: np.ndarray, order: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """Range of suffixes that begin with each query's window, by binary search of all queries at once."""
    width = int(ix.window.max())
    padded = np.concatenate([text, np.full(width + 1, -3, np.int32)])
    edges = []
    for upper in (False, True):
        lo = np.zeros(len(ix.query), np.int64)
        hi = np.full(len(ix.query), len(order), np.int64)
        while True:
            live = np.flatnonzero(lo < hi)
            if len(live) == 0:
                break
            mid = (lo[live] + hi[live]) >> 1
            at, q, w = order[mid], ix.query[live], ix.window[live]
            sign = np.zeros(len(live), np.int8)  # suffix against window: -1 less, 1 more, 0 begins with it
            open_ = np.arange(len(live))
            for depth in range(width):
                open_ = open_[(sign[open_] == 0) & (w[open_] > depth)]
                if len(open_) == 0:
                    break
                a, b = padded[at[open_] + depth], ix.words[q[open_] + depth]
                sign[open_] = (a > b).astype(np.int8) - (a < b)
            right = sign < 0 if not upper else sign <= 0
            lo[live[right]] = mid[right] + 1
            hi[live[~right]] = mid[~right]
        edges.append(lo)
    return edges[0], edges[1]


def find_in_shard(word: np.ndarray, offsets: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest matches in a shard of word hashes (rows by ``offsets``): query number, word position, length."""
    none = np.zeros(0, np.int64)
    spot = np.minimum(np.searchsorted(ix.vocabulary, word), len(ix.vocabulary) - 1)
    known = ix.vocabulary[spot] == word
    if not known.any():
        return none, none, none
    # stretches of known words inside a document, at least as long as the shortest window
    begins, ends = known.copy(), known.copy()
    inner = offsets[(offsets > 0) & (offsets < len(word))]
    begins[1:] &= ~known[:-1]
    begins[inner] = known[inner]
    ends[:-1] &= ~known[1:]
    ends[inner - 1] = known[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    keep = end - start >= ix.least
    start, end = start[keep], end[keep]
    if len(start) == 0:
        return none, none, none
    size = end - start
    place = np.cumsum(size + 1) - size - 1  # each stretch is followed by -1, which no item has
    source = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    target = np.repeat(place, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    text = np.full(int((size + 1).sum()), -1, np.int32)
    text[target] = spot[source]
    position = np.full(len(text), -1, np.int64)
    position[target] = source
    order = suffix_array(text, int(ix.window.max()))
    lo, hi = _bounds(text, order, ix)
    count = hi - lo
    query = np.repeat(np.arange(len(count)), count)
    at = order[np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    # a match that also agrees one word to the left is part of a longer one
    q0 = ix.query[query]
    left = (ix.query_start[query] > 0) & (at > 0) & (text[at - 1] == ix.words[q0 - 1])
    query, at, q0 = query[~left], at[~left], q0[~left]
    length = ix.window[query].copy()
    padded = np.append(text, -1)
    open_ = np.arange(len(query))
    while len(open_):
        i = open_
        same = padded[np.minimum(at[i] + length[i], len(text))] == ix.words[q0[i] + length[i]]
        open_ = i[same]
        length[open_] += 1
    return query, position[at], length


def _passes(frame: DataFrame, ix: Index | None, first: bool, last: bool) -> DataFrame:
    """One narrow pass over all rows (columns: row, text[, n_words, matches]) that adds a block's matches.

    The last pass doesn't hand the text on."""
    shared = frame.sparkSession.sparkContext.broadcast(ix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            names = batch.schema.names
            for s in K.slices(batch.column(names.index("text")), SHARD_BYTES):
                part = batch.slice(s.first, s.rows)
                data = K.fold(s.data)
                start, end, offsets = K.runs(data, s.offsets, K.ALNUM_WORDS)
                found: list[list] = [[] for _ in range(s.rows)] if first else [list(m or ()) for m in part.column(names.index("matches")).to_pylist()]
                if ix is not None:
                    query, at, length = find_in_shard(K.hash_runs(data, start, end), offsets, ix)
                    doc = np.searchsorted(offsets, at, side="right") - 1
                    for d, q, a, n in zip(doc.tolist(), query.tolist(), (at - offsets[doc]).tolist(), length.tolist(), strict=True):
                        found[d].append({"item_id": ix.ids[ix.query_item[q]], "item_start": int(ix.query_start[q]), "start": a, "length": n})
                counted = pa.array(np.diff(offsets), pa.int64())
                out = {"row": part.column(names.index("row")), "text": part.column(names.index("text")), "n_words": counted, "matches": pa.array(found, _MATCH_TYPE)}
                if last:
                    out.pop("text")
                yield pa.RecordBatch.from_pydict(out)

    schema = StructType([frame.schema["row"], *([] if last else [StructField("text", StringType())])])
    return frame.mapInArrow(run, schema.add("n_words", "long").add("matches", _MATCHES))


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> Iterator[tuple[list, list, bool]]:
    """Item ids and texts of each block, and whether it is the last one."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t")).where("t IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        rows = part.collect()  # at most about block_bytes of text
        yield [r.i for r in rows], [r.t for r in rows], b == blocks - 1


def mark(documents: DataFrame, benchmark: DataFrame, *, n: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of the document), ``n_words``, ``matches`` (longest matches: item_id, item_start, start, length in words) and ``n_hit`` (words inside matches)."""
    frame = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), F.col(text_col).alias("text"))
    first = True
    for ids, texts, last in _blocks(benchmark, item_col, item_text_col, block_bytes):
        frame, first = _passes(frame, build_index(ids, texts, n), first, last), False
    if first:
        frame = _passes(frame, None, True, True)
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["length"]).alias("e"))))
    seen = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, m: F.struct(F.greatest(a["end"], m["e"]).alias("end"), (a["n"] + F.greatest(F.lit(0), m["e"] - F.greatest(a["end"], m["s"]))).cast("long").alias("n")),
        lambda a: a["n"],
    )
    return frame.select("row", "n_words", "matches", F.when(F.size("matches") > 0, seen).otherwise(F.lit(0).cast("long")).alias("n_hit"))


def clean(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that contain no window of the benchmark."""
    return mark(documents, benchmark, **options).where("n_hit = 0").select("row.*")


def report(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each document."""
    named = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda i: i.isNotNull())))
    marked = mark(documents.select(F.col(id_col).alias("doc_id"), F.col(options.pop("text_col", "text")).alias("text")), benchmark, **options)
    return marked.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size(named).cast("long").alias("n_items"), F.sha2(F.array_join(named, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS r(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
),
hits AS (SELECT doc_id, i, spots.n, item_id FROM spots JOIN windows ON spots.n = windows.n AND spots.win = windows.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""
