"""Importance resampling: draw the documents that look most like a target corpus.

A document's features are its runs of 1 to ``order`` consecutive words, hashed
into ``buckets`` by CRC-32.  Features of all documents and of the target are
counted by bucket; a bucket's gain is its scaled log ratio of smoothed shares.
A document weighs the sum of its features' gains, and a Gumbel number drawn from
its id is added, so that the best scores are a sample without replacement.

Method
------
*Overlap chunking.*  A text of more than ``chunk_bytes`` is cut at word
boundaries into chunks that are dealt over all tasks.  A chunk carries the
``order - 1`` words that follow it and owns the starting positions before them,
so every run of words is counted in one chunk and none is lost at a cut.  Chunk
counts and weights are summed by document.  Texts below the limit stay where
they are read.

Texts are tokenised once: the bucket numbers of their features (two bytes each,
four beyond 65,536 buckets) are written to the shared folder; counting and
weighing read those.  A task adds its counts up in one vector of ``buckets``
numbers before anything is shuffled; those vectors' sum, ``buckets`` numbers
whatever the input's size, is all that comes to the driver.  Ranks come from a range partitioning by score, the sizes of the parts and the
places inside them; nothing is sorted in one task.

Edge cases: a null or empty text has no features and weight 0; repeated rows are
documents of their own (equal scores, ranks beside each other); a null id is
hashed as the empty string and comes last among ties; ids of any type that has a
text form work; an empty table gives no rows; an empty target gives every bucket
t = T = 0; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from . import kernel as K
from .store import discard, written

ORDER = 1
BUCKETS = 10_000
CHUNK_BYTES = 1 << 16
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000  # fixed value: gains and Gumbel numbers are thousandths

#: A word before A-Z are lower-cased.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def pieces(text: bytes, size: int, carry: int) -> Iterator[tuple[int, int, int]]:
    """Cut a text at word boundaries: begin, end of the owned bytes (at least ``size`` but for the last), end with the carried words."""
    begin = 0
    while begin < len(text):
        end = min(begin + size, len(text))
        if end < len(text):
            inside = _WORD.match(text, end) if _WORD.match(text, end - 1, end) else None
            end = inside.end() if inside else end
        reach = end
        for word, _ in zip(_WORD.finditer(text, end), range(carry)):
            reach = word.end()
        yield begin, end, reach
        begin = end


def _chunker(size: int, carry: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py().encode()
                cut = list(pieces(text, size, carry))
                ids = batch.column(0).slice(i, 1).take(pa.array(np.zeros(len(cut), np.int64)))
                yield pa.RecordBatch.from_arrays([ids, pa.array([row] * len(cut), pa.int64()), pa.array(range(len(cut)), pa.int32()), pa.array([text[a:c] for a, _, c in cut], pa.binary()), pa.array([b - a for a, b, _ in cut], pa.int64())], schema=schema)
                row += 1

    return run


def buckets_of(s: K.Slice, own: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of the runs of 1 to ``order`` words that start in a row's first ``own`` bytes, their offsets by row, and the words that start there."""
    data = K.fold(s.data)
    start, end, by_row = K.runs(data, s.offsets, K.ALNUM_WORDS)
    row = K.doc_of(by_row)
    mine = start - s.offsets[row] < own[row]
    last = by_row[1:][row] if len(row) else np.zeros(0, np.int64)
    begun = np.flatnonzero(mine)
    state, found, rows = K.crc_begin(len(begun)), [], []
    place = begun
    for k in range(order):
        if k:  # one word more, where the text has one
            go = place + 1 < last[begun]
            begun, place, state = begun[go], place[go] + 1, K.crc_byte(state[go], 0x20)
        state = K.crc_more(state, data, start[place], end[place])
        found.append(K.crc_end(state) % np.uint32(buckets))
        rows.append(row[begun])
    bucket, of = np.concatenate(found), np.concatenate(rows)
    if order > 1:
        bucket, of = bucket[(o := np.argsort(of, kind="stable"))], of[o]
    words = np.bincount(row[mine], minlength=s.rows) if len(row) else np.zeros(s.rows, np.int64)
    return bucket, np.searchsorted(of, np.arange(s.rows + 1)), words


def _featurer(order: int, buckets: int, keys: int, schema: pa.Schema):
    """``keys`` leading columns are kept; then come the text and, for chunks, the owned bytes."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in K.slices(batch.column(keys)):
                own = np.asarray(batch.column(keys + 1)[s.first : s.first + s.rows]) if batch.num_columns > keys + 1 else np.diff(s.offsets)
                bucket, offsets, words = buckets_of(s, own, order, buckets)
                raw = bucket.astype(width).tobytes()
                size = int(width[2])
                packed = [raw[a * size : b * size] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                kept = [batch.column(i).slice(s.first, s.rows) for i in range(keys)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(packed, pa.binary())], schema=schema)

    return run


def _to_arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def features(documents: DataFrame, *, order: int = ORDER, buckets: int = BUCKETS, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two written tables, of whole texts ``id, n_words, n_features, buckets`` and of chunks ``id, row, chunk, n_words, n_features, buckets``."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ident = StructField("id", docs.schema["id"].dataType)
    counted = [StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("buckets", BinaryType())]
    key = [StructField("row", LongType()), StructField("chunk", IntegerType())]
    long = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    whole = StructType([ident, *counted])
    short = docs.where(~long).mapInArrow(_featurer(order, buckets, 1, _to_arrow(whole)), whole)
    cut = StructType([ident, *key, StructField("text", BinaryType()), StructField("own", LongType())])
    chunked = StructType([ident, *key, *counted])
    chunks = docs.where(long).mapInArrow(_chunker(chunk_bytes, order - 1, _to_arrow(cut)), cut).repartition("row", "chunk")
    chunks = chunks.mapInArrow(_featurer(order, buckets, 3, _to_arrow(chunked)), chunked)
    return written(short, "features-whole"), written(chunks, "features-chunks")


def _numbers(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a column of packed ones, and how many each row has."""
    rows = column.to_pylist()
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.frombuffer(b"".join(rows), kind), np.array([len(x) // kind.itemsize for x in rows], np.int64)


def bucket_counts(tables: tuple[DataFrame, ...], buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: one vector for each task, summed in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = [t.select("buckets").mapInArrow(run, "bucket long, n long") for t in tables]
    both = parts[0]
    for p in parts[1:]:
        both = both.union(p)
    for bucket, n in both.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """A bucket's gain: the floor of the scaled log ratio of its smoothed shares of the target and of the source."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weighed(table: DataFrame, gain: np.ndarray) -> DataFrame:
    keys = [f for f in table.schema.fields if f.name in ("id", "row")]
    schema = StructType([*keys, StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("weight", LongType())])
    arrow, n = _to_arrow(schema), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, size = _numbers(batch.column(batch.num_columns - 1), n)
            weight = K.sums_by_doc(gain[number], np.concatenate([[0], np.cumsum(size)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weight, pa.int64())], schema=arrow)

    return table.select(*(f.name for f in keys), "n_words", "n_features", "buckets").mapInArrow(run, schema)


def gumbel(ident: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """The id's Gumbel number in thousandths, from the first 32 bits of a SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``rank`` (from 1) in the given order: parts by range, places inside them, sizes of the parts before."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranked")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(offsets, "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(documents: DataFrame, target: DataFrame, *, order: int = ORDER, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """One row per document: ``id, n_words, n_features, weight, score, rank`` (null rank: not drawn).

    Drawn are ``percent`` of the documents with at least ``least_words`` words, rounded down."""
    own = features(documents, order=order, buckets=buckets, chunk_bytes=chunk_bytes, id_col=id_col, text_col=text_col)
    other = features(target.select(F.lit(None).cast("long").alias("id"), F.col(target_text).alias("text")), order=order, buckets=buckets, chunk_bytes=chunk_bytes, id_col="id")
    gain = gains(bucket_counts(own, buckets), bucket_counts(other, buckets))
    whole, chunks = own
    sums = {c: F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")}
    joined = _weighed(chunks, gain).groupBy("row").agg(F.first("id").alias("id"), *sums.values()).drop("row")
    scored = _weighed(whole, gain).unionByName(joined).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = written(scored, "scored")
    discard(*own, *other)
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    inside = ranked(scored.where(enough), F.col("score").desc(), F.col("id").asc_nulls_last())
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return inside.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def query(spark, sf_dir: str) -> DataFrame:
    out = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(F.col("id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


def _nibbles() -> list[int]:
    out = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


# a word's CRC-32, from the hex digits of its UTF-8 bytes, the low half of a byte first
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, [instr('0123456789ABCDEF', substr(hex(word), i + CASE i % 2 WHEN 1 THEN 1 ELSE -1 END, 1)) - 1 for i in range(1, strlen(word) * 2 + 1)]),
  lambda c, x: xor(([{", ".join(map(str, _nibbles()))}]::BIGINT[])[xor(c, x) % 16 + 1], c >> 4)), 4294967295::BIGINT)"""

ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY 1, 2),
qw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM q) GROUP BY 1),
hashed AS (SELECT word, {_CRC} % {BUCKETS} AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM qw)),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM dw JOIN hashed USING (word) GROUP BY 1),
t AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM qw JOIN hashed USING (word) GROUP BY 1),
g AS (SELECT bucket, CAST(floor({SCALE} * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS}) / (CAST(s + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
v AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM dw JOIN hashed USING (word) JOIN g USING (bucket) GROUP BY 1),
x AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, CAST(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN v USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-{SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM y WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * {PERCENT} // 100 THEN rank END AS rank FROM y LEFT JOIN r USING (doc_id)"""
