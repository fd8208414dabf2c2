"""Best-fit packing: documents kept whole wherever they fit, in as few sequences as the lengths allow.

1. Each task tokenises its documents and writes their pieces: a document of at
   most ``capacity`` tokens is one piece; of a longer one all pieces but the first
   are full, so it leaves one remainder.  A piece carries its number among its
   task's pieces of the same length.
2. The histogram of the lengths, at most ``capacity`` numbers, comes to the driver.
   A configuration linear program over it, solved by multiplicative weights with
   a knapsack for pricing and rounded (:mod:`.configurations`), says how many
   sequences of which contents to build.
3. Every length's places in those sequences are numbered, and a piece takes the
   place of its own number: the pieces of that length in the tasks before its
   own, plus its number there.  No piece is compared with another, no length
   is gathered in one task, and a length that a third of all documents have costs
   nothing extra.

The numbers of pieces by task and length are broadcast while there are at most
``BROADCAST_ROWS`` of them and joined by shuffle beyond; the table of places has a
few rows for each configuration, whatever the input's size.

Edge cases: null or empty text has the end id only; repeated rows are packed
repeatedly; an empty table gives no rows; ids of any type work; other columns of
the input are ignored; very long texts are tokenised block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from . import bytebpe, configurations
from . import kernel as K
from .store import discard, written

CAPACITY = 1024
END_ID = 2
BROADCAST_ROWS = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones after a first that may be shorter."""
    if n <= capacity:
        return [n]
    return [n % capacity or capacity] + [capacity] * ((n - 1) // capacity)


def pieces(documents: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids, task, number``: every piece, numbered among the pieces of its length in its task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([StructField("id", docs.schema["id"].dataType), StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()), StructField("task", IntegerType()), StructField("number", LongType())])
    arrow, path = to_arrow_schema(schema), tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, vocabulary, end = TaskContext.get().partitionId(), bytebpe.vocabulary(path), np.uint32(end_id)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for s in K.slices(batch.column(1)):
                ids, offsets = bytebpe.tokens_of_slice(s, vocabulary)
                row, piece, start, length, raw, number = [], [], [], [], [], []
                for i in range(s.rows):
                    own, at = np.append(ids[offsets[i] : offsets[i + 1]], end).astype("<u4"), 0
                    for j, n in enumerate(cut(len(own), capacity)):
                        row.append(s.first + i)
                        piece.append(j)
                        start.append(at)
                        length.append(n)
                        raw.append(own[at : at + n].tobytes())
                        number.append(seen[n])
                        seen[n] += 1
                        at += n
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(v, arrow.field(k + 1).type) for k, v in enumerate((piece, start, length, raw, [task] * len(row), number)))], schema=arrow)

    return docs.mapInArrow(run, schema)


def places(patterns: dict[configurations.Pattern, int]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of a length go: length, first and last number, pieces by sequence, first sequence, offset in it."""
    out, used, sequence = [], {}, 0
    for pattern, bins in sorted(patterns.items()):
        offset = 0
        for length, each in pattern:
            begin = used.get(length, 0)
            used[length] = begin + bins * each
            out.append((length, begin, used[length] - 1, each, sequence, offset))
            offset += length * each
        sequence += bins
    return out


def pack(documents: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids, sequence_id, offset``; sequences are numbered from 0."""
    spark = documents.sparkSession
    rows = written(pieces(documents, tokenizer=tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col), "pieces")
    counts = written(rows.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("before")), "piece-offsets")
    discard(counts)
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    table = spark.createDataFrame(places(configurations.solve(histogram, capacity)), "size long, first long, last long, each long, sequence long, at long")
    numbered = rows.join(offsets, ["task", "length"]).withColumn("number", F.col("number") + F.col("before"))
    own = (F.col("length") == F.col("size")) & F.col("number").between(F.col("first"), F.col("last"))
    inside = F.col("number") - F.col("first")
    return numbered.join(F.broadcast(table), own).select(
        "id", "piece", "start", "length", "ids",
        (F.col("sequence") + F.floor(inside / F.col("each"))).alias("sequence_id"),
        (F.col("at") + inside % F.col("each") * F.col("length")).alias("offset"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    out = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").cast("long").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
