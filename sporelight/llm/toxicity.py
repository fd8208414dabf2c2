"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. Over *all* labelled training documents, count in how many toxic and clean ones
   each character n-gram (orders 3 to 6 after lower-casing, hashed to
   ``2**HASH_BITS`` buckets) occurs; sums are added up map-side.
2. A bucket qualifies if its log-count ratio is significant (|ratio| over its
   standard error at least ``SIGNIFICANCE``).  Features are the ``FEATURES`` of them
   that say most about a document's class (mutual information of presence and
   class, in nats a document): a size of the model, ranked by a measure that
   doesn't grow with the number of rows, so that it selects alike at every size.
3. A logistic model is fitted to presence * ratio of those features on at most
   ``SAMPLE`` documents of each class, those with the least hash of the id.
4. Scoring is narrow and takes whole texts, slice by slice.

What comes to the driver is bounded by the bucket count and the sample.

Edge cases: null and empty texts get the model's intercept; labels that are null,
or belong to no document, teach nothing; an id labelled both ways counts as
toxic; without both classes in the training rows every score is the share of
toxic ones (0 without any); rows with a null id aren't learned from; repeated
rows get equal scores; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .store import written

HASH_BITS = 20
ORDERS = (3, 4, 5, 6)
FEATURES = 12_000
SIGNIFICANCE = 4.0
SAMPLE = 4_000
RIDGE = 0.01
THRESHOLD = 0.7
_SIZE = 1 << HASH_BITS
_CHUNK = 1 << 10  # buckets whose counts travel together


def _characters(s: K.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased slice, each row between two spaces, and offsets by row."""
    parts, sizes = [], []
    if not (s.data >= 0x80).any():
        x = K.fold(s.data).astype(np.uint32)
        sizes = np.diff(s.offsets)
    else:
        raw = s.data.tobytes()
        for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist(), strict=True):
            points = np.frombuffer(raw[a:b].decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            parts.append(points)
            sizes.append(len(points))
        x, sizes = np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array(sizes, np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes + 2)])
    out = np.full(int(offsets[-1]), 0x20, np.uint32)
    out[np.arange(len(x)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = np.where((x >= 9) & (x <= 13), np.uint32(0x20), x)
    return out, offsets


def _buckets(x: np.ndarray):
    """For each order: bucket of the n-gram that begins at each place (those over a row's end included)."""
    rolling = np.zeros(len(x), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = len(x) - order + 1
        if n <= 0:
            return
        rolling = rolling[:n] * np.uint32(0x01000193)
        rolling += (x[order - 1 :] + np.uint32(1)) * np.uint32(0x9E3779B1)
        if order in ORDERS:
            h = rolling ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)
            h ^= h >> np.uint32(16)
            h *= np.uint32(0x7FEB352D)
            h ^= h >> np.uint32(15)
            yield order, (h & np.uint32(_SIZE - 1)).view(np.int32)


def _present(s: K.Slice, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of the n-grams of a slice that fall into wanted buckets."""
    x, offsets = _characters(s)
    found = []
    for order, bucket in _buckets(x):
        at = np.flatnonzero(wanted[bucket])
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + order <= offsets[row + 1]
        found.append(row[inside] << HASH_BITS | bucket[at[inside]].astype(np.int64))
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both >> HASH_BITS, both & (_SIZE - 1)


def _bounded(slices: Iterator[K.Slice], rows: int = 1 << 15) -> Iterator[K.Slice]:
    """The slices, cut to at most so many rows."""
    for s in slices:
        for at in range(0, s.rows, rows):
            cut = s.offsets[at : at + rows + 1]
            yield K.Slice(s.first + at, s.data[cut[0] : cut[-1]], cut - cut[0], s.null[at : at + rows])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class by bucket, in chunks of buckets; chunk -1 counts all of them."""
    total, documents, sent = np.zeros((2, _SIZE), np.uint16), np.zeros(2, np.int64), np.zeros(2, np.int64)
    place = np.zeros(_SIZE, np.int32)

    def send() -> Iterator[pa.RecordBatch]:
        whole = np.zeros((2, _CHUNK), np.uint16)
        whole[:, 0] = documents - sent
        sent[:] = documents
        parts = total.reshape(2, -1, _CHUNK).transpose(1, 0, 2)
        full = np.flatnonzero(parts.any(axis=(1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1), pa.int32()), pa.array([*(parts[i].tobytes() for i in full), whole.tobytes()], pa.binary())], names=["chunk", "data"])
        total[:] = 0

    for batch in batches:
        toxic = np.asarray(batch.column(0)).astype(np.int64)
        for s in _bounded(K.slices(batch.column(1))):
            if documents.sum() - sent.sum() + s.rows > 65_535:  # no count may go beyond 16 bits
                yield from send()
            documents += np.bincount(toxic[s.first : s.first + s.rows], minlength=2)
            x, offsets = _characters(s)
            grams = list(_buckets(x))
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own = np.concatenate([g[a : max(a, b - order + 1)] for order, g in grams]) if grams else np.zeros(0, np.int32)
                # of equal buckets the last one's place stays, so each counts once
                spots = np.arange(len(own), dtype=np.int32)
                place[own] = spots
                total[toxic[s.first + i]][own[place[own] == spots]] += 1
    yield from send()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by bucket from chunks, which arrive sorted by their number; chunk -1 has the totals."""
    key, total = None, np.zeros((2, _CHUNK), np.int64)

    def done() -> pa.RecordBatch:
        if key < 0:
            bucket, counts = np.array([-1], np.int32), total[:, :1]
        else:
            at = np.flatnonzero(total.any(0))
            bucket, counts = (key * _CHUNK + at).astype(np.int32), total[:, at]
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(counts[0]), pa.array(counts[1])], names=["bucket", "clean", "toxic"])

    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if chunk != key:
                if key is not None:
                    yield done()
                key, total = chunk, np.zeros((2, _CHUNK), np.int64)
            total += np.frombuffer(data, np.uint16).reshape(2, _CHUNK)
    if key is not None:
        yield done()


def _featured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for s in K.slices(batch.column(1)):
                row, bucket = _present(s, wanted)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(s.rows + 1)), pa.int32()), pa.array(bucket, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.rows), lists], names=["toxic", "buckets"])

    return run


def _fitted(pick: np.ndarray, ratio: np.ndarray):
    """One task over the sample: a row for each feature's weight, and the intercept at bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.full(_SIZE, -1, np.int32)
        dense[pick] = np.arange(len(pick), dtype=np.int32)
        label, size, flat = [], [], []
        for batch in batches:
            label.append(np.asarray(batch.column(0)).astype(np.int64))
            lists = batch.column(1)
            size.append(np.diff(np.asarray(lists.offsets)))
            flat.append(dense[np.asarray(lists.flatten())])
        if label:
            w, b = fit(np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(size))]), np.concatenate(label), ratio)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(pick, -1), pa.int32()), pa.array(np.append(w * ratio, b))], names=["bucket", "weight"])

    return run


class Model(NamedTuple):
    weight: np.ndarray  # float32 by bucket: coefficient times ratio, 0 for all that aren't features
    intercept: float


def fit(bucket: np.ndarray, offsets: np.ndarray, label: np.ndarray, ratio: np.ndarray, ridge: float = RIDGE, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on presence * ratio by accelerated gradient descent; rows by offsets, classes weighted alike."""
    value, column = ratio[bucket], bucket
    n, rows = len(label), np.repeat(np.arange(len(label), dtype=np.int32), np.diff(offsets))
    weight_row = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, n - label.sum()))
    norm = np.bincount(rows, value * value, minlength=n)
    step = 4.0 / float((weight_row * (norm + 1.0)).sum())  # at most the inverse of the loss's curvature
    w, b, at_w, at_b = np.zeros(len(ratio)), 0.0, np.zeros(len(ratio)), 0.0
    for i in range(rounds):
        z = np.bincount(rows, value * at_w[column], minlength=n) + at_b
        e = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label) * weight_row
        new_w = at_w - step * (np.bincount(column, value * e[rows], minlength=len(ratio)) + ridge * at_w / max(1.0, float(np.sqrt(n))))
        new_b = at_b - step * e.sum()
        momentum = i / (i + 3)
        at_w, at_b = new_w + momentum * (new_w - w), new_b + momentum * (new_b - b)
        w, b = new_w, new_b
    return w, b


def _information(toxic_n: int, clean_n: int) -> Column:
    """Mutual information of a bucket's presence in a document and the document's class."""
    n = float(toxic_n + clean_n)
    present = F.col("toxic") + F.col("clean")

    def cell(both: Column, margin: Column, class_n: int) -> Column:
        return F.when(both > 0, both / n * F.log(both * n / (margin * class_n))).otherwise(0.0)

    absent = n - present
    return cell(F.col("toxic"), present, toxic_n) + cell(F.col("clean"), present, clean_n) + cell(toxic_n - F.col("toxic"), absent, toxic_n) + cell(clean_n - F.col("clean"), absent, clean_n)


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled documents among these rows."""
    spark = documents.sparkSession
    known = labels.where(F.col(f"`{label_col}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(F.col(f"`{label_col}`")).cast("int").alias("toxic"))
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = texts.join(known.hint("merge"), "id")  # the same join at every size
    chunks = rows.select("toxic", "text").mapInArrow(_counted, "chunk int, data binary")
    counts = written(chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, "bucket int, clean long, toxic long"), "toxic-grams")
    whole = counts.where("bucket = -1").first()
    clean_n, toxic_n = (int(whole.clean), int(whole.toxic)) if whole else (0, 0)
    if not clean_n or not toxic_n:
        share = toxic_n / max(1, clean_n + toxic_n)
        return Model(np.zeros(_SIZE, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    p, q = F.col("toxic") + 0.5, F.col("clean") + 0.5
    ratio_ = F.log(p / (toxic_n + 1.0)) - F.log(q / (clean_n + 1.0))
    error = F.sqrt(1 / p - 1 / (toxic_n + 1.0) + 1 / q - 1 / (clean_n + 1.0) + 1e-12)
    table = counts.where("bucket >= 0").select("bucket", ratio_.alias("ratio"), (F.abs(ratio_) / error).alias("strength"), _information(toxic_n, clean_n).alias("information"))
    table = table.where(F.col("strength") >= SIGNIFICANCE).orderBy(F.desc("information"), "bucket").limit(FEATURES).toPandas()
    pick, ratio = table["bucket"].to_numpy(np.int64), table["ratio"].to_numpy(np.float64)
    wanted = np.zeros(_SIZE, bool)
    wanted[pick] = True
    if not len(pick):
        return Model(np.zeros(_SIZE, np.float32), float(np.log(toxic_n / clean_n)))
    order = [F.xxhash64("id"), F.col("id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(SAMPLE).union(known.where("toxic = 0").orderBy(*order).limit(SAMPLE))
    chosen = texts.join(F.broadcast(sample), "id").select("toxic", "text")  # the sample has at most 2 * SAMPLE rows
    features = chosen.mapInArrow(_featured(spark.sparkContext.broadcast(wanted)), "toxic int, buckets array<int>")
    rows = features.repartition(1).mapInArrow(_fitted(pick, ratio), "bucket int, weight double").toPandas()  # the sample is bounded, and so is this task
    weight = np.zeros(_SIZE, np.float32)
    own = rows["bucket"].to_numpy() >= 0
    weight[rows["bucket"].to_numpy()[own]] = rows["weight"].to_numpy()[own]
    return Model(weight, float(rows["weight"].to_numpy()[~own].sum()))


def score(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of each row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        wanted = m.weight != 0
        for batch in batches:
            for s in K.slices(batch.column(1)):
                row, bucket = _present(s, wanted)
                z = np.bincount(row, m.weight[bucket].astype(np.float64), minlength=s.rows) + m.intercept
                p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.rows), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3, F.lit(-1)) == 1
    model = learn(documents.where(~held_out & F.col("doc_id").isNotNull()), spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out))
    return score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
