"""Language identification as inference of a language mixture.

Each language has a smoothed model of hashed byte n-grams (orders 1 to 4, inside a word
with its boundaries) learned from the labelled training documents.  A document
is a mixture: each of its words was written in one of its languages, with
likelihood given by the word's n-grams.  Expectation-maximisation estimates the
proportions until they change by less than ``TOLERANCE``; starting from all languages, the one with the least share is taken
away step by step, and the set with the largest penalised likelihood (a BIC
term for each language) is the document's.  The prediction is its largest
member, the score that member's share.

Training is one pass over all training documents with counts added up map-side;
the driver gets at most ``BUCKETS`` sums for each language, the workers a table
of that size.  Inference is narrow and runs over whole texts in slices.

Edge cases: null texts and texts without a letter get ``und`` with score 0, as
does everything when nothing could be learned; a null lang is not learned from;
rows with a null id are not learned from and not held out; repeated rows get
the same answer; ties go to the first language by name; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.2
TOLERANCE = 1e-4  # change of a share at which a document's estimate has converged
PENALTY = 3.0

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = True
_LETTERS[0x80:] = True


def _padded(s: K.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of the slice, each word between two zero bytes: bytes, word starts and ends there, word offsets by row."""
    data = K.fold(s.data)
    start, end, offsets = K.runs(data, s.offsets, _LETTERS)
    size = end - start
    place = np.cumsum(size + 2) - size - 2
    out = np.zeros(int((size + 2).sum()), np.uint32)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(place + 1, size) + step] = data[np.repeat(start, size) + step]
    return out, place, place + size + 2, offsets


def _places(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place of each byte in its word; words follow each other."""
    return np.arange(int((end - start).sum())) - np.repeat(start - start[0], end - start)


def _grams(x: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that ends at each byte; it lies in one word where the byte's place there is at least order - 1."""
    h = np.full(len(x), np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF))
    for back in range(order):
        h *= np.uint32(0x85EBCA6B)
        h[back:] += x[: len(x) - back] + np.uint32(1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    return h >> np.uint32(16)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for s in K.slices(batch.column(1)):
            x, start, end, offsets = _padded(s)
            if len(x) == 0:
                continue
            edge = np.concatenate([[0], end])[offsets]  # byte range of each row
            own = np.array(langs[s.first : s.first + s.rows])
            row, place = np.repeat(np.arange(s.rows), np.diff(edge)), _places(start, end)
            grams = [(order, _grams(x, order)) for order in ORDERS]
            for lang in set(own.tolist()):
                mine = (own == lang)[row]
                sums = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for order, gram in grams:
                    sums += np.bincount(gram[mine & (place >= order - 1)], minlength=BUCKETS)
    for lang, sums in total.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[at])], names=["lang", "bucket", "n"])


class Model:
    def __init__(self, languages: list[str], logp: np.ndarray):
        self.languages, self.logp = languages, logp  # BUCKETS x languages

    def word_scores(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word in each language, up to a constant of the word.  Each distinct word is scored once."""
        if len(start) == 0 or not self.languages:
            return np.zeros((len(start), len(self.languages)), np.float32)
        data = x.astype(np.uint8)
        _, first, which = np.unique(K.hash_runs(data, start, end), return_index=True, return_inverse=True)
        size = (end - start)[first]
        place = np.cumsum(size) - size
        own = x[np.repeat(start[first] - place, size) + np.arange(size.sum())]
        out, at = np.zeros((len(first), len(self.languages)), np.float32), _places(place, place + size)
        for order in ORDERS:
            out += np.add.reduceat(np.where((at >= order - 1)[:, None], self.logp[_grams(own, order)], 0), place, axis=0)
        out /= len(ORDERS)
        return (out - out.max(axis=1, keepdims=True))[which.reshape(-1)]


def learn(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from every row with a text and a language."""
    rows = documents.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = rows.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique().tolist())
    counts = np.zeros((BUCKETS, len(languages)))
    number = {lang: i for i, lang in enumerate(languages)}
    counts[sums["bucket"].to_numpy(np.int64), sums["lang"].map(number).to_numpy(np.int64) if len(sums) else np.zeros(0, np.int64)] = sums["n"].to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(0, keepdims=True) + SMOOTHING * BUCKETS)
    return Model(languages, np.log(p).astype(np.float32))


def _converge(like: np.ndarray, share: np.ndarray, starts: np.ndarray, count: np.ndarray) -> None:
    """Expectation-maximisation of each row's proportions, in place, until none of a row's changes by ``TOLERANCE``.

    A row that has converged is left as it is, whatever its neighbours still do."""
    live, owner = np.arange(len(share)), np.repeat(np.arange(len(share)), count)
    going = np.ones(len(live), bool)
    while True:
        joint = like * share[live][owner]
        joint /= joint.sum(1, keepdims=True)
        new = np.add.reduceat(joint, starts, axis=0) / count[:, None]
        moves = np.abs(new - share[live]).max(1) > TOLERANCE
        share[live[going]] = new[going]
        going &= moves
        if not going.any():
            return
        if going.mean() < 0.7:
            kept = going[owner]
            like, count, live = like[kept], count[going], live[going]
            starts, owner = np.cumsum(count) - count, np.repeat(np.arange(len(live)), count)
            going = np.ones(len(live), bool)


def mixtures(score: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the selected languages for each row (zero elsewhere), rows without words all zero; and the penalised likelihoods."""
    rows, k = len(offsets) - 1, score.shape[1]
    words = np.diff(offsets)
    full = np.flatnonzero(words)
    best = np.zeros((rows, k))
    value = np.full(rows, -np.inf)
    if len(full) == 0 or k == 0:
        return best, value
    first, count = offsets[:-1][full], words[full]
    like = np.exp(np.maximum(score, -60.0)).astype(np.float64)
    owner = np.repeat(np.arange(len(full)), count)
    share = np.full((len(full), k), 1.0 / k)
    active = np.ones((len(full), k), bool)
    top, top_value = share.copy(), np.full(len(full), -np.inf)
    starts = first - first[0]
    for left in range(k, 0, -1):
        share = np.where(active, share, 0.0)
        share /= share.sum(1, keepdims=True)
        if left > 1:
            _converge(like, share, starts, count)
        total = (like * share[owner]).sum(1)
        log = np.add.reduceat(np.log(total), starts)
        now = log - PENALTY * left * np.log(count + 1.0)
        better = now > top_value
        top[better], top_value[better] = share[better], now[better]
        least = np.where(active, share, np.inf)
        active[np.arange(len(full)), k - 1 - least[:, ::-1].argmin(1)] = False
        share = np.maximum(share, 1e-6)
    best[full], value[full] = top, top_value
    return best, value


def _has_letter(s: K.Slice) -> np.ndarray:
    ascii_ = np.concatenate([[0], np.cumsum(_LETTERS[s.data] & (s.data < 0x80))])
    high = np.concatenate([[0], np.cumsum(s.data >= 0x80)])
    out = ascii_[s.offsets[1:]] > ascii_[s.offsets[:-1]]
    for i in np.flatnonzero(~out & (high[s.offsets[1:]] > high[s.offsets[:-1]])).tolist():
        out[i] = any(c.isalpha() for c in s.data[s.offsets[i] : s.offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def identify(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, languages`` (map of the selected languages' shares)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"], object)
        for batch in batches:
            for s in K.slices(batch.column(1)):
                x, start, end, offsets = _padded(s)
                share, _ = mixtures(m.word_scores(x, start, end), offsets)
                known = _has_letter(s) & (share.sum(1) > 0) & ~s.null
                pick = np.where(known, share.argmax(1) if share.shape[1] else 0, len(m.languages))
                score = np.where(known, share.max(1, initial=0.0), 0.0)
                parts = [[(m.languages[j], float(share[i, j])) for j in np.flatnonzero(share[i] > 0)] if known[i] else [] for i in range(s.rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.rows), pa.array(names[pick], pa.string()), pa.array(np.minimum(score, 1.0)), pa.array(parts, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "languages"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, languages map<string,double>")


def remainder(m: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo m (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % m


def query(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(documents.where(remainder(5) != 0))
    found = identify(documents, model)
    return found.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
