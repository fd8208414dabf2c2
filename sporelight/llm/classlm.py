"""Brown class-based n-gram scoring.

Words are grouped into classes by the exchange algorithm: a word moves to the
class that raises the class-bigram mutual information most, until no word moves.
A text's probability is the product over its tokens of class transition times
word emission, both with additive smoothing; the document's start and end are one
end token, which is a class by itself.

Every word gets a class:

* the ``CLUSTERED`` most frequent ones by the exchange itself, all other words
  being one fixed context and the end another;
* of the rest, those above a count threshold (the least that leaves at most
  ``ASSIGNED`` of them) by exchange against the classes so found: each goes where
  its neighbours' classes raise the mutual information most, in Spark, from sums
  of its contexts;
* words beyond that, and unseen ones, to the class that holds most tokens with
  their last three bytes.

What is gathered covers all training documents and grows with them:

1. counts of every distinct token (map-side sums, one shuffle, a written table);
   thresholds come from a histogram of the counts, a row for each sixteenth of a
   power of two, so nothing is sorted or limited;
2. bigrams among the clustered words, then contexts of the assigned ones by class,
   then transitions between the classes of all tokens: sums of tables whose size
   the parameters bound;
3. scoring, narrow: the ``HEAD`` most frequent tokens' counts are broadcast (a
   fixed number of rows), tokens beyond them become (document, token) rows that
   meet the count table in a join and are added up again by document.

A class's words and one unseen word share its probability: emissions add up to 1.

Rules of the words and of the base score are in :func:`score`.

Edge cases: null and empty texts consist of the end token alone; rows with a
null id are learned from and not held out; repeated rows are counted and scored
each; without training rows every token is unseen; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .store import written

CLASSES = 48
CLUSTERED = 1000
ASSIGNED = 1 << 18
HEAD = 1 << 18
TRANSITION_SMOOTHING = 0.5
EMISSION_SMOOTHING = 0.1
END = np.uint64(0x5EED0E0D)
ENDINGS = 1 << 16
_FLUSH = 1 << 20  # tokens that a worker sums up at once


def _tokens(s: K.Slice, *, endings: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Hash of each token, an end after each row's words; offsets by row; and the bucket of each token's last bytes."""
    data = K.fold(s.data)
    start, end, offsets = K.runs(data, s.offsets, K.SPACE_WORDS)
    out = np.full(len(start) + s.rows, END, np.uint64)
    at = np.arange(len(start)) + K.doc_of(offsets)
    out[at] = K.hash_runs(data, start, end)
    tail = None
    if endings:
        tail = np.zeros(len(out), np.int32)
        last = np.zeros(len(start), np.uint64)
        for back in (1, 2, 3):
            inside = end - back >= start
            last = last << np.uint64(8) | np.where(inside, data[np.maximum(end - back, 0)], 0).astype(np.uint64) if len(start) else last
        tail[at] = (K.mix(last) & np.uint64(ENDINGS - 1)).astype(np.int32)
    return out, offsets + np.arange(s.rows + 1), tail


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        token, tail = (np.concatenate(x) for x in zip(*held, strict=True))
        value, first, n = np.unique(token, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(tail[first], pa.int32()), pa.array(n.astype(np.int64))], names=["h", "e", "c"])

    for batch in batches:
        for s in K.slices(batch.column(0)):
            token, _, tail = _tokens(s, endings=True)
            held.append((token, tail))
            size += len(token)
            if size > _FLUSH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


class Lookup(NamedTuple):
    known: np.ndarray  # sorted hashes
    value: np.ndarray

    def of(self, token: np.ndarray, default) -> np.ndarray:
        if not len(self.known):
            return np.broadcast_to(np.asarray(default, self.value.dtype), token.shape).copy()
        spot = np.minimum(np.searchsorted(self.known, token), len(self.known) - 1)
        return np.where(self.known[spot] == token, self.value[spot], default)

    @staticmethod
    def build(hashes: np.ndarray, value: np.ndarray) -> Lookup:
        order = np.argsort(hashes)
        return Lookup(hashes[order], value[order])


def _summed(shared, cells: int, cells_of):
    """Counts of the cells that ``cells_of`` finds in a slice, summed by worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for s in K.slices(batch.column(0)):
                if s.rows:
                    total += np.bincount(cells_of(s, shared.value), minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["cell", "n"])

    return run


def _table(texts: DataFrame, shared, side: int, cells_of) -> np.ndarray:
    sums = texts.mapInArrow(_summed(shared, side * side, cells_of), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(side * side, np.int64)
    out[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out.reshape(side, side)


def _pairs(now: np.ndarray, side: int, end: int) -> np.ndarray:
    return np.concatenate([[end], now[:-1]]) * side + now  # each row follows an end


def _word_pairs(s: K.Slice, clustered: Lookup) -> np.ndarray:
    """Bigrams of clustered words; then the end, then all others."""
    n = len(clustered.known)
    token = _tokens(s)[0]
    return _pairs(np.where(token == END, n, clustered.of(token, n + 1)), n + 2, n)


def _class_pairs(s: K.Slice, classes: Classes) -> np.ndarray:
    token, _, tail = _tokens(s, endings=True)
    return _pairs(classes.of(token, tail), classes.end + 1, classes.end)


def _contexts(shared):
    """(number of an assigned word, side and class of its neighbour, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, numbered, end = shared.value
        width = end + 2  # classes, the end, and words without a class so far
        for batch in batches:
            for s in K.slices(batch.column(0)):
                token = _tokens(s)[0]
                own, number = np.where(token == END, end, label.of(token, end + 1)), numbered.of(token, -1)
                before = np.concatenate([[end], own[:-1]])
                after = np.append(own[1:], end)
                mine = np.flatnonzero(number >= 0)
                cells = np.concatenate([number[mine] * 2 * width + before[mine], number[mine] * 2 * width + width + after[mine]])
                cell, n = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell // (2 * width), pa.int32()), pa.array(cell % (2 * width), pa.int32()), pa.array(n.astype(np.int64))], names=["number", "cell", "n"])

    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(n: np.ndarray, classes: int, fixed: int = 0) -> np.ndarray:
    """Class of each word from a square table of bigram counts among words of descending frequency.

    The last ``fixed`` rows and columns are contexts that stay classes by themselves.
    Each move raises the mutual information, so the sweeps come to an end."""
    words, all_ = len(n) - fixed, classes + fixed
    n = n.astype(np.float64)
    label = np.concatenate([np.arange(words) % classes, np.arange(classes, all_)])
    uni_l, uni_r = n.sum(1), n.sum(0)
    member = np.zeros((len(n), all_))
    member[np.arange(len(n)), label] = 1
    table = member.T @ n @ member
    left, right = member.T @ uni_l, member.T @ uni_r
    moved = True
    while moved:
        moved = False
        for w in range(words):
            a, own = label[w], n[w, w]
            r, l = n[w] @ member, n[:, w] @ member
            r[a] -= own
            l[a] -= own
            member[w, a] = 0
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= own
            left[a] -= uni_l[w]
            right[a] -= uni_r[w]
            base = _f(table)
            row = _f(table + r[None, :]) - base  # w joins the row's class
            col = _f(table + l[:, None]) - base
            diagonal = np.diagonal(table)
            gain = row.sum(1) - np.diagonal(row) + col.sum(0) - np.diagonal(col) + _f(diagonal + r + l + own) - np.diagonal(base)
            gain -= _f(left + uni_l[w]) - _f(left) + _f(right + uni_r[w]) - _f(right)
            gain = gain[:classes]
            b = int(gain.argmax()) if gain.max() > gain[a] + 1e-6 * max(1.0, abs(gain[a])) else a
            moved |= b != a
            label[w], member[w, b] = b, 1
            table[b] += r
            table[:, b] += l
            table[b, b] += own
            left[b] += uni_l[w]
            right[b] += uni_r[w]
    return label[:words]


def _assigned(shared):
    """Best class of each word by what its contexts add to the mutual information of the classes found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        width, classes = len(table), len(table) - 2
        left, right = table.sum(1)[:classes], table.sum(0)[:classes]
        after, before = table[:classes], table.T[:classes]  # by class and neighbour
        sides = np.concatenate([before, after], axis=1)
        base = _f(sides)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cells = part.column(1)
                offsets = np.asarray(cells.offsets).astype(np.int64)
                flat = cells.flatten()
                cell, n = np.asarray(flat.field(0)).astype(np.int64), np.asarray(flat.field(1)).astype(np.float64)
                offsets = offsets - offsets[0]
                gain = _f(sides[:, cell] + n) - base[:, cell]
                gain = np.add.reduceat(gain, offsets[:-1], axis=1)  # every word has a context
                times = np.add.reduceat(n * (cell >= width), offsets[:-1])
                gain -= _f(left[:, None] + times) - _f(left)[:, None] + _f(right[:, None] + times) - _f(right)[:, None]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(gain.argmax(0).astype(np.int32))], names=["number", "class"])

    return run


class Classes(NamedTuple):
    label: Lookup  # classes of the clustered and assigned words
    ending: np.ndarray  # class by bucket of the last bytes, for all others
    end: int  # class of the end, the last one

    def of(self, token: np.ndarray, tail: np.ndarray) -> np.ndarray:
        return np.where(token == END, self.end, self.label.of(token, self.ending[tail])).astype(np.int64)


class Model(NamedTuple):
    classes: Classes
    transition: np.ndarray  # log10 probabilities by class
    emission: np.ndarray  # log10 denominator of each class
    head: Lookup  # counts of the broadcast tokens
    tokens: int
    distinct: int
    smoothing: float


def _most_frequent(counts: DataFrame, limit: int) -> int:
    """Least count that at most ``limit`` tokens reach."""
    size = F.floor(F.log2(F.col("c")) * 16)
    rows = counts.groupBy(size.alias("bin")).agg(F.min("c").alias("least"), F.count("*").alias("n")).collect()  # at most 16 rows a power of two
    least, seen = None, 0
    for r in sorted(rows, key=lambda r: -r.bin):
        seen += r.n
        if seen > limit:
            break
        least = r.least
    return least if least is not None else max((r.least for r in rows), default=0) * 2 + 1


def learn(training: DataFrame, *, text_col: str = "text", classes: int = CLASSES, clustered: int = CLUSTERED, assigned: int = ASSIGNED) -> tuple[Model, DataFrame]:
    """The model, and the table of all token counts (h, e, c)."""
    share = training.sparkSession.sparkContext.broadcast
    texts = training.select(F.col(f"`{text_col}`").alias("text"))
    counts = written(texts.mapInArrow(_counts, "h long, e int, c long").groupBy("h").agg(F.max("e").alias("e"), F.sum("c").alias("c")), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least, least_head = _most_frequent(counts, assigned), _most_frequent(counts, HEAD)
    frame = counts.where(F.col("c") >= min(least, least_head)).toPandas()  # at most the larger bound
    hashes, c, e = frame["h"].to_numpy(np.int64).view(np.uint64), frame["c"].to_numpy(np.int64), frame["e"].to_numpy(np.int64)
    head = Lookup.build(hashes[c >= least_head], c[c >= least_head])

    words = (c >= least) & (hashes != END)
    hashes, c, e = hashes[words], c[words], e[words]
    order = np.lexsort((hashes, -c))
    hashes, c, e = hashes[order], c[order], e[order]
    k = min(clustered, len(hashes))
    n = _table(texts, share(Lookup.build(hashes[:k], np.arange(k))), k + 2, _word_pairs)
    label = np.zeros(len(hashes), np.int64)
    label[:k] = exchange(n, classes, 2)
    if len(hashes) > k:
        member = np.zeros((k + 2, classes + 2))
        member[np.arange(k + 2), np.append(label[:k], [classes, classes + 1])] = 1
        numbered = Lookup.build(hashes[k:], np.arange(k, len(hashes)))
        both = share((Lookup.build(hashes[:k], label[:k]), numbered, classes))
        sums = texts.mapInArrow(_contexts(both), "number int, cell int, n long").groupBy("number", "cell").agg(F.sum("n").alias("n"))
        cells = sums.groupBy("number").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))  # at most a cell for each side and class
        found = cells.mapInArrow(_assigned(share(member.T @ n @ member)), "number int, class int").toPandas()  # at most ``assigned`` rows
        label[found["number"].to_numpy(np.int64)] = found["class"].to_numpy(np.int64)

    by_ending = np.bincount(e * classes + label, c, minlength=ENDINGS * classes).reshape(ENDINGS, classes)
    ending = np.where(by_ending.any(1), by_ending.argmax(1), by_ending.sum(0).argmax()).astype(np.uint8)
    all_ = Classes(Lookup.build(hashes, label.astype(np.uint8)), ending, classes)
    between = _table(texts, share(all_), classes + 1, _class_pairs)
    transition = np.log10((between + TRANSITION_SMOOTHING) / (between.sum(1, keepdims=True) + TRANSITION_SMOOTHING * (classes + 1)))
    # distinct words of each class; a class also keeps room for one unseen word
    kinds = np.bincount(label, minlength=classes + 1).astype(np.float64)
    kinds[classes] = totals.n > 0
    rest = counts.where((F.col("c") < least) & (F.col("h") != F.lit(int(END)))).groupBy("e").agg(F.count("*").alias("n")).toPandas()  # at most ENDINGS rows
    kinds += np.bincount(ending[rest["e"].to_numpy(np.int64)], rest["n"].to_numpy(np.float64), minlength=classes + 1)
    emission = np.log10(between.sum(0) + EMISSION_SMOOTHING * (kinds + 1))
    return Model(all_, transition, emission, head, int(totals.n), int(totals.v), EMISSION_SMOOTHING), counts


_SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, own double, h array<long>, m array<int>"


def _scored(shared, base_smoothing: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for s in K.slices(batch.column(1)):
                token, offsets, ending = _tokens(s, endings=True)
                cls = m.classes.of(token, ending)
                before = np.concatenate([[m.classes.end], cls[:-1]])
                count = m.head.of(token, -1)
                tail = count < 0 if m.distinct > len(m.head.known) else np.zeros(len(token), bool)
                count = np.where(count < 0, 0, count)
                own = m.transition[before, cls] - m.emission[cls] + np.where(tail, 0.0, np.log10(count + m.smoothing))
                base = np.where(tail, 0.0, np.log10(count + base_smoothing)) - np.log10(m.tokens + base_smoothing * (m.distinct + 1))
                doc = K.doc_of(offsets)
                rare, which = token[tail], doc[tail]
                order = np.lexsort((rare, which))
                rare, which = rare[order], which[order]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (which[1:] != which[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(rare))).astype(np.int32)
                lists = pa.array(np.searchsorted(which[at], np.arange(s.rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(s.rows)),
                        batch.column(0).slice(s.first, s.rows),
                        pa.array(np.diff(offsets)),
                        pa.array(K.sums_by_doc((count > 0) & ~tail, offsets)),
                        pa.array(K.sums_by_doc(base, offsets)),
                        pa.array(K.sums_by_doc(own, offsets)),
                        pa.ListArray.from_arrays(lists, pa.array(rare[at].view(np.int64))),
                        pa.ListArray.from_arrays(lists, pa.array(times)),
                    ],
                    names=["row", "doc_id", "n_tokens", "n_known", "base", "own", "h", "m"],
                )
                row += s.rows

    return run


def score(documents: DataFrame, model: Model, counts: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base_smoothing: float = 0.1) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score, perplexity`` of each row.

    Tokens are runs of anything but ASCII white space after lower-casing A-Z,
    then one end.  ``base_score`` is the additive unigram score of the same
    counts, ``score`` the class model's log10 probability."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = written(source.mapInArrow(_scored(shared, base_smoothing), _SCORED), "scored")
    rare = scored.where(F.size("h") > 0).select("row", F.explode(F.arrays_zip("h", "m")).alias("x")).select("row", "x.h", "x.m").join(counts, "h", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("known"),
        F.sum(F.col("m") * F.log10(c + F.lit(base_smoothing))).alias("more_base"),
        F.sum(F.col("m") * F.log10(c + F.lit(model.smoothing))).alias("more_own"),
    )
    out = scored.select("row", "doc_id", "n_tokens", "n_known", "base", "own").join(sums, "row", "left")
    own = F.col("own") + F.coalesce("more_own", F.lit(0.0))
    return out.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), own.alias("score"), F.pow(F.lit(10.0), -own / F.col("n_tokens")).alias("perplexity"))


def query(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10, F.lit(-1))
    model, counts = learn(documents.where(remainder != 0))
    return score(documents, model, counts).select("doc_id", (remainder == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
