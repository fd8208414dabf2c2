"""Quality rules with line sequence labelling: a linear-chain CRF marks each line content or boilerplate.

Every line is described by a handful of binned shape features (word count, word
length, shares of capitals, digits and symbols, closing mark, repeats, rule
characters, leading bullet).  A conditional random field over the sequence of a
document's lines scores labels by these features and by neighbouring labels;
Viterbi decoding gives the best labelling, and the share of non-space characters
in content lines decides: a document is kept if it isn't failed by the base
rules and its content share is at least ``MIN_CONTENT``.

There is no line-level truth, only each document's quality, so the field is
learned by expectation-maximisation with the quality as a constraint on the
document's lines as a whole (a bag).  At first each line is scored alone, by the
log-odds of its features between documents of quality 1 and 0.  Then, ``ROUNDS``
times: Viterbi labels the lines such that the content share of a document of
quality 1 is at least ``MIN_CONTENT`` and that of quality 0 below it, by the
least of a few biases that reaches this; the field is fitted to these labels by
its exact conditional likelihood (forward-backward).  So the lines of a document
may differ, and label transitions are learned from where they do.

Training takes at most ``SAMPLE`` labelled documents of each quality, those with
the least hash of the id, in the order of that hash.  Without both qualities
among the labels, every line is content.

Base rules (whole texts): ``n_words`` words of anything but ASCII white space,
``word_chars`` code points in words, ``n_symbols`` characters of ``#*$%&|<>``,
``n_dup_lines`` lines with a word that equal an earlier line, ``n_repeat_words``
words inside 3-word windows found twice or more; base_failed if n_words < 50 or
100 * n_repeat_words > 50 * n_words.

One narrow pass labels all documents.  Edge cases: null and empty texts have no
words and fail; repeated rows are judged alike; labels that are null or other
than 0 and 1 teach nothing; an empty table gives no rows; other columns are
ignored, and :func:`keep` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import kernel as K

MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_CONTENT = 0.5
SAMPLE = 3000
ROUNDS = 4
BIASES = (0.0, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
SLICE_BYTES = 1 << 19
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_ANY = np.ones(256, dtype=bool)

#: Bins of each feature; a line has one value of each.
BINS = (5, 5, 4, 4, 5, 3, 2, 3, 2)
FIRST = np.concatenate([[0], np.cumsum(BINS)[:-1]])
FEATURES = int(sum(BINS))


class Lines(NamedTuple):
    feature: np.ndarray  # lines x features: index of the active bin
    chars: np.ndarray  # non-space code points
    offsets: np.ndarray  # lines by row


def _bin(x: np.ndarray, edges: tuple) -> np.ndarray:
    return np.searchsorted(np.asarray(edges, float), x, side="right")


def _count(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def describe(s: K.Slice) -> tuple[np.ndarray, Lines]:
    """Base figures by row (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the lines."""
    data = s.data
    start, end, word_at = K.runs(data, s.offsets, K.SPACE_WORDS)
    leads = _count((data & 0xC0) != 0x80)
    symbols = _count(_SYMBOLS[data])
    n_words = np.diff(word_at)
    word_chars = K.sums_by_doc(leads[end] - leads[start], word_at)
    n_symbols = symbols[s.offsets[1:]] - symbols[s.offsets[:-1]]

    # lines: every row has one more than it has line feeds
    feed = np.flatnonzero(data == 10)
    row_of_feed = np.searchsorted(s.offsets, feed, side="right") - 1
    per_row = np.bincount(row_of_feed, minlength=s.rows) + 1
    line_at = np.concatenate([[0], np.cumsum(per_row)])
    begin, stop = np.zeros(line_at[-1], np.int64), np.zeros(line_at[-1], np.int64)
    begin[line_at[:-1]], stop[line_at[1:] - 1] = s.offsets[:-1], s.offsets[1:]
    inner = np.ones(line_at[-1], bool)
    inner[line_at[1:] - 1] = False
    stop[inner] = feed
    inner = np.ones(line_at[-1], bool)
    inner[line_at[:-1]] = False
    begin[inner] = feed + 1
    w0, w1 = np.searchsorted(start, begin), np.searchsorted(start, stop)
    words = w1 - w0
    line_hash = K.hash_runs(data, begin, stop)
    line_row = K.doc_of(line_at)
    order = np.lexsort((line_hash, line_row))  # stable: earlier lines first among equals
    again = np.zeros(len(order), bool)
    if len(order):
        a, b = order[:-1], order[1:]
        again[b] = (line_hash[a] == line_hash[b]) & (line_row[a] == line_row[b])
    again &= words > 0
    n_dup = np.bincount(line_row[again], minlength=s.rows)

    # words in 3-word windows met at least twice in the row
    word = K.hash_runs(data, start, end)
    window, ok = K.window_hash(word, 3), K.whole_windows(word_at, 3, len(word))
    place = np.flatnonzero(ok)
    row_of_word = K.doc_of(word_at)
    key = K.mix(window[place] + row_of_word[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = place[times[inverse.reshape(-1)] > 1]
    hit = np.zeros(len(word) + 3, bool)
    for k in range(3):
        hit[twice + k] = True
    n_repeat = K.sums_by_doc(hit[: len(word)], word_at)

    upper, lower = _count((data >= 0x41) & (data <= 0x5A)), _count((data >= 0x61) & (data <= 0x7A))
    digit, bar, bang = _count((data >= 0x30) & (data <= 0x39)), _count(data == 0x7C), _count(data == 0x21)
    wc = _count(np.zeros(0, bool)) if not len(start) else np.concatenate([[0], np.cumsum(leads[end] - leads[start])])
    chars = wc[w1] - wc[w0]
    total = np.maximum(chars, 1)
    between = lambda c: c[stop] - c[begin]
    share_repeat = _count(hit[: len(word)])
    last = np.where(words > 0, data[np.maximum(end[np.maximum(w1 - 1, 0)] - 1, 0)] if len(end) else 0, 0)
    letters = between(upper) + between(lower)
    feature = np.stack(
        [
            _bin(words, (1, 3, 8, 40)),
            _bin(chars / np.maximum(words, 1), (2.5, 5.0, 8.0, 11.0)),
            _bin(between(upper) / np.maximum(letters, 1), (0.1, 0.3, 0.6)),
            _bin(between(digit) / total, (0.02, 0.1, 0.3)),
            _bin(between(symbols) / total, (0.005, 0.03, 0.08, 0.2)),
            np.where(np.isin(last, [0x2E, 0x3F]), 2, np.where(((last | 32) >= 0x61) & ((last | 32) <= 0x7A) | (last >= 0x80), 1, 0)),
            again.astype(np.int64),
            _bin((share_repeat[w1] - share_repeat[w0]) / np.maximum(words, 1), (0.2, 0.5)),
            ((between(bar) + between(bang)) > 0.05 * total).astype(np.int64),
        ],
        axis=1,
    )
    base = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], axis=1)
    return base, Lines(feature + FIRST, chars, line_at)


class Field(NamedTuple):
    weight: np.ndarray  # features x 2 labels (0 boilerplate, 1 content)
    move: np.ndarray  # 2 x 2


def _steps(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each line number: the rows that have it, longest first, and that line's index."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    first, size = offsets[:-1][order], size[order]
    for j in range(int(size.max(initial=0))):
        m = int(np.searchsorted(-size, -j, side="left"))
        yield order[:m], first[:m] + j


def viterbi(score: np.ndarray, offsets: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label of each line; all rows advance together. Ties go to content."""
    back = np.zeros(score.shape, np.int8)
    value = np.zeros((len(offsets) - 1, 2))
    seen = []
    for j, (rows, line) in enumerate(_steps(offsets)):
        if j:
            step = value[rows][:, :, None] + move[None]
            back[line] = 1 - step[:, ::-1].argmax(1)
            value[rows] = step.max(1) + score[line]
        else:
            value[rows] = score[line]
        seen.append((rows, line))
    label = np.zeros(len(score), np.int8)
    now = np.zeros(len(offsets) - 1, np.int64)
    size = np.diff(offsets)
    for j in range(len(seen) - 1, -1, -1):
        rows, line = seen[j]
        ends = size[rows] == j + 1
        now[rows[ends]] = value[rows[ends], 1] >= value[rows[ends], 0]
        label[line] = now[rows]
        now[rows] = back[line, now[rows]]
    return label


def _expected(score: np.ndarray, offsets: np.ndarray, move: np.ndarray, steps: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each line, and expected label pairs summed over all rows (forward-backward)."""
    forward, backward, steps = np.zeros(score.shape), np.zeros(score.shape), steps or list(_steps(offsets))
    add = np.logaddexp
    for j, (_, line) in enumerate(steps):
        forward[line] = score[line]
        if j:
            before = forward[line - 1][:, :, None] + move[None]
            forward[line] += add(before[:, 0], before[:, 1])
    for _, line in reversed(steps[1:]):
        after = move[None] + (score[line] + backward[line])[:, None, :]
        backward[line - 1] = add(after[:, :, 0], after[:, :, 1])
    both = forward + backward
    norm = add(both[:, 0], both[:, 1])
    inner = np.concatenate([line for _, line in steps[1:]]) if len(steps) > 1 else np.zeros(0, np.int64)
    pairs = np.exp(forward[inner - 1][:, :, None] + move[None] + (score[inner] + backward[inner])[:, None, :] - norm[inner][:, None, None]).sum(0)
    return np.exp(both - norm[:, None]), pairs


def train(feature: np.ndarray, offsets: np.ndarray, label: np.ndarray, rounds: int = 60, ridge: float = 1e-3, start: Field | None = None) -> Field:
    """Maximum conditional likelihood by RPROP ascent; lines by offsets, one label for each line."""
    weight, move = (start.weight.copy(), start.move.copy()) if start else (np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    n = max(1, len(label))
    inner = np.ones(len(label), bool)
    inner[offsets[:-1][np.diff(offsets) > 0]] = False
    at = np.flatnonzero(inner)
    truth = np.zeros((2, 2))
    np.add.at(truth, (label[at - 1], label[at]), 1)
    hard, steps = np.eye(2)[label], list(_steps(offsets))
    step, before = np.full(FEATURES * 2 + 4, 0.1), np.zeros(FEATURES * 2 + 4)
    for _ in range(rounds):
        p, pairs = _expected(weight[feature].sum(1), offsets, move, steps)
        gap = hard - p
        g = np.stack([np.bincount(feature.ravel(), np.repeat(gap[:, c], feature.shape[1]), minlength=FEATURES) for c in (0, 1)], axis=1)
        g = np.concatenate([(g / n - ridge * weight).ravel(), ((truth - pairs) / n - ridge * move).ravel()])
        same = np.sign(g) * np.sign(before)
        step = np.clip(np.where(same > 0, step * 1.2, np.where(same < 0, step * 0.5, step)), 1e-4, 0.5)
        before = np.where(same < 0, 0, g)
        change = np.sign(before) * step
        weight += change[: FEATURES * 2].reshape(FEATURES, 2)
        move += change[FEATURES * 2 :].reshape(2, 2)
    return Field(weight, move)


def content_share(label: np.ndarray, chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each row's characters that stand in content lines."""
    return K.sums_by_doc(chars * label, offsets) / np.maximum(K.sums_by_doc(chars, offsets), 1)


def constrained(score: np.ndarray, offsets: np.ndarray, move: np.ndarray, chars: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """Viterbi labels that agree with each row's quality, by the least bias towards it that does (or the largest)."""
    label = np.zeros(len(score), np.int8)
    size, open_ = np.diff(offsets), np.arange(len(quality))
    for bias in BIASES:
        at = np.concatenate([[0], np.cumsum(size[open_])])
        lines = np.repeat(offsets[:-1][open_] - at[:-1], size[open_]) + np.arange(at[-1])
        pushed = score[lines].copy()
        pushed[:, 1] += np.repeat(np.where(quality[open_] == 1, bias, -bias), size[open_])
        found = viterbi(pushed, at, move)
        label[lines] = found
        agree = (content_share(found, chars[lines], at) >= MIN_CONTENT) == (quality[open_] == 1)
        open_ = open_[~agree]
        if len(open_) == 0:
            break
    return label


def train_bags(feature: np.ndarray, offsets: np.ndarray, chars: np.ndarray, quality: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Learn from documents whose quality is known, but not that of their lines."""
    owner = np.repeat(quality, np.diff(offsets))
    seen = np.stack([np.bincount(feature[owner == c].ravel(), minlength=FEATURES) for c in (0, 1)], axis=1) + 1.0
    odds = np.log(seen / np.array([max(1, (owner == c).sum()) for c in (0, 1)]))
    field = Field(odds, np.zeros((2, 2)))
    for i in range(rounds):
        label = constrained(field.weight[feature].sum(1), offsets, field.move, chars, quality)
        field = train(feature, offsets, label.astype(np.int64), 40 if i == 0 else 20, start=None if i == 0 else field)
    return field


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in K.slices(batch.column(2), SLICE_BYTES):
            _, lines = describe(s)
            flat, chars = lines.feature.astype(np.uint8), lines.chars.astype("<i4")
            cut = list(zip(lines.offsets[:-1].tolist(), lines.offsets[1:].tolist(), strict=True))
            packed = [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (flat, chars)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(s.first, s.rows) for i in (0, 1)), *packed], names=["h", "quality", "lines", "chars"])


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field:
    """Train on a bounded sample of the labelled documents."""
    ids, quality = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    known = labels.where(quality.isin(0, 1) & ids.isNotNull()).groupBy(ids.alias("id")).agg(F.min(quality).cast("int").alias("quality"))
    order = [F.xxhash64("id"), F.col("id")]
    sample = known.where("quality = 1").orderBy(*order).limit(SAMPLE).union(known.where("quality = 0").orderBy(*order).limit(SAMPLE))
    texts = documents.select(ids.alias("id"), F.col(f"`{text_col}`").alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select(F.xxhash64("id").alias("h"), "quality", "text")  # the sample has at most 2 * SAMPLE rows
    rows = chosen.mapInArrow(_described, "h long, quality int, lines binary, chars binary").toPandas()
    rows = rows.sort_values(["h", "lines"], kind="stable").groupby("h", sort=False).head(1)  # of rows that share an id, one
    if rows["quality"].nunique() < 2:
        return Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    parts = [np.frombuffer(b, np.uint8).reshape(-1, len(BINS)).astype(np.int64) for b in rows["lines"]]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    chars = np.concatenate([np.frombuffer(b, "<i4") for b in rows["chars"]]).astype(np.int64)
    return train_bags(np.concatenate(parts), np.concatenate([[0], np.cumsum(size)]), chars, rows["quality"].to_numpy(np.int64))


_FIGURES = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("content_share", "double"), ("kept", "boolean")]


def judge(documents: DataFrame, field: Field, *, text_col: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """``row`` (all columns of the document) and its figures up to ``kept``."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    # the text travels inside the row alone; its columns are numbered there, so that any name will do
    place = documents.columns.index(text_col)
    frame = documents.select(F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns))).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            rows = batch.column(0)
            for s in K.slices(rows.field(place), SLICE_BYTES):
                base, lines = describe(s)
                share = content_share(viterbi(f.weight[lines.feature].sum(1), lines.offsets, f.move), lines.chars, lines.offsets)
                failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > REPEAT_PERCENT * base[:, 0])
                yield pa.RecordBatch.from_arrays([rows.slice(s.first, s.rows), *(pa.array(base[:, i], pa.int64()) for i in range(5)), pa.array(failed), pa.array(share), pa.array(~failed & (share >= min_content))], names=["row", *(name for name, _ in _FIGURES)])

    schema = StructType([frame.schema["row"]])
    for name, kind in _FIGURES:
        schema.add(name, kind)
    out = frame.mapInArrow(run, schema)
    named = F.struct(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(documents.columns)))
    return out.select(named.alias("row"), *(name for name, _ in _FIGURES))


def keep(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that are kept."""
    return judge(documents, learn(documents, labels), **options).where("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    field = learn(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = judge(documents, field)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
