"""Harmonic packing of tokenised documents into fixed-length training sequences.

Method
------
With capacity ``C``, a piece of length ``l`` belongs to reciprocal-capacity
class ``k = C // l`` (``C/(k+1) < l <= C/k``).  A bin of class ``k`` takes
exactly ``k`` pieces, whichever they are, so no bin is ever searched and each
worker fills its bins on its own.  Documents may be cut:

* full ``C``-token pieces come first (class 1, one per bin);
* a remainder whose class would waste more than ``max_waste`` of its bin is cut
  at ``C // (k + 1)``, which fills class ``k + 1`` exactly; the rest, shorter
  than ``C / (k (k + 1))``, is treated alike, so few cuts are ever made;
* when a worker's rows end, the pieces of its unfilled bins (fewer than ``k``
  per class) are laid end to end, cut at ``C``; what is left at the very end is
  cut at powers of two, lengths that need no padding.

Everything is one narrow stage: no shuffle, no state but one open bin for each
class.  A lost task is recomputed from its input split alone, with the same
sequence ids (split number and local counter).

Tokens come from a ``tokenizers`` file.  A tokenised text is the concatenation
of the tokenised runs between its spaces; runs are hashed in bulk and each
worker tokenises a distinct run once (``_Vocabulary``, bounded in size).

Edge cases: null or empty text has the end id only; very long texts are cut
into as many sequences as needed; repeated rows are packed repeatedly; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

CAPACITY = 4096
END_ID = 2
MAX_WASTE = 1 / 64
VOCABULARY_LIMIT = 300_000
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Byte classes: 0 space, 1 ASCII letter, 2 ASCII punctuation that no rule of the
# tokenizer joins to a letter, 3 anything else.  Between 1 and 2 a text can be cut
# without changing its tokens; apostrophes (contractions) and <|> (special
# tokens) are in 3, as are digits and all non-ASCII bytes.
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
for _c in range(128):
    if chr(_c).isalpha():
        _CLASS[_c] = 1
    elif chr(_c) in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~":
        _CLASS[_c] = 2

_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins byte-level models use: printable bytes stay, others follow from 256 up."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(keep))
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Vocabulary:
    """Token ids of the distinct runs this worker has met; starts anew when it gets too large."""

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model, self.alphabet = self.tokenizer.model, _byte_alphabet()
        # The shortcut for plain words is taken only where it gives the tokenizer's own ids.
        self.shortcut = all([t.id for t in self.model.tokenize(self._mapped(w))] == self.tokenizer.encode(w, add_special_tokens=False).ids for w in ("word", "straße", "tréèêàç", "niñoíóaz", "ÿøöu"))
        self._clear()

    def _mapped(self, word: str) -> str:
        return word if word.isascii() else "".join(self.alphabet[b] for b in word.encode())

    def _clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, words: list[str]) -> list[list[int]]:
        out, hard = [], []
        for i, w in enumerate(words):
            low = w.lower()
            if self.shortcut and _PLAIN.fullmatch(low):
                out.append([t.id for t in self.model.tokenize(low if low.isascii() else self._mapped(low))])
            else:
                hard.append(i)
                out.append([])
        if hard:
            for i, e in zip(hard, self.tokenizer.encode_batch([words[i] for i in hard], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out

    def entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entry number of each run; ``size`` and ``first`` place an entry's ids in ``flat``."""
        value, at, inverse = np.unique(K.hash_runs(data, start, end), return_index=True, return_inverse=True)
        if len(self.known) + len(value) > self.limit:
            self._clear()
        spot = np.searchsorted(self.known, value)
        new = np.ones(len(value), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != value[inside]
        if new.any():
            text, which = data.tobytes(), at[new]
            ids = self._encode([text[a:b].decode("utf-8", "replace") for a, b in zip(start[which].tolist(), end[which].tolist(), strict=True)])
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            more = np.fromiter((x for y in ids for x in y), np.uint32, int(size.sum()))
            if self.used + len(more) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(len(self.flat) + len(more), np.uint32)])
            self.flat[self.used : self.used + len(more)] = more
            number = len(self.size) + np.arange(len(size))
            self.first = np.concatenate([self.first, self.used + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.used += len(more)
            self.known = np.insert(self.known, spot[new], value[new])
            self.place = np.insert(self.place, spot[new], number)
            spot = np.searchsorted(self.known, value)
        return self.place[spot][inverse.reshape(-1)]


_VOCABULARIES: dict[tuple[str, int], _Vocabulary] = {}


def tokens_of_slice(s: K.Slice, vocabulary: _Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of a slice and their offsets by document."""
    data = s.data if b"<|" in s.data.tobytes() else K.fold(s.data)
    kind = _CLASS[data]
    start, end, _ = K.runs(data, s.offsets, K.SPACE_WORDS)
    cut = np.flatnonzero((kind[1:] + kind[:-1] == 3) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1  # 1 beside 2
    if len(cut):
        inside = cut[~np.isin(cut, s.offsets, assume_unique=False)]
        start, end = np.sort(np.concatenate([start, inside])), np.sort(np.concatenate([end, inside]))
    if len(start) == 0:
        return np.zeros(0, np.uint32), np.zeros(s.rows + 1, np.int64)
    entry = vocabulary.entries(data, start, end)
    size = vocabulary.size[entry]
    total = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(total[-1]) + np.repeat(vocabulary.first[entry] - total[:-1], size)
    return vocabulary.flat[index], total[np.searchsorted(start, s.offsets)]


def cuts(n: int, capacity: int, max_waste: float) -> list[int]:
    """Lengths of the pieces that a document of n tokens is cut into."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if capacity - k * n <= max_waste * capacity:
            out.append(n)
            break
        out.append(capacity // (k + 1))
        n -= out[-1]
    return out


class _Packer:
    def __init__(self, worker: int, capacity: int, max_waste: float):
        self.capacity, self.max_waste, self.next = capacity, max_waste, worker << 33
        self.open: dict[int, list] = {}  # class -> pieces of its open bin
        self.rows: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), n, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start = 0
        for length in cuts(len(ids), self.capacity, self.max_waste):
            k = self.capacity // length
            bin_ = self.open.setdefault(k, [])
            bin_.append((doc, start, ids[start : start + length].copy() if k > 1 else ids[start : start + length], len(ids)))
            start += length
            if len(bin_) == k:
                self._emit(self.open.pop(k))

    def finish(self) -> None:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[2]) for p in rest)
        targets = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        targets += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        rest.reverse()
        for room in targets:
            pieces = []
            while room:
                doc, start, ids, n = rest.pop()
                pieces.append((doc, start, ids[:room], n))
                if len(ids) > room:
                    rest.append((doc, start + room, ids[room:], n))
                room -= len(pieces[-1][2])
            self._emit(pieces)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * len(_SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def pack(documents: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, max_waste: float = MAX_WASTE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = (path, VOCABULARY_LIMIT)
        vocabulary = _VOCABULARIES.get(key) or _VOCABULARIES.setdefault(key, _Vocabulary(*key))
        packer = _Packer(TaskContext.get().partitionId(), capacity, max_waste)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for s in K.slices(batch.column(1)):
                ids, offsets = tokens_of_slice(s, vocabulary)
                for i in range(s.rows):
                    packer.add(docs[s.first + i], np.concatenate([ids[offsets[i] : offsets[i + 1]], end]))
                if packer.rows:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
