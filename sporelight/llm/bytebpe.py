"""Token ids of a byte-level BPE tokenizer for slices of texts, each distinct stretch encoded once.

The tokenizer's own pattern splits a text before it merges bytes, so a text may
be cut at places where that pattern always splits: before white space that
follows a character that is none, between an ASCII letter and ASCII punctuation
(apostrophes left out: they join contractions), and after a lone line break or
tab.  The stretches between are the same few words again and again; each worker
encodes a distinct one once, with the tokenizer itself.  Stretches are found by a
64-bit hash and then compared byte by byte, so no two are ever taken for one.

Special tokens stand as the tokenizer finds them: a slice that holds ``<|`` is
cut at white space only.  A long text is taken in blocks that end at such cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import kernel as K

VOCABULARY_LIMIT = 1_500_000
VOCABULARY_BYTES = 64 << 20
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
for _c in range(0x21, 0x7F):
    _LETTER[_c] = chr(_c).isalpha()
    _MARK[_c] = not chr(_c).isalnum() and chr(_c) != "'"
# No character that begins with these bytes is white space.
_SOLID2, _SOLID3, _SOLID4 = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_SOLID2[0xC3:0xE0] = True
_SOLID3[[0xE0, *range(0xE4, 0xF0)]] = True
_SOLID4[0xF0:0xF8] = True


def cuts(data: np.ndarray, begin: int = 0, end: int | None = None, marks: bool = True) -> np.ndarray:
    """Places in ``begin + 1 .. end - 1`` where the text may be cut (as if ``data`` were one text)."""
    end = len(data) if end is None else end
    d = data[max(begin - 3, 0) : min(end + 1, len(data))]
    skip = begin - max(begin - 3, 0)
    n = len(d)
    if n < 2:
        return np.zeros(0, np.int64)
    solid = _PRINTED[d]
    solid[1:] |= (d[1:] >= 0x80) & (d[1:] < 0xC0) & _SOLID2[d[:-1]]
    solid[2:] |= (d[2:] >= 0x80) & _SOLID3[d[:-2]]
    solid[3:] |= (d[3:] >= 0x80) & _SOLID4[d[:-3]]
    space = _SPACE[d]
    cut = np.zeros(n, bool)
    cut[1:] = space[1:] & solid[:-1]
    if n > 2:
        alone = solid[:-2] & space[1:-1] & (d[1:-1] != 0x20) & (_PRINTED | _SOLID2 | _SOLID3 | _SOLID4)[d[2:]]
        cut[2:] |= alone
    if marks:
        cut[1:] |= (_LETTER[d[:-1]] & _MARK[d[1:]]) | (_MARK[d[:-1]] & _LETTER[d[1:]])
    at = np.flatnonzero(cut) - skip + begin
    return at[(at > begin) & (at < end)]


class Vocabulary:
    """Token ids of the distinct stretches this worker has met; starts anew when it gets too large."""

    def __init__(self, path: str, limit: int = VOCABULARY_LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self._clear()

    def _clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.at, self.length = K.Grown(np.uint8), K.Grown(np.int64), K.Grown(np.int64)
        self.ids, self.first, self.size = K.Grown(np.uint32), K.Grown(np.int64), K.Grown(np.int64)
        self.others: dict[bytes, int] = {}

    def _add(self, stretches: list[bytes]) -> np.ndarray:
        """Entries for new stretches."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([s.decode("utf-8") for s in stretches], add_special_tokens=False)]
        number = len(self.size) + np.arange(len(ids))
        for counts, starts, flat, kind, values in ((self.size, self.first, self.ids, np.uint32, ids), (self.length, self.at, self.bytes, np.uint8, stretches)):
            n = np.fromiter(map(len, values), np.int64, len(values))
            starts.extend(len(flat) + np.cumsum(n) - n)
            counts.extend(n)
            flat.extend(np.frombuffer(b"".join(values), np.uint8) if kind is np.uint8 else np.fromiter((x for v in values for x in v), np.uint32, int(n.sum())))
        return number

    def entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entry number of each stretch; ``size`` and ``first`` place an entry's ids in ``ids``."""
        value, at, inverse = np.unique(K.hash_runs(data, start, end), return_index=True, return_inverse=True)
        inverse = inverse.reshape(-1)
        if len(self.known) + len(value) > self.limit or len(self.bytes) > VOCABULARY_BYTES:
            self._clear()
        spot = np.searchsorted(self.known, value)
        new = np.ones(len(value), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != value[inside]
        if new.any():
            number = self._add([data[a:b].tobytes() for a, b in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
            self.known, self.place = np.insert(self.known, spot[new], value[new]), np.insert(self.place, spot[new], number)
            spot = np.searchsorted(self.known, value)
        entry = self.place[spot][inverse]
        same = K.same_runs(data, start, end, self.bytes.values, self.at.values[entry], self.length.values[entry])
        for i in np.flatnonzero(~same).tolist():  # another stretch with this hash
            stretch = data[start[i] : end[i]].tobytes()
            if stretch not in self.others:
                self.others[stretch] = int(self._add([stretch])[0])
            entry[i] = self.others[stretch]
        return entry

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of some texts' bytes, and their offsets by text."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data), bool)
        cut[cuts(data, marks=b"<|" not in data.tobytes())] = True
        cut[offsets[offsets < len(data)]] = True
        edge = np.flatnonzero(cut)
        entry = self.entries(data, edge, np.append(edge[1:], len(data)))
        size = self.size.values[entry]
        total = np.concatenate([[0], np.cumsum(size)])
        index = np.arange(total[-1]) + np.repeat(self.first.values[entry] - total[:-1], size)
        return self.ids.values[index], total[np.searchsorted(edge, offsets)]


def blocks(data: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
    """A long text in stretches of about ``size`` bytes."""
    begin = 0
    while begin < len(data):
        look, end = begin + size, len(data)
        while look < len(data):
            at = cuts(data, look - 1, min(look + 4096, len(data)), marks=False)
            if len(at):
                end = int(at[0])
                break
            look += 4095
        yield data[begin:end]
        begin = end


def tokens_of_slice(s: K.Slice, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of a slice and their offsets by document."""
    if s.rows > 1 or len(s.data) <= 2 * BLOCK:
        return vocabulary.tokens(s.data, s.offsets)
    ids = np.concatenate([vocabulary.tokens(b, np.array([0, len(b)]))[0] for b in blocks(s.data)])
    return ids, np.array([0, len(ids)])


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """This worker's vocabulary of a tokenizer file."""
    return _VOCABULARIES.get(path) or _VOCABULARIES.setdefault(path, Vocabulary(path))
