"""Score-limited extension: reads against windows of a reference, whole reads, penalties for what differs.

A read is aligned from end to end inside a band around the diagonal of its seed;
where it begins and ends on the reference is free inside the band.  Cells hold the
least penalty with the last column a match or mismatch, an insertion or a deletion
(three states), so opening and extending a gap may cost differently.  Reads of one
length are worked on together, a row of the table at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_FAR = np.int32(1 << 20)
_CHUNK = 2048


@dataclass(frozen=True)
class Penalty:
    """Costs of an alignment and the most that is accepted.

    A base of the read or the reference that is not A, C, G or T costs ``other`` wherever it is aligned, even to itself."""

    limit: int = 1
    mismatch: int = 1
    gap_open: int = 0
    gap_extend: int = 1
    other: int = 1

    @property
    def edits(self) -> int:
        """The most differences within the limit."""
        return self.limit // max(1, min(self.mismatch, self.gap_extend, self.other))

    @property
    def gap(self) -> int:
        """The longest gap within the limit."""
        return max(0, self.limit - self.gap_open) // max(1, self.gap_extend)


_KNOWN = np.zeros(256, bool)
_KNOWN[[ord(c) for c in "ACGT"]] = True


def extend(reads: np.ndarray, windows: np.ndarray, penalty: Penalty) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Least penalty of each read, where it begins in its window, CIGAR and number of differences.

    ``reads``: n x length; ``windows``: n x (length + 2 * gap), 0 beyond the reference."""
    n, length = reads.shape
    width = 2 * penalty.gap + 1
    band = np.arange(width)
    first = penalty.gap_open + penalty.gap_extend
    best = np.where(windows[:, :width] >= 0, 0, 0).astype(np.int32)  # nothing read yet: free anywhere in the band
    ins = np.full((n, width), _FAR, np.int32)
    how = np.zeros((length, n, width), np.uint8)  # 0-1: state (match, insertion, deletion); 4: insertion goes on; 8: deletion goes on
    for i in range(length):
        ref = windows[:, i : i + width]
        base = reads[:, i : i + 1]
        cost = np.where(_KNOWN[ref] & _KNOWN[base], np.where(ref == base, 0, penalty.mismatch), penalty.other).astype(np.int32)
        match = np.where(ref == 0, _FAR, best + cost)
        # an insertion reads a base and stays on the reference: the diagonal moves one to the left
        opened, longer = np.full((n, width), _FAR, np.int32), np.full((n, width), _FAR, np.int32)
        opened[:, :-1], longer[:, :-1] = best[:, 1:] + first, ins[:, 1:] + penalty.gap_extend
        now_ins = np.minimum(opened, longer)
        state = (now_ins < match).astype(np.uint8) | (longer < opened).astype(np.uint8) << 2
        now = np.minimum(match, now_ins)
        gone = np.full(n, _FAR, np.int32)
        for b in range(1, width):  # a deletion stays in the read and moves on the reference
            skips = windows[:, i + b] != 0
            from_best, on = np.where(skips, now[:, b - 1] + first, _FAR), np.where(skips, gone + penalty.gap_extend, _FAR)
            gone = np.minimum(from_best, on)
            better = gone < now[:, b]
            state[:, b] = np.where(better, state[:, b] & 4 | 2, state[:, b]) | (on < from_best).astype(np.uint8) << 3
            now[:, b] = np.where(better, gone, now[:, b])
        best, ins, how[i] = now, now_ins, state
    # of equals the one nearest to the seed's diagonal, the left one first
    order = np.argsort(np.abs(band - penalty.gap) * 2 + (band > penalty.gap), kind="stable")
    end = order[np.argmin(best[:, order], axis=1)]
    score = best[np.arange(n), end]
    begin, cigars, edits = np.zeros(n, np.int64), [""] * n, np.zeros(n, np.int64)
    for r in np.flatnonzero(score <= penalty.limit).tolist():
        i, b, ops, inside = length - 1, int(end[r]), [], 0
        while i >= 0:
            s = int(how[i, r, b])
            kind = inside or s & 3
            if kind == 1:
                inside = 1 if s & 4 else 0
                ops.append("I")
                i, b = i - 1, b + 1
                edits[r] += 1
            elif kind == 2:
                inside = 2 if s & 8 else 0
                ops.append("D")
                b -= 1
                edits[r] += 1
            else:
                ops.append("M")
                x, y = reads[r, i], windows[r, i + b]
                edits[r] += x != y or not _KNOWN[x]
                i -= 1
        begin[r] = b
        cigars[r] = _run_lengths(ops[::-1])
    return score, begin, cigars, edits


def _run_lengths(ops: list[str]) -> str:
    out, at = [], 0
    while at < len(ops):
        stop = at
        while stop < len(ops) and ops[stop] == ops[at]:
            stop += 1
        out.append(f"{stop - at}{ops[at]}")
        at = stop
    return "".join(out)


def least_penalties(reads: np.ndarray, windows: np.ndarray, pad: int) -> np.ndarray:
    """Fewest edits of each read inside its window (length + 2 * pad), without the alignments; an unknown base is never equal."""
    n, length = reads.shape
    width = 2 * pad + 1
    far = np.int32(1 << 20)
    best, slot = np.zeros((n, width), np.int32), np.arange(width, dtype=np.int32)
    for i in range(length):
        ref, base = windows[:, i : i + width], reads[:, i : i + 1]
        now = np.where(ref == 0, far, best + ((ref != base) | ~_KNOWN[base]))
        now[:, :-1] = np.minimum(now[:, :-1], best[:, 1:] + 1)
        best = np.minimum.accumulate(now - slot, axis=1) + slot  # reference bases alone, any number of them
    return best.min(axis=1)


def extender(penalty: Penalty, keep: int):
    """Arrow batches of candidates to alignments: ``keep`` leading columns, then oriented, tile text, tile begin, diagonal.

    Gives the kept columns and ``oriented, pos, cigar, nm, score``."""
    pad = penalty.gap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array([len(x.as_py()) for x in batch.column(keep)], np.int64)
            start = np.asarray(batch.column(keep + 3)) - np.asarray(batch.column(keep + 2)) - pad
            for size in np.unique(lengths).tolist() if len(lengths) else ():
                same = np.flatnonzero(lengths == size)
                for lo in range(0, len(same) if size else 0, _CHUNK):
                    rows = same[lo : lo + _CHUNK]
                    own = pa.array(rows)
                    reads = np.frombuffer("".join(batch.column(keep).take(own).to_pylist()).encode("latin-1", "replace"), np.uint8).reshape(len(rows), size)
                    texts = []
                    for text, s in zip(batch.column(keep + 1).take(own).to_pylist(), start[rows].tolist(), strict=True):
                        piece = text[max(s, 0) : max(s + size + 2 * pad, 0)]
                        texts.append(("\0" * min(max(-s, 0), size + 2 * pad) + piece).ljust(size + 2 * pad, "\0"))
                    windows = np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8).reshape(len(rows), size + 2 * pad)
                    score, begin, cigars, edits = extend(reads, windows, penalty)
                    good = np.flatnonzero(score <= penalty.limit)
                    taken = pa.array(rows[good])
                    pos = np.asarray(batch.column(keep + 3))[rows[good]] - pad + begin[good] + 1
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i).take(taken) for i in range(keep + 1)), pa.array(pos, pa.int32()), pa.array([cigars[i] for i in good.tolist()], pa.string()), pa.array(edits[good], pa.int32()), pa.array(score[good], pa.int32())],
                        names=[*batch.schema.names[: keep + 1], "pos", "cigar", "nm", "score"],
                    )

    return run
