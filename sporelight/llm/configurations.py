"""Which bins to build for a histogram of lengths: a configuration linear program, solved by multiplicative weights.

A configuration is a multiset of lengths that fits a bin.  The program asks for
the fewest bins (amounts of configurations) that hold every length as often as
the histogram has it.  Multiplicative weights: every length has a weight that
falls exponentially with the share of its pieces that is already placed; its
price is its weight by piece.  The most valuable configuration at these prices
is a knapsack, solved by dynamic programming over the bin's room; one table of
it gives the best configuration that contains each length, and those within a
small factor of the best are raised together.  Rounding down the amounts leaves
pieces over; they are a smaller histogram, solved alike, and what no rounded
amount covers in the end, fewer bins than there are lengths times a few, is
placed by best fit, longest first.

All of it works on the histogram, at most ``capacity`` numbers, whatever the
number of documents: its time and memory don't grow with the input.
"""

from __future__ import annotations

import numpy as np

#: Share of its pieces by which a length may be raised in a round.
STEP = 0.1
#: Configurations this close to the best one at the present prices are raised too.
NEAR = 0.02
#: How fast a length's weight falls with its coverage.
DECAY = 8.0
#: Lengths whose best configuration is looked at in a round.
ANCHORS = 256
#: A round limit for awkward histograms; what is not covered by then is left to rounding.
ROUNDS = 1000
#: How often what rounding leaves over is solved again, as long as less than half was left.
LEVELS = 3

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first


def knapsack(price: np.ndarray, length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room 0 .. capacity the greatest total price, and the length to take first (-1: the room of one less does as well)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    reach = np.searchsorted(length, np.arange(capacity + 1), side="right")
    for w in range(int(length[0]) if len(length) else capacity + 1, capacity + 1):
        k = reach[w]
        value = price[:k] + best[w - length[:k]]
        j = int(value.argmax())
        if value[j] > best[w - 1]:
            best[w], pick[w] = value[j], j
        else:
            best[w] = best[w - 1]
    return best, pick


def _unrolled(anchors: np.ndarray, pick: np.ndarray, length: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length occurs in the best configuration that contains each anchor."""
    step = np.maximum.accumulate(np.where(pick >= 0, np.arange(capacity + 1), 0))  # the largest room up to w that takes something
    times = np.zeros((len(anchors), len(length)), np.int64)
    times[np.arange(len(anchors)), anchors] = 1
    room = step[capacity - length[anchors]]
    while (live := np.flatnonzero(room)).size:
        taken = pick[room[live]]
        times[live, taken] += 1
        room[live] = step[room[live] - length[taken]]
    return times


def relaxed(count: np.ndarray, length: np.ndarray, capacity: int, *, step: float = STEP, near: float = NEAR, decay: float = DECAY, rounds: int = ROUNDS) -> dict[bytes, float]:
    """Amounts of configurations (each as the bytes of its row of multiplicities) that nearly solve the program."""
    covered = np.zeros(len(length))
    start = np.log(count * length.astype(float))
    amounts: dict[bytes, float] = {}
    for _ in range(rounds):
        if covered.min() >= 1:
            break
        weight = np.exp((start - decay * covered) - (start - decay * covered).max())
        price = weight / count
        price /= price.max()
        best, pick = knapsack(price, length, capacity)
        worth = price + best[capacity - length]
        open_ = np.flatnonzero((worth >= (1 - near) * worth.max()) & (covered < 1))
        if not len(open_):
            open_ = np.array([int(worth.argmax())])
        anchors = open_[np.argsort(covered[open_], kind="stable")[:ANCHORS]]
        times = _unrolled(anchors, pick, length, capacity)
        amount = count[anchors] / times[np.arange(len(anchors)), anchors]
        amount *= step / ((amount @ times) / count).max()
        covered += (amount @ times) / count
        for row, a in zip(times, amount.tolist(), strict=True):
            key = row.astype(np.int32).tobytes()
            amounts[key] = amounts.get(key, 0.0) + a
    return amounts


def best_fit(count: np.ndarray, length: np.ndarray, capacity: int) -> dict[Pattern, int]:
    """Best fit, longest first, of whole groups of equal pieces into groups of equal bins."""
    groups: dict[int, dict[Pattern, int]] = {capacity: {}}  # room -> contents -> bins
    rooms = np.zeros(capacity + 1, bool)
    for size, left in sorted(zip(length.tolist(), count.tolist(), strict=True), reverse=True):
        while left:
            fits = np.flatnonzero(rooms[size:])
            if len(fits):
                room = size + int(fits[0])
                contents, bins = groups[room].popitem()
                if not groups[room]:
                    rooms[room] = False
            else:
                each = capacity // size
                room, contents, bins = capacity, (), -(-left // each)
            each = min(room // size, left)
            used = min(bins, left // each)
            for inside, n in ((((size, each),), used), ((), bins - used)):
                if n and (inside or contents):
                    free = room - size * each * bool(inside)
                    group = groups.setdefault(free, {})
                    group[contents + inside] = group.get(contents + inside, 0) + n
                    rooms[free] = free > 0
            left -= each * used
    return {contents: bins for group in groups.values() for contents, bins in group.items()}


def _rounded(amounts: dict[bytes, float], left: np.ndarray, length: np.ndarray, capacity: int, fill: bool, waste: int) -> dict[bytes, int]:
    """Whole bins of the configurations that waste no more than ``waste``, the fullest first, and what is ``left`` is lowered by them; ``fill``: then full bins as long as there are pieces for them."""
    out: dict[bytes, int] = {}
    rows = [(row, a, k) for k, a in amounts.items() if capacity - int((row := np.frombuffer(k, np.int32)) @ length) <= waste]
    rows.sort(key=lambda x: (-int(x[0] @ length), -x[1], x[2]))
    for filling in (False, True)[: 1 + fill]:
        for row, amount, key in rows:
            if amount >= 1 if not filling else int(row @ length) == capacity:
                has = np.flatnonzero(row)
                bins = int((left[has] // row[has]).min())
                bins = bins if filling else min(bins, int(amount))
                if bins:
                    left[has] -= bins * row[has]
                    out[key] = out.get(key, 0) + bins
    return out


def _bins(amounts: dict[bytes, float], left: np.ndarray, length: np.ndarray, capacity: int, fill: bool, waste: int) -> dict[Pattern, int]:
    out: dict[Pattern, int] = {}
    for level in range(LEVELS):
        before = int(left @ length)
        for key, bins in _rounded(amounts if not level else relaxed(left.astype(float), length, capacity), left, length, capacity, fill, waste).items():
            row = np.frombuffer(key, np.int32)
            pattern = tuple((int(length[i]), int(row[i])) for i in np.flatnonzero(row)[::-1])
            out[pattern] = out.get(pattern, 0) + bins
        keep = left > 0
        length, left = length[keep], left[keep]
        if not fill or 2 * int(left @ length) > before or not len(length):
            break
    for pattern, bins in best_fit(left, length, capacity).items():
        out[pattern] = out.get(pattern, 0) + bins
    return out


def solve(histogram: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Bins to build: how many of each configuration, which together hold every length exactly as often as the histogram.

    The amounts are rounded in three ways (all of them; all, then full bins as long as there are pieces for them;
    full bins alone); the one with the fewest bins is taken."""
    length = np.array(sorted(n for n, c in histogram.items() if c and n < capacity), np.int64)
    count = np.array([histogram[n] for n in length.tolist()], np.int64)
    out: dict[Pattern, int] = {}
    if len(length):
        amounts = relaxed(count.astype(float), length, capacity)
        ways = ((False, capacity), (True, capacity), (False, 0))
        out = min((_bins(amounts, count.copy(), length, capacity, *way) for way in ways), key=lambda x: sum(x.values()))
    if histogram.get(capacity):
        out[((capacity, 1),)] = histogram[capacity]
    return out
