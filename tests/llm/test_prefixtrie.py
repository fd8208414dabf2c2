"""The prefix trie against a plain one: shared openings, copies, blocks of digests, awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from sporelight.llm import prefixtrie


def _plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    kids = defaultdict(list)
    for w in members:
        if w:
            kids[w[:-1]].append(w)
    leaves, saved = {}, {}
    for w in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", w[-1][1])) if w else 0
        leaves[w] = sum(leaves[k] for k in kids[w]) or 1
        saved[w] = sum(saved[k] for k in kids[w]) + (len(members[w]) - 1) * words
    return sorted(
        ((min(m), len(w), min(members[w[:-1]]) if w else None, len(m), len(kids[w]), leaves[w], saved[w], hashlib.sha256(",".join(map(str, sorted(ends[w]))).encode()).hexdigest()) for w, m in members.items()),
        key=repr,
    )


def _got(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def _conversations(seed, n, most):
    """Random walks that share openings; every third is a copy of an earlier one or a stretch of it."""
    rnd, out, seen = random.Random(seed), [], []
    for c in rnd.sample(range(60), n):
        if seen and rnd.random() < 0.4:
            told = rnd.choice(seen)[: rnd.randint(1, most)] + [("user", f"end {rnd.randint(0, 2)}")] * rnd.randint(0, 2)
        else:
            told = [(rnd.choice(["user", "bot", None]), rnd.choice(["a", "b  c", None, "", "d\te f\n"])) for _ in range(rnd.randint(1, most))]
        seen.append(told)
        out += [(c, i, r, t) for i, (r, t) in enumerate(told)]
    rnd.shuffle(out)
    return out


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("seed,n,most,block", [(1, 40, 3, 256), (2, 30, 40, 4), (3, 25, 9, 3)])
def test_equals_a_plain_trie(spark, seed, n, most, block):
    rows = _conversations(seed, n, most)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _got(prefixtrie.trie(df, block=block)) == _plain(rows)


def test_packs_of_many_ids(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PACK", 3)
    rows = [(c, 0, "u", "same words") for c in range(0, 400, 20)] + [(c, 0, "u", "x") for c in range(7, 400, 20)]
    assert _got(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA))) == _plain(rows)


def test_a_deep_tree_of_chains(spark):
    """Each conversation leaves the one before it a turn later, so chains hang from chains."""
    rows = [(c, i, "u", f"turn {i}" if i < k + 4 else f"own {c}") for k, c in enumerate(range(20, 20 * 13, 20)) for i in range(k + 5)]
    assert _got(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA), block=5)) == _plain(rows)


def test_awkward_rows(spark):
    rows = [(5, None, "u", "first"), (5, 0, "u", "b"), (5, 0, "u", "b"), (5, 0, None, None), (None, 0, "u", "lost"), (-25, 3, "u", "é" * 2000), (3, None, "", ""), (0, 1, "u", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", d int, prefix string")
    assert _got(prefixtrie.trie(df)) == _plain(rows)
    assert prefixtrie.trie(df.limit(0)).count() == 0
