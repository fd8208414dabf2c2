"""Importance resampling against a plain loop: chunked long texts, awkward rows, ranks."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from sporelight.llm import importance


def _words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def _plain(docs, target, order, buckets, percent, least, seed):
    def hashed(text):
        w = _words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(w) - k + 1)]

    own = [hashed(t) for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in hashed(x))
    n, m = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in s}
    rows = []
    for (d, text), x in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        rows.append([d, len(_words(text)), len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for i, r in enumerate(enough[: len(enough) * percent // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=repr)


def _got(df):
    return sorted(((r.id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=repr)


def _texts(n, seed):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "gämma", "x" * 300, "42", "日本語", "de-lta", "e_f", "ÉTÉ"] + [f"w{i}" for i in range(30)]
    return ["".join(rnd.choice(words) + rnd.choice([" ", "  ", "\n", ", ", "\x00", "\x7f"]) for _ in range(rnd.choice([0, 1, 3, 25, 400]))) for _ in range(n)]


@pytest.mark.parametrize("order", [1, 3])
def test_equals_a_plain_loop_with_cut_texts(spark, order):
    docs = list(enumerate(_texts(60, order)))
    target = _texts(5, 99)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), order=order, buckets=97, percent=40, least_words=3, chunk_bytes=200)
    assert _got(got) == _plain(docs, target, order, 97, 40, 3, importance.SEED)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "one two three"), (4, "one two three"), (None, "one two three"), (5, "a" * 3000 + " b")]
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs], "doc_id long, text string, row int, id string, n_words int")
    got = importance.resample(df, spark.createDataFrame([], "text string"), percent=100, least_words=2, chunk_bytes=100)
    assert _got(got) == _plain(docs, [], 1, importance.BUCKETS, 100, 2, importance.SEED)
    assert importance.resample(df.limit(0), df).count() == 0


def test_text_ids(spark):
    docs = [("a", "one two"), ("b", "three four five")]
    got = importance.resample(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame([("three",)], "text string"), percent=50, least_words=1)
    assert _got(got) == _plain(docs, ["three"], 1, importance.BUCKETS, 50, 1, importance.SEED)


@pytest.mark.parametrize("carry", [0, 2])
def test_pieces_own_every_byte_once(carry):
    text = " ".join(_texts(3, 5)).encode()
    cut = list(importance.pieces(text, 64, carry))
    assert b"".join(text[a:b] for a, b, _ in cut) == text
    for a, b, c in cut:
        assert b == len(text) or not (importance._WORD.match(text, b - 1, b) and importance._WORD.match(text, b, b + 1))
        assert len(importance._WORD.findall(text[b:c])) == min(carry, len(importance._WORD.findall(text[b:])))
