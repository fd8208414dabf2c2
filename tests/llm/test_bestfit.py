"""Best-fit packing against the tokenizer itself and against plain best fit."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sporelight.llm import bestfit, bytebpe, configurations
from sporelight.llm import kernel as K

SF = "/root/testdata/sf0.001"
TRICKY = [
    "", None, " ", "\n", "\n\n", "a\n", "\nA", "a\n\nB", "a \nB", "a  b   c", "\t\tx\ty", "It's WE'LL don't 'tis.\n", "a<|endoftext|>b  <|endoftext|> c", "<|x|>", "É é Élan!… ß ÷× naïve— x’s", "é Å  z", "123 4,5.6 --- !!! a.b.c @#$ 'S 'Re.",
    "a  b", "a \n b", "a  b   c", "x　 y　\n　z", "  a", "a\x85\n b", "a\x1c b\x1f\nc", "日本語 テキスト。\nعربى नमस्ते", "😀 😀\n😀", "z" * 9000, " " * 5000, "x\r\ny\x0b\x0cz", "ﬁ ǅ ª º ²",
]


def _check(rows, documents, capacity):
    tokenizer = Tokenizer.from_file(bestfit.default_tokenizer())
    want = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in documents)
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    got = []
    for d, ps in by.items():
        copies = sum(p.piece == 0 for p in ps)
        ps.sort(key=lambda p: (p.piece, p.sequence_id, p.offset))
        for c in range(copies):
            mine, ids = ps[c::copies], []
            for i, p in enumerate(mine):
                assert p.piece == i and p.start == len(ids) and p.length == len(p.ids) // 4
                ids += np.frombuffer(bytes(p.ids), "<u4").tolist()
                assert len(mine) == 1 or i == 0 or p.length == capacity
            got.append(ids)
    assert sorted(got) == want
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(sequences), [p.length for ps in by.values() for p in ps]


def test_documents_round_trip_in_few_sequences(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    documents = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    used, lengths = _check(bestfit.pack(df.repartition(3)).collect(), documents, 1024)
    assert used <= 1.03 * sum(lengths) / 1024 + 1


@pytest.mark.parametrize("capacity", [4, 1024])
def test_tricky_texts_repeated_rows_and_clashing_columns(spark, capacity):
    documents = list(enumerate(TRICKY)) + [(3, TRICKY[3])] * 5
    df = spark.createDataFrame([(d, t, 1, "s", 2) for d, t in documents], "doc_id long, text string, start int, ids string, length int")
    _check(bestfit.pack(df, capacity=capacity).collect(), documents, capacity)
    assert bestfit.pack(df.limit(0)).count() == 0


def test_text_ids_and_the_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(bestfit, "BROADCAST_ROWS", 0)
    documents = [(f"d{i}", "word " * (i * 7 % 50)) for i in range(60)]
    _check(bestfit.pack(spark.createDataFrame(documents, "doc_id string, text string").repartition(3), capacity=64).collect(), documents, 64)


def _tokens(texts):
    v = bytebpe.Vocabulary(bestfit.default_tokenizer())
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, at = v.tokens(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_random_texts_have_the_tokenizers_ids():
    rnd = random.Random(3)
    alphabet = list(" \t\n\r\x0b\x0c'.,<|>-aBszé1٣  　\x85\x1f…ßж日😀 ") + ["'s", "'ll", "<|endoftext|>", "  ", "\n\n", "word"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    tokenizer = Tokenizer.from_file(bestfit.default_tokenizer())
    assert _tokens(texts[:2000]) == [e.ids for e in tokenizer.encode_batch(texts[:2000], add_special_tokens=False)]
    plain = [t.replace("<|", "") for t in texts[2000:]]
    assert _tokens(plain) == [e.ids for e in tokenizer.encode_batch(plain, add_special_tokens=False)]


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(K, "hash_runs", lambda data, start, end: (end - start).astype(np.uint64))
    texts = ["abc abd xyz abd", "xyz abc q r s"]
    tokenizer = Tokenizer.from_file(bestfit.default_tokenizer())
    assert _tokens(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_blocks_of_a_long_text():
    rnd = random.Random(4)
    text = "".join(rnd.choice(["word", "é", "日本", "x" * 9000, "…"]) + rnd.choice([" ", "\n", "　 \n", ", "]) for _ in range(3000)).encode()
    data = np.frombuffer(text, np.uint8)
    parts = list(bytebpe.blocks(data, 10_000))
    assert b"".join(p.tobytes() for p in parts) == text and len(parts) > 50
    v = bytebpe.Vocabulary(bestfit.default_tokenizer())
    ids = [x for p in parts for x in v.tokens(p, np.array([0, len(p)]))[0].tolist()]
    assert ids == v.tokenizer.encode(text.decode(), add_special_tokens=False).ids


def test_knapsack_against_all_multisets():
    rnd = np.random.default_rng(5)
    for _ in range(20):
        length = np.unique(rnd.integers(2, 15, 4))
        price = rnd.random(len(length))
        best, pick = configurations.knapsack(price, length, 20)

        def most(room, length=length, price=price):
            return max([0.0, *(price[i] + most(room - n) for i, n in enumerate(length.tolist()) if n <= room)])

        assert np.allclose([best[w] for w in range(21)], [most(w) for w in range(21)])
        times = configurations._unrolled(np.arange(len(length)), pick, length, 20)
        assert ((times @ length) <= 20).all()
        assert np.allclose(times @ price, price + best[20 - length])


@pytest.mark.parametrize("low,high,n", [(1, 64, 500), (17, 34, 5000), (33, 60, 300), (64, 65, 9), (20, 24, 4000)])
def test_program_holds_every_piece_in_few_bins(low, high, n):
    lengths = np.random.default_rng(n).integers(low, high, n)
    histogram = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    bins = configurations.solve(histogram, 64)
    placed = {}
    for pattern, k in bins.items():
        assert sum(a * b for a, b in pattern) <= 64
        for a, b in pattern:
            placed[a] = placed.get(a, 0) + b * k
    assert placed == histogram
    size = np.array(sorted(k for k in histogram if k < 64), np.int64)
    plain = configurations.best_fit(np.array([histogram[k] for k in size.tolist()], np.int64), size, 64) if len(size) else {}
    assert sum(bins.values()) <= 1.01 * (sum(plain.values()) + histogram.get(64, 0))
    assert configurations.solve({}, 64) == {}
