"""Packing against the tokenizer itself: every id in one piece, gapless sequences, little padding."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sporelight.llm import packing

SF = "/root/testdata/sf0.001"
TRICKY = ["", None, "It's WE'LL don't 'tis.\n", "a<|endoftext|>b <|EndOfText|> <|startoftext|>", "É é Élan!… ß ÷× naïve— x’s", "é Å  z", "123 4,5.6 --- !!! a.b.c @#$ 'S 'Re.", "x" * 9000, "\x00\x01\x1c tab\tnew\r\nline\x0b", "日本語 текст عربى"]


def _check(rows, documents, capacity=4096):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in documents}
    got, sequences = {}, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(got) == set(want)
    for d, pieces in got.items():
        ids = []
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == len(ids) and p.doc_tokens == len(want[d])
            ids += np.frombuffer(bytes(p.ids), "<u4").tolist()
            assert p.length == len(p.ids) // 4 > 0
        assert ids == want[d]
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / sum(map(len, want.values()))


def test_round_trip_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    documents = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert _check(packing.pack(df.repartition(3)).collect(), documents) < 0.02


def test_tricky_texts_and_clashing_columns(spark):
    documents = list(enumerate(TRICKY))
    df = spark.createDataFrame([(d, t, 1, "s", 2) for d, t in documents], "doc_id long, text string, start int, ids string, length int")
    _check(packing.pack(df).collect(), documents)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same words")] * 3, "doc_id long, text string")
    rows = packing.pack(df).collect()
    assert sum(r.length for r in rows) == 3 * rows[0].doc_tokens
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1365, 1366, 2047, 2048, 2049, 4095, 4096, 4097, 9999])
def test_cuts_cover_the_document(n):
    lengths = packing.cuts(n, 4096, packing.MAX_WASTE)
    assert sum(lengths) == n
    assert all(4096 - (4096 // x) * x <= packing.MAX_WASTE * 4096 + 4096 // x for x in lengths)


def test_query_digest_is_the_checksum_of_the_ids(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    rows = packing.pack(df).selectExpr("ids", "crc32(ids) AS c").collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.c for r in rows)
