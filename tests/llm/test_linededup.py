"""Line de-duplication against a brute-force edit distance."""

import random

import pytest
from pyspark.sql import functions as F

from sporelight.llm import linededup as L


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _edited(rng, line, edits, alphabet="abcdeé "):
    s = list(line)
    for _ in range(edits):
        at = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice(alphabet)
        elif kind == 1:
            s.insert(at, rng.choice(alphabet))
        else:
            del s[at]
    return "".join(s)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_banded_distance(spark, t):
    rng = random.Random(t)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé ") for _ in range(rng.randint(t + 1, 30)))
        b = _edited(rng, a, rng.randint(0, t + 2), "abé ") if rng.random() < 0.8 else "".join(rng.choice("abé ") for _ in range(len(a)))
        if len(b) > t and abs(len(a) - len(b)) <= t:
            rows.append((a, b, min(_distance(a, b), t + 1)))
    df = spark.createDataFrame(rows, "a string, b string, want int")
    got = df.select("a", "b", "want", L.edit_distance(F.split("a", ""), F.split("b", ""), t).alias("d")).collect()
    assert [(r.a, r.b, r.want) for r in got if min(r.d, t + 1) != r.want] == []


def _brute(documents, t, least):
    seen, out = [], {}
    for d, text in documents:
        if text is None:
            out[d] = None
            continue
        kept = []
        for line in text.split("\n"):
            if len(line) >= least:
                if any(abs(len(line) - len(o)) <= t and _distance(line, o) <= t for o in seen):
                    seen.append(line)
                    continue
                seen.append(line)
            kept.append(line)
        out[d] = "\n".join(kept)
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(22, 40))) for _ in range(25)]
    documents = []
    for d in range(60):
        lines = [rng.choice(["", "x", "- y", _edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3, 4]))]) for _ in range(rng.randint(0, 5))]
        documents.append((d, "\n".join(lines)))
    documents += [(60, None), (61, ""), (62, "\n\n"), (63, "z" * 300), (64, "z" * 299)]
    df = spark.createDataFrame([(d, t, "k") for d, t in documents], "doc_id long, text string, k1 string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in L.dedup(df).collect()}
    want = _brute(documents, L.THRESHOLD, L.MIN_CHARS)
    assert {d: x[0] for d, x in got.items()} == want
    assert got[60] == (None, 0, 0) and got[61] == ("", 1, 0) and got[64] == ("", 1, 1)
    full = L.dedup_documents(df)
    assert full.columns == df.columns
    assert {r.doc_id: r.text for r in full.collect()} == want


def test_repeated_rows_null_ids_and_empty_tables(spark):
    line = "the same long line of text here"
    df = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line + "!")], "doc_id long, text string")
    got = sorted(((r.doc_id or 9, r.text) for r in L.dedup(df).collect()))
    assert got == [(1, line), (1, line), (2, ""), (9, "")]
    assert L.dedup(df.limit(0)).count() == 0


def test_short_lines_are_compared_down_to_the_methods_bound(spark):
    rng = random.Random(11)
    base = ["Read more", "Subscribe now", "12345"] + ["".join(rng.choice("abcé ") for _ in range(rng.randint(4, 23))) for _ in range(12)]
    documents = [(0, "Read more\nfirst text"), (1, "Read more\nSubscribe now\n1234"), (2, "Read more\nSubscribe now!\n1234\n12345"), (3, "Read more")]
    documents += [(d, "\n".join(_edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 4)))) for d in range(4, 50)]
    got = {r.doc_id: r.text for r in L.dedup(spark.createDataFrame(documents, "doc_id long, text string")).collect()}
    assert got == _brute(documents, 2, 5)
    assert (got[1], got[2], got[3]) == ("Subscribe now\n1234", "1234\n12345", "")


def test_lines_are_not_sent_through_the_driver(spark, tmp_path):
    spark.createDataFrame([(0, "some line of text"), (1, "some line of test"), (2, "another line here")], "nid long, line string").write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t")).select("nid", "line", F.length("line").alias("n"), L.letter_counts(F.col("line")).alias("counts"))
    near = L._near(spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long"), texts, 2)
    assert [r.nid for r in near.collect()] == [1]
    plan = near._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2  # beside the joins of counts
    docs = spark.createDataFrame([(0, "first line here\nsecond line here")], "doc_id long, text string")
    places = spark.createDataFrame([], "k1 long, k2 long, pos int, nid long")
    assert "BroadcastHashJoin" not in L._fetched(docs, places, "doc_id", "text")._jdf.queryExecution().sparkPlan().toString()
