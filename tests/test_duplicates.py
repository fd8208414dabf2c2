"""Clusters at an identity and removal of duplicates, against plain loops; classification by classified rows."""

import random

import pytest

from sporelight import schemas
from sporelight.operators import cluster, taxonomy

TURN = str.maketrans("ACGT", "TGCA")


def _edits(short, long):
    """Fewest edits of the whole shorter text anywhere in the longer one; an unknown base equals nothing."""
    above = [0] * (len(long) + 1)
    for i, a in enumerate(short, 1):
        row = [i]
        for j, b in enumerate(long, 1):
            row.append(min(above[j - 1] + (a != b or a not in "ACGT"), above[j] + 1, row[j - 1] + 1))
        above = row
    return min(above)


def _changed(rnd, text, n):
    s = list(text)
    for _ in range(n):
        i = rnd.randrange(len(s))
        s[i] = rnd.choice(["", "A", "C", "GT", "N"])
    return "".join(s)


def _records(spark, texts):
    return spark.createDataFrame([(i, f"s{i}", f"s{i}", t) for i, t in enumerate(texts)], schemas.SEQ)


@pytest.mark.parametrize("identity", [0.95, 0.85])
def test_clusters_equal_brute_force(spark, identity):
    rnd = random.Random(21)
    texts = []
    for _ in range(5):
        whole = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(60, 130)))
        for _ in range(6):
            n = rnd.randint(25, len(whole))
            at = rnd.randint(0, len(whole) - n)
            part = _changed(rnd, whole[at : at + n], rnd.randint(0, n // 10))
            texts.append(part if rnd.random() < 0.6 else part[::-1].translate(TURN))
    texts += ["", "ACG", "ACG", "T" * 50, "T" * 49]
    rnd.shuffle(texts)
    order = sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i))
    pairs = set()
    for x, a in enumerate(order):
        for b in order[x + 1 :]:
            t = texts[b]
            if t and min(_edits(t, texts[a]), _edits(t[::-1].translate(TURN), texts[a])) <= int(len(t) * (1 - identity) + 1e-9):
                pairs.add((a, b))
    df = _records(spark, texts).repartition(3)
    assert {(r.a, r.b) for r in cluster.similar_pairs(df, identity).collect()} == pairs
    kept = []
    for b in order:
        if not any((a, b) in pairs for a in kept):
            kept.append(b)
    assert sorted(r.ord for r in cluster.representatives(df, identity).collect()) == sorted(kept)
    assert cluster.representatives(df.limit(0), identity).count() == 0


def test_duplicates_go_with_their_reasons(spark):
    rnd = random.Random(22)
    a, b, c = ("".join(rnd.choice("ACGT") for _ in range(n)) for n in (400, 300, 250))
    texts = [a, a[::-1].translate(TURN), a.lower(), a[20:380], b, b[:290][::-1].translate(TURN), c, "ACGT" * 5, "A" * 500, None]
    kept, table = cluster.without_duplicates(_records(spark, texts), longest=450)
    assert sorted(r.seq_id for r in kept.collect()) == ["s0", "s4", "s6"]
    assert kept.columns == ["ord", "header", "seq_id", "sequence"]
    got = sorted((r.id, r.reason, r.partner) for r in table.collect())
    assert got == [("s1", "Dup", "s0"), ("s2", "Dup", "s0"), ("s3", "Search", "s0"), ("s5", "Search", "s4"), ("s7", "20", None), ("s8", "500", None), ("s9", "0", None)]


def test_the_best_hit_is_folded_in_source_order(spark):
    rnd = random.Random(23)
    rows = [(i, f"q{rnd.randint(0, 30)}", f"s{rnd.randint(0, 8)}", float(rnd.randint(80, 99)), rnd.randint(20, 60), float(rnd.randint(50, 90)), f"D{i % 3}") for i in range(500)]
    best = {}
    for r in rows:
        old = best.get(r[2])
        if old is None or all(r[i] > old[i] for i in (3, 4, 5)):
            best[r[2]] = r
    df = spark.createDataFrame(rows, "ord long, query string, subject string, identity double, length int, score double, division string").repartition(4)
    out = taxonomy.best_by_subject(df, "division").collect()
    assert {(r.query, r.subject, r.identity, r.length, r.score, r.division) for r in out} == {r[1:] for r in best.values()}
    few = taxonomy.top_hits(df, 2).collect()
    score, first = {}, {}
    for o, q, s, _, _, x, _ in rows:
        score[q, s] = max(x, score.get((q, s), 0))
        first.setdefault((q, s), o)
    want = {p for q in {r[1] for r in rows} for p in sorted((p for p in score if p[0] == q), key=lambda p: (-score[p], first[p]))[:2]}
    assert {(r.query, r.subject) for r in few} == want and len(few) == sum((r[1], r[2]) in want for r in rows)


def test_classified_rows_vote_by_description_and_by_search(spark):
    records = [(0, "a", "Tomato virus X gene", "Plants"), (1, "b", "tomato virus x, complete", "Plants"), (2, "c", "Tomato virus X other", "Fungi"), (3, "u", "Tomato virus X part", "Unassigned"), (4, "v", "nothing like it", "Unassigned"), (5, "w", None, "Unassigned")]
    hits = [(0, "a", "u", 90.0, 50, 2, 1, 80.0, "Plants"), (1, "c", "u", 95.0, 60, 1, 0, 90.0, "Fungi"), (2, "b", "v", 99.0, 40, 0, 0, 70.0, "Plants")]
    out = taxonomy.classify_by_classified(spark.createDataFrame(records, "ord long, id string, description string, category string"), spark.createDataFrame(hits, "ord long, query string, subject string, identity double, length int, mismatches int, gaps int, score double, division string"))
    got = {r.id: tuple(r)[2:] for r in out.collect()}
    assert got == {"u": ("tomato virus x", "Plants", 2, 66.67, "a,b,c", "Fungi", "c", 59, 95.0, 90.0), "v": (None,) * 5 + ("Plants", "b", 40, 99.0, 70.0), "w": (None,) * 10}
