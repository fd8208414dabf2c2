"""Pileup rows are folded into stretches before anything is sorted; results are those of single rows."""

import random

import pytest

from sporelight import schemas
from sporelight.operators import pileup


def _sent(spark, run):
    """What ``run`` gives, and the rows that its stages sent over the network."""
    store = spark.sparkContext._jsc.sc().statusStore()
    tracker = spark.sparkContext._jsc.sc().dagScheduler()
    first = tracker.nextStageId()
    out = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total = 0
    for i in range(first, tracker.nextStageId()):
        try:
            total += store.lastStageAttempt(i).shuffleWriteRecords()
        except Exception:  # a stage that never ran
            pass
    return out, total


def _plain_contigs(rows, lengths, least):
    rows = sorted(rows)
    rows = [r for i, r in enumerate(rows) if i == 0 or r[2] <= lengths.get(r[1], 0)]
    runs = []
    for r in rows:
        if not (runs and runs[-1][-1][1] == r[1] and runs[-1][-1][2] + 1 == r[2]):
            runs.append([])
        runs[-1].append(r)
    good = [x for i, x in enumerate(runs) if len(x) > least and (sum(r[4] for r in x) > 0 or i < len(runs) - 1)]
    return [(f"ALIGNED{i + 1} {x[0][1]} {x[-1][2]}", "".join("" if r[5] == "*" * r[4] and r[4] else r[3] + ("GG" if "+" in r[5] else "") for r in x)) for i, x in enumerate(good)]


@pytest.mark.parametrize("mixed", [False, True])
def test_contigs_of_rows_in_any_order(spark, mixed):
    rng = random.Random(5)
    rows, lengths, at = [], {"a": 60, "b": 1000, "c": 30}, 0
    for name in ("a", "b", "c", "b", "unknown", "a"):
        pos = rng.randint(0, 3)
        for _ in range(rng.randint(30, 80)):
            pos += 1 if rng.random() < 0.9 else rng.randint(0, 3)
            depth = rng.choice([0, 2])
            rows.append((at, name, pos, rng.choice("ACGT"), depth, rng.choice(["..", "**", ".+2GG.+2GG"]) if depth else "", "II"))
            at += 1 if rng.random() < 0.9 else 5
    want = _plain_contigs(rows, lengths, 3)
    if mixed:
        rng.shuffle(rows)
    df = spark.createDataFrame(rows, schemas.PILEUP).repartition(3, "depth") if mixed else spark.createDataFrame(rows, schemas.PILEUP)
    got = pileup.contigs(df, spark.createDataFrame(list(lengths.items()), "ref_id string, length int"), 3).orderBy("ord").collect()
    assert [(r.header, r.sequence) for r in got] == want and len(want) > 8


@pytest.mark.parametrize("mixed", [False, True])
def test_coverage_of_rows_in_any_order(spark, mixed):
    rng = random.Random(6)
    rows, lengths, at = [], {"a": 60, "b": 50}, 0
    for _ in range(60):
        name = rng.choice(["a", "b", "unknown", None])
        for _ in range(rng.choice([1, 2, 10, 25, 30])):
            rows.append((at, name, at % 50, "A", 1, ".", "I"))
            at += rng.randint(1, 3)
    runs = []
    for r in rows:
        if not (runs and runs[-1][-1][1] == r[1]):
            runs.append([])
        runs[-1].append(r)
    want = [r for x in runs if len(x) > lengths.get(x[0][1], 0) * 0.5 for r in x]
    if mixed:
        rng.shuffle(rows)
    got = pileup.filter_coverage(spark.createDataFrame(rows, schemas.PILEUP), spark.createDataFrame(list(lengths.items()), "ref_id string, length int"), 0.5)
    assert [tuple(r) for r in got.orderBy("ord").collect()] == want and 0 < len(want) < len(rows)


def test_no_row_of_an_ordered_pileup_is_sent(spark):
    n = 20_000
    rows = spark.range(n).selectExpr("id AS ord", "string(id div 5000) AS ref_id", "int(id % 5000 + 1) AS pos", "'A' AS ref_base", "2 AS depth", "'..' AS bases", "'II' AS quals")
    lengths = spark.createDataFrame([(str(i), 5000) for i in range(4)], "ref_id string, length int")
    found, sent = _sent(spark, lambda: pileup.contigs(rows, lengths).collect())
    assert sorted(len(r.sequence) for r in found) == [5000] * 4 and sent < n / 10
    kept, sent = _sent(spark, lambda: pileup.filter_coverage(rows, lengths, 0.5).count())
    assert kept == n and sent < n / 10


def test_depths_are_counted_by_batches(spark):
    rows = [("q1", "r", 3, "2M0D3M", "ACGTN"), ("q2", "r", 3, "1S2M1D1M2N1M9H", "GACTC"), ("q3", "r", 5, "4M", "a"), ("q4", "r", 1, "2M", None), ("q5", "r", 1, None, "AC"), ("q6", None, 1, "1M", "A"), ("q7", "é", 2, "2M1I", "éGT")]
    df = spark.createDataFrame(rows, "qname string, rname string, pos int, cigar string, seq string")
    found = pileup.depth_by_position(df)
    got = {(r.rname, r.pos): tuple(r)[2:] for r in found.collect()}
    want = {}
    for r in pileup.columns_of(df.where("rname IS NOT NULL")).collect():
        n = want.setdefault((r.rname, r.pos), [0] * 9)
        n[0] += 1
        if r.base and r.base in "ACGTN*":
            n["ACGTN*".index(r.base) + 1] += 1
        n[7] += r.starts
        n[8] += r.ends
    assert got == {k: tuple(v) for k, v in want.items()} and got["r", 5] == (3, 1, 0, 1, 0, 0, 1, 1, 0)
    assert "Generate" not in found._jdf.queryExecution().toString()  # no row for each position of each read
    assert [(r.pos, r.bases) for r in pileup.insertions_of(df).collect()] == [(3, "T")]
