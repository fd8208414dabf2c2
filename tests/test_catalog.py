"""Queries without SQL, on small tables against plain-Python models."""

import collections
import random

from pyspark.sql import functions as F

from sporelight import catalog
from sporelight.operators import reads


def _table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_pruning_reads_every_line_item(spark, tmp_path):
    rng = random.Random(5)
    parts = {s: {rng.randint(1, 400) for _ in range(rng.randint(20, 30))} for s in range(12)}
    for s in range(12, 24):  # some within the bounds of an earlier group, some just beyond
        parts[s] = set(rng.sample(sorted(parts[s - 12]), 15)) | set(rng.sample(range(500, 600), rng.randint(1, 7)))
    parts[24] = {p + 12 for p in parts[0]}  # the same contigs modulo 12, none of them shared
    rows = [(s, p, float(rng.randint(1, 50)), rng.randint(1, 7)) for s, ps in parts.items() for p in ps]
    _table(spark, tmp_path, "lineitem", rows + rows[:40], "l_suppkey long, l_partkey long, l_quantity double, l_linenumber int")
    order = sorted(parts, key=lambda s: (-len(parts[s]), s))
    edges = set()
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            shared, own = len(parts[a] & parts[b]), len(parts[b] - parts[a])
            if shared and own / len(parts[b]) <= 0.25 and own * 8 / 400 <= 0.5 and own * 8 <= 100:
                edges.add((a, b))
    kept = []
    for b in order:
        if not any((a, b) in edges for a in kept):
            kept.append(b)
    name = lambda s: f"s{s:06}"
    assert 0 < len(edges) < 12
    assert {(r.a, r.b) for r in catalog.prune_edges_whole(spark, str(tmp_path)).collect()} == {(name(a), name(b)) for a, b in edges}
    assert sorted(r.group_id for r in catalog.prune_kernel(spark, str(tmp_path)).collect()) == sorted(map(name, kept))


def test_trimming_reads_whole_texts(spark, tmp_path):
    rng = random.Random(6)
    probe = "AND THE OF "  # the adapter's first 11

    def text():
        s = "".join(rng.choice("acgtnß é😀\n") for _ in range(rng.randint(0, 150)))
        for _ in range(rng.randint(0, 3)):
            seed = list(probe)
            for at in rng.sample(range(11), rng.randint(0, 3)):
                seed[at] = rng.choice("x😀\n")
            at = rng.randint(0, len(s))
            s = s[:at] + "".join(seed).lower() + s[at:]
        return s

    texts = ["", "and the of ", "x" * 70 + "and the of the", "x" * 70 + "and thy of the", "😀" * 70 + "any the of ", None] + [text() for _ in range(200)]
    _table(spark, tmp_path, "documents", list(enumerate(texts)), "doc_id long, text string")

    def want(s):
        up = "".join(c.upper() if c != "ß" else "SS" for c in s)
        near = [(sum(a != b for a, b in zip(up[i : i + 11], probe)), i) for i in range(len(up) - 10)]
        return min((x for x in near if x[0] <= 1), default=(0, len(up)))[1]

    got = {r.doc_id: r for r in catalog.adapter_trim_whole(spark, str(tmp_path)).collect()}
    assert [(i, got[i].pos3) for i, t in enumerate(texts) if t is not None] == [(i, want(t)) for i, t in enumerate(texts) if t is not None]
    assert got[5].pos3 is None and [(got[i].status3, got[i].outcome) for i in (0, 1, 2, 3)] == [("null", "rejected"), ("null", "rejected"), ("match", "clean"), ("match", "clean")]


def test_three_prime_position_at_any_distance(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("AC.") for _ in range(rng.randint(0, 14))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for probe, d in (("AC.CA", 0), ("AC.CA", 2), ("AC", 2), ("AC", 3)):
        near = lambda t: min(((m, i) for i in range(len(t) - len(probe) + 1) if (m := sum(a != b for a, b in zip(t[i:], probe))) <= d), default=(0, len(t)))[1]  # noqa: B023, E731
        assert [r.x for r in df.select(reads.three_prime_position(F.col("s"), probe, d).alias("x")).collect()] == [near(t) for t in texts]


def test_documents_are_counted_and_searched(spark, tmp_path):
    rng = random.Random(8)
    texts = ["".join(rng.choice("acgté😀\n ") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["", None]
    texts += ["xx gattaca yy", "z" * 40 + "a passage of the benchmark" + "z" * 40]
    items = ["a passage of the benchmark", "nowhere to be found", "gattaca"]
    _table(spark, tmp_path, "documents", list(enumerate(texts)), "doc_id long, text string")
    _table(spark, tmp_path, "benchmark", list(enumerate(items)), "item_id long, text string")
    want = collections.Counter(t[i : i + 8] for t in texts if t for i in range(len(t) - 7))
    assert {r.kmer: r.n for r in catalog.kmer_spectrum_documents(spark, str(tmp_path)).collect()} == want
    rows = [(i, t.upper()) for i, t in enumerate(texts) if t] + [(-1 - i, t.upper()) for i, t in enumerate(items)]
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    held = {i for i, s in rows if any((len(o) > len(s) or (len(o) == len(s) and j < i)) and (s in o or turn(s) in o) for j, o in rows)}
    assert {-1, -3} <= held and -2 not in held
    assert [r.ord for r in catalog.contained_contigs_documents(spark, str(tmp_path)).collect()] == sorted(i for i, _ in rows if i not in held)


def test_capitals_of_several_letters(spark, tmp_path):
    import duckdb

    texts = ["ß" + "tzente in mit. Einau stauein. " * 4, "y" * 98 + "ß", "z" * 98 + "ŉ", "ﬁx ᾳ ß " * 20, "plain words " * 20, None, "", "ß" * 99]
    _table(spark, tmp_path, "documents", list(enumerate(texts)), "doc_id long, text string")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = sorted(r.ord for r in catalog.canonical_dedup(spark, str(tmp_path)).collect())
    assert found == sorted(r[0] for r in db.sql(catalog.SQL["canonical_dedup"]).fetchall())


def test_shared_contigs_in_pieces(spark, monkeypatch):
    from sporelight.operators import hits

    monkeypatch.setattr(hits, "_PIECE", 4)
    rng = random.Random(8)
    groups = {r: {rng.randint(0, 30) for _ in range(rng.randint(1, 20))} | {99} for r in range(1, 40)}
    mine = spark.createDataFrame([(k, r, str(c)) for k in ("blastn", "blastx") for r, cs in groups.items() for c in cs], "analysis string, rank int, contig_id string")
    for ratio in (0.25, 0.79, 1.0):
        want = {(a, b, len(groups[a] & groups[b])) for a in groups for b in groups if a < b and len(groups[b] - groups[a]) / len(groups[b]) <= ratio}
        found = hits.shared_contigs(mine, ratio).collect()
        for k in ("blastn", "blastx"):
            assert sorted((r.rank_a, r.rank_b, r.shared) for r in found if r.analysis == k) == sorted(want)


def test_containment_by_stretches(spark):
    from sporelight.operators import contigs

    rng = random.Random(3)
    long = "".join(rng.choice("ACGTN") for _ in range(9000))
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    texts = [long, *(f(long[at : at + n]) for n in (1, 5, 15, 16, 17, 31, 32, 700, 5000, 8999) for at in (0, 1) for f in (str, turn)), *("".join(rng.choice("ACGT") for _ in range(n)) for n in (15, 16, 40, 5000)), "qq aßb qq", "assb"]
    up = [t.replace("ß", "ẞ").upper() for t in texts]
    inside = lambda i, j: (len(up[j]) > len(up[i]) or (len(up[j]) == len(up[i]) and j < i)) and (up[i] in up[j] or turn(up[i]) in up[j])
    want = [i for i in range(len(up)) if not any(inside(i, j) for j in range(len(up)))]
    found = contigs.drop_contained(spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string"))
    assert [r.ord for r in found.collect()] == want


def test_words_of_texts_in_slices(spark):
    from sporelight.operators import contigs

    rng = random.Random(4)
    texts = [None, "", "short", "exactly8", "nul\0" * 4, "".join(map(chr, range(0x4E00, 0x4E00 + 700))), *("".join(rng.choice("ab ßé😀") for _ in range(rng.randint(0, 300))) for _ in range(60))]
    for k in (1, 8):
        want = collections.Counter(t[i : i + k] for t in texts if t for i in range(len(t) - k + 1))
        found = contigs.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"), k).collect()
        assert {r.kmer: r.n for r in found} == dict(want) and len(found) == len(want)


def test_capitals_of_every_letter_without_a_search_for_rare_ones(spark, tmp_path):
    import duckdb

    from sporelight.functions import sequence as S

    letters = [chr(c) for c in range(1, 0x20100) if not 0xD800 <= c < 0xE000]
    texts = ["".join(letters[i : i + 150]) for i in range(0, len(letters), 150)]
    _table(spark, tmp_path, "documents", list(enumerate([*texts, None, ""])), "doc_id long, text string")
    db = duckdb.connect()
    want = dict(db.sql(f"SELECT doc_id, upper(text) FROM '{tmp_path}/documents.parquet/*.parquet'").fetchall())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", S.upper(F.col("text")).alias("u"), S.upper_reverse_complement(F.col("text")).alias("rc"), S.iupac_reverse_complement(S.upper(F.col("text"))).alias("plain_rc"))
    assert all(r.u == want[r.doc_id] and r.rc == r.plain_rc for r in docs.collect())
    assert ["".join(map(chr, S.upper_codes(t).tolist())) for t in texts] == [want[i] for i in range(len(texts))]
    for out in (catalog.canonical_dedup(spark, str(tmp_path)), docs.select("u")):  # a class of 130 letters, searched letter by letter, took nine tenths of the time
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan.upper() or "ŉ" not in plan.split("RLIKE", 1)[1].split("]", 1)[0]


def test_shared_beginnings_bring_no_pairs_of_texts(spark):
    from sporelight.operators import contigs

    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("acgtefhé😀") for _ in range(n))
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    head = some(3000)
    texts = [head + some(1000 + i) for i in range(80)]
    texts += [texts[5][10:3990], turn(texts[6].upper()[700:3500]), texts[7], head[100:200], "z" * 300, "z" * 200, "zy" * 20, "x" + "zy" * 50, texts[9][:3500] + "q"]
    up = [t.upper() for t in texts]
    inside = lambda i, j: (len(up[j]) > len(up[i]) or (len(up[j]) == len(up[i]) and j < i)) and (up[i] in up[j] or turn(up[i]) in up[j])
    want = [i for i in range(len(up)) if not any(inside(i, j) for j in range(len(up)))]
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().dagScheduler()
    first = tracker.nextStageId()
    found = contigs.drop_contained(spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string"))
    assert [r.ord for r in found.collect()] == want and len(want) == 83
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    sent = 0
    for i in range(first, tracker.nextStageId()):
        try:
            sent += store.lastStageAttempt(i).shuffleWriteBytes()
        except Exception:  # a stage that never ran
            pass
    assert sent < 2 * sum(len(t.encode()) for t in texts)


def test_places_of_a_word_in_pieces(spark, monkeypatch):
    from sporelight.operators import contigs

    monkeypatch.setattr(contigs, "_AT_ONCE", 3)
    texts = ["ab" * 40 + "c", "ba" * 30 + "c", "ab" * 30, "b" * 50, "a" + "b" * 50 + "ab", "", "x", "yxy", "abab" * 5 + "x"]
    inside = lambda i, j: (len(texts[j]) > len(texts[i]) or (len(texts[j]) == len(texts[i]) and j < i)) and texts[i] in texts[j]
    want = [i for i in range(len(texts)) if texts[i] and not any(inside(i, j) for j in range(len(texts)))]
    for k in (4, 16):
        assert [r.ord for r in contigs.drop_contained(spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string"), k).collect()] == want
