"""Corpus operators against brute force, on the smallest tables and on awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from sporelight.llm import classlm, components, decontaminate, langid, ngramjoin, quality, secrets, toxicity
from sporelight.llm import kernel as K

AWKWARD = ["", None, " \n\t", "one", "two words", "Éa É x …", "x" * 5000, "a b c " * 700, "ab\x00cd\x1fef", "\n\n\n"]


def docs(spark, texts, extra="text2 string"):
    return spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], f"doc_id long, text string, {extra}")


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghié") for _ in range(rng.randint(2, 7))) for _ in range(n)]


# kernels


def test_runs_and_hashes_follow_the_regular_expressions():
    texts = [t for t in AWKWARD] + ["Hello, WORLD! x9 z", "café-au"]
    for table, pattern in ((K.SPACE_WORDS, r"[^\x20\x09-\x0D]+"), (K.ALNUM_WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        for size in (1, 40, 1 << 20):
            seen, found = {}, []
            for s in K.slices(pa.array(texts, pa.string()), size):
                data = K.fold(s.data)
                start, end, offsets = K.runs(data, s.offsets, table)
                h = K.hash_runs(data, start, end)
                for i in range(s.rows):
                    words = [data[start[j] : end[j]].tobytes().decode() for j in range(offsets[i], offsets[i + 1])]
                    found.append(words)
                    for w, x in zip(words, h[offsets[i] : offsets[i + 1]].tolist(), strict=True):
                        assert seen.setdefault(w, x) == x
            lower = str.maketrans({c: c + 32 for c in range(65, 91)})
            assert found == [re.findall(pattern, (t or "").translate(lower)) for t in texts]
            assert len(set(seen.values())) == len(seen)


# n-gram join


def jaccard_components(texts, n, t):
    sets = []
    for x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(str.maketrans({c: c + 32 for c in range(65, 91)})))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) * t.denominator >= t.numerator * len(a | b):
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in range(len(texts))}


@pytest.mark.parametrize("n,t", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_join_equals_brute_force(spark, n, t):
    rng = random.Random(n)
    words = vocabulary(rng, 300)
    texts = list(AWKWARD)
    for _ in range(25):
        base = prose(rng, rng.choice([3, 6, 12, 40, 150, 400]), words).split()
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy[: len(copy) - rng.randint(0, 2)]))
    passage = prose(rng, 60, words)
    texts += [passage + " " + prose(rng, rng.randint(5, 60), words) for _ in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.link_components(docs(spark, texts), n=n, threshold=t).collect()}
    assert got == jaccard_components(texts, n, t)
    kept = {r.doc_id for r in ngramjoin.keep_one(docs(spark, texts), n=n, threshold=t).collect()}
    assert kept == {i for i, (_, c) in got.items() if i == c}


def test_rtree_finds_all_that_reach_the_bound():
    rng = np.random.default_rng(1)
    base = rng.poisson(3, (20, ngramjoin.COORDINATES)).astype(np.uint32)
    points = np.concatenate([base + (rng.random(base.shape) < 0.05) for _ in range(20)]).astype(np.uint32)
    t = Fraction(9, 10)
    q, e = ngramjoin.RTree(points).search(points, t)
    size = points.sum(1).astype(np.int64)
    want = {(i, j) for i in range(len(points)) for j in range(len(points)) if np.minimum(points[i], points[j]).sum() >= ngramjoin.need(size[i], size[j], t)}
    assert set(zip(q.tolist(), e.tolist(), strict=True)) == want


def test_join_of_empty_tables_null_ids_and_repeats(spark):
    df = docs(spark, ["a b c d", "a b c d"])
    assert ngramjoin.link_components(df.limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (5, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in ngramjoin.link_components(rows).collect()) == [(-1, -1), (3, 3), (3, 3), (5, 3)]
    assert sorted((r.doc_id or -1) for r in ngramjoin.keep_one(rows).collect()) == [-1, 3]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(1, i) for i in range(2, 20)] + [(50, 50)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 131), 100), **dict.fromkeys(range(1, 20), 1)}


# decontamination


def contaminated(texts, items, n):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans({c: c + 32 for c in range(65, 91)})))
    out = {}
    for d, t in enumerate(texts):
        w, hit, ids = split(t), set(), set()
        for i, x in items:
            v = split(x)
            k = min(n, len(v))
            wanted = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if k else set()
            for j in range(len(w) - k + 1) if k else ():
                if tuple(w[j : j + k]) in wanted:
                    hit |= set(range(j, j + k))
                    ids.add(str(i))
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(11)
    words = vocabulary(rng, 6)
    items = [(i, prose(rng, rng.randint(0, 25), words)) for i in range(20)] + [(90, None), (91, ""), (92, "..."), (93, items_ := "lone")]
    texts = AWKWARD + [prose(rng, rng.randint(0, 60), words) + " " + (rng.choice(items)[1] or "") + ", " + prose(rng, 5, words) for _ in range(40)] + ["x LONE. y", items_]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(docs(spark, texts, "n_words string"), bench, block_bytes=block_bytes).collect()}
    want = contaminated(texts, items, 10)
    assert got == want
    left = decontaminate.clean(docs(spark, texts, "row string"), bench, block_bytes=block_bytes)
    assert left.columns == ["doc_id", "text", "row"] and {r.doc_id for r in left.collect()} == {d for d, x in want.items() if not x[4]}


def test_longest_matches_and_an_empty_benchmark(spark):
    df = docs(spark, ["q " + " ".join(f"w{i}" for i in range(20)) + " r"])
    bench = spark.createDataFrame([(7, "zz " + " ".join(f"w{i}" for i in range(4, 18)) + " yy")], "item_id long, text string")
    r = decontaminate.mark(df, bench).first()
    assert [tuple(m) for m in r.matches] == [("7", 1, 5, 14)] and r.n_hit == 14
    assert decontaminate.clean(df, bench.limit(0)).count() == 1 and decontaminate.report(df.limit(0), bench).count() == 0


# quality


def test_base_figures_and_viterbi(spark):
    rng = random.Random(5)
    texts = AWKWARD + ["A b c\nA b c\nA b c\n#x|y\nA b c d", "\r\n \r\nq"] + ["\n".join(prose(rng, rng.randint(0, 9), ["a", "B", "cc,", "d.", "|"]) for _ in range(rng.randint(1, 8))) for _ in range(40)]
    for s in K.slices(pa.array(texts, pa.string()), 300):
        base, lines = quality.describe(s)
        for i in range(s.rows):
            t = texts[s.first + i] or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            seen, dup = set(), 0
            for line in t.split("\n"):
                dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
                seen.add(line)
            c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
            hit = {j + k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in range(3)}
            assert base[i].tolist() == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)], t
            assert lines.offsets[i + 1] - lines.offsets[i] == t.count("\n") + 1
    gen = np.random.default_rng(3)
    sizes = [1, 4, 0, 6, 2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    score, move = gen.normal(size=(offsets[-1], 2)), gen.normal(size=(2, 2))
    label = quality.viterbi(score, offsets, move)
    p, _ = quality._expected(score, offsets, move)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        paths = list(itertools.product((0, 1), repeat=int(b - a)))
        worth = [sum(score[a + i, y] for i, y in enumerate(q)) + sum(move[x, y] for x, y in zip(q, q[1:], strict=False)) for q in paths]
        assert label[a:b].tolist() == list(paths[int(np.argmax(worth))])
        z = np.exp(worth)
        for i in range(b - a):
            assert p[a + i, 1] == pytest.approx(sum(v for v, q in zip(z, paths, strict=True) if q[i]) / z.sum())


def test_quality_keeps_prose_and_rejects_junk(spark):
    rng = random.Random(7)
    words = vocabulary(rng, 400)
    good = ["\n".join(prose(rng, 30, words).capitalize() + "." for _ in range(5)) for _ in range(40)]
    bad = ["\n".join(" ".join(w + rng.choice(["###", "%%%", "&&&"]) for w in prose(rng, 30, words).split()) for _ in range(5)) for _ in range(40)]
    df = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80) if i % 2] + [(None, 1), (3, None)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.keep(df, labels).collect()}
    assert kept == set(range(40))
    assert quality.keep(df.limit(0), labels.limit(0)).count() == 0
    unlabelled = quality.judge(docs(spark, AWKWARD), quality.learn(df, labels.limit(0)))
    assert not any(r.kept for r in unlabelled.collect() if r.base_failed)


# language model


def test_base_scores_equal_a_plain_count(spark):
    rng = random.Random(2)
    words = vocabulary(rng, 60)
    texts = AWKWARD + [prose(rng, rng.randint(0, 60), words) for _ in range(60)]
    df = docs(spark, texts)
    model, counts = classlm.learn(df.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in classlm.score(df, model, counts).collect()}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans({c: c + 32 for c in range(65, 91)}))) + ["\n"]
    c = collections.Counter(w for i, t in enumerate(texts) if i % 3 for w in split(t))
    n, v = sum(c.values()), len(c)
    assert (model.tokens, model.distinct) == (n, v)
    for i, t in enumerate(texts):
        w = split(t)
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert (got[i].n_tokens, got[i].n_known) == (len(w), sum(c[x] > 0 for x in w))
    empty, none = classlm.learn(df.limit(0))
    assert all(r.n_known == 0 for r in classlm.score(df, empty, none).collect())


def test_tail_tokens_get_the_same_scores(spark, monkeypatch):
    rng = random.Random(4)
    words = vocabulary(rng, 3000)
    df = docs(spark, [prose(rng, 60, words) for _ in range(60)])
    whole = {r.doc_id: (r.base_score, r.score, r.n_known) for r in classlm.score(df, *classlm.learn(df)).collect()}
    monkeypatch.setattr(classlm, "HEAD", classlm.CLUSTERED + 1)
    some = {r.doc_id: (r.base_score, r.score, r.n_known) for r in classlm.score(df, *classlm.learn(df)).collect()}
    assert {k: pytest.approx(v) for k, v in whole.items()} == some


def test_exchange_finds_alternating_classes():
    n = np.zeros((8, 8))
    n[:4, 4:] = n[4:, :4] = 5  # words of one half follow words of the other
    label = classlm.exchange(n, 2)
    assert len(set(label[:4])) == len(set(label[4:])) == 1 and label[0] != label[4]


# language


def test_languages_and_mixtures(spark):
    rng = random.Random(1)
    speech = {"aa": ["kulo", "mira", "tako", "sena"], "bb": ["schwurz", "pfing", "tzent", "krach"]}
    rows = [(i, prose(rng, 40, speech[lang]), lang) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
    df = spark.createDataFrame(rows + [(97, None, "aa"), (98, "kulo", None)], "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert model.languages == ["aa", "bb"]
    tests = ["kulo tako sena mira", "PFING tzent", "", None, "123 …", "kulo mira tako sena kulo mira tako sena tako mira schwurz pfing tzent krach pfing tzent krach krach"]
    got = {r.doc_id: r for r in langid.identify(docs(spark, tests, "lang string"), model).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["aa", "bb", "und", "und", "und"]
    assert set(got[5].languages) == {"aa", "bb"} and got[5].languages["aa"] == pytest.approx(10 / 18, abs=0.05)
    nothing = langid.learn(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


# toxicity


def test_toxicity_learns_stems_it_has_not_seen_whole(spark):
    rng = random.Random(3)
    words = vocabulary(rng, 500)
    texts, labels = [], []
    for i in range(300):
        w = prose(rng, rng.randint(10, 60), words).split()
        if i % 3 == 0:
            w.insert(rng.randrange(len(w)), "zorgk" + rng.choice(words))
        texts.append(" ".join(w).upper() if i % 7 == 0 else " ".join(w))
        labels.append((i, int(i % 3 == 0)))
    df = docs(spark, texts + ["", None])
    model = toxicity.learn(df.where("doc_id < 200"), spark.createDataFrame(labels[:200] + [(5, None), (None, 1), (9999, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert sum(got[i].predicted == (i % 3 == 0) for i in range(200, 300)) >= 98
    assert got[300].score == got[301].score and 0 <= got[300].score <= 1
    blank = toxicity.learn(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(df, blank).collect()} == {0}


# secrets


def base_findings(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return sorted(out)


def test_secrets_equal_regular_expressions(spark):
    rng = random.Random(12)
    bits = ["password", "Token: ", "API_KEY='", "secret = ", "=", ":", '"', "abcd1234", "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "é", " ", "\n", "x", "deadbeef" * 4, "https://a.io:80", "10.0.0.1", "user=bob ", "Zx9" * 8]
    texts = AWKWARD + ["token=secret=abcdefgh1", "token: secret: abcdefgh12"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    got = {r.doc_id: r for r in secrets.scan(docs(spark, texts, "base string")).collect()}
    for i, t in enumerate(texts):
        assert sorted(tuple(x) for x in got[i].base) == base_findings(t), t
        assert {tuple(x) for x in got[i].base} <= {tuple(x) for x in got[i].spans}


def test_weak_parts_need_their_complement_in_scope(spark):
    token = "Ab3" * 8
    texts = [f"user=bob {token}", token, f"user=bob {'x ' * 200}{token}", f"http://db.io user=bob {token}", "user=bob http://db.io", "AKIAABCDEFGH1234567 " + token]
    got = {r.doc_id: [secrets.KINDS[x.kind] for x in r.spans] for r in secrets.scan(docs(spark, texts)).collect()}
    assert got == {0: ["ident", "secret"], 1: [], 2: [], 3: ["endpoint", "ident", "secret"], 4: [], 5: ["access", "secret"]}


def test_remainders_follow_crc32(spark):
    rows = spark.range(50).select("id", langid.remainder(5, "id").alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    original = spark.read.parquet(f"{sf}/documents.parquet")
    frame = original
    for name, stage in P.STAGES[:-1]:
        before = frame
        frame = P.written(stage(spark, before, sf), "test-stage")
        assert frame.columns == original.columns
        assert 0 < frame.count() <= before.count(), name
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [r.text for r in frame.collect()]
    assert not any(x[4] for x in contaminated(texts, bench, 10).values())
    assert all(c == i for i, (_, c) in jaccard_components(texts, 5, Fraction(4, 5)).items())
    assert P.STAGES[-1][1](spark, frame, sf).select("doc_id").distinct().count() == len(texts)
