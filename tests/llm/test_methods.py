"""The operators' methods against plain-Python models, and awkward tables through all of them."""

import collections
import math
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sporelight.llm import base, classlm, decontaminate, entries, langid, linededup, ngramjoin, packing, quality, secrets, toxicity, urlfilter
from sporelight.llm import kernel as K

from .test_corpus import docs, jaccard_components, prose, vocabulary

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def thue_morse(n):
    """A word and its complement, which a polynomial modulo a power of two can't tell apart."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_in_thue_morse_order_differ(spark, n):
    a, b = thue_morse(n)
    df = docs(spark, [f"{a} x y z", f"{b} x y z", f"{a}\n{b}", f"{a} {b} {a}"])
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    got = collections.defaultdict(list)
    for r in packing.pack(df).orderBy("doc_id", "start").collect():
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    for i, t in enumerate([f"{a} x y z", f"{b} x y z", f"{a}\n{b}", f"{a} {b} {a}"]):
        assert got[i] == [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID]
    bench = spark.createDataFrame([(1, f"{a} x"), (2, f"{b} x")], "item_id int, text string")
    assert {r.doc_id: r.n_items for r in decontaminate.report(df, bench).collect()} == {0: 1, 1: 1, 2: 0, 3: 0}
    links = ngramjoin.link_components(docs(spark, [f"{a} x y", f"{b} x y", f"{a} x y"])).collect()
    assert {r.doc_id: r.component_id for r in links} == {0: 0, 1: 1, 2: 0}
    figures, _ = quality.describe(next(K.slices(pa.array([f"{a}\n{b}", f"{a}\n{a}"]))))
    assert figures[:, 3].tolist() == [0, 1]
    model, counts = classlm.learn(docs(spark, [a, a, b]))
    assert model.distinct == 3 and {(r.h, r.c) for r in counts.collect()} == {(r.h, r.c) for r in counts.collect() if r.c in (1, 2, 3)}


# language model


def test_every_word_has_a_class_and_scores_follow_the_definition(spark):
    rng = random.Random(9)
    vocab = vocabulary(rng, 400)
    weight = [1 / (i + 1) for i in range(len(vocab))]
    texts = [" ".join(rng.choices(vocab, weight, k=rng.randint(0, 80))) for _ in range(120)] + ["never seen wordsé", "", None]
    df = docs(spark, texts)
    model, counts = classlm.learn(df.where("doc_id < 100"), clustered=20, assigned=150)

    def column(words, tail):
        s = next(K.slices(pa.array([" ".join(words)])))
        token, _, ending = classlm._tokens(s, endings=True)
        return model.classes.of(token, ending).tolist() if tail else token.tolist()

    known = sorted({w for t in texts for w in words_of(t)})
    label = dict(zip([*known, "\n"], column(known, True), strict=True))
    assert len(model.classes.label.known) > 20 and label["\n"] == classlm.CLASSES
    streams = [[*words_of(t), "\n"] for t in texts]
    c = collections.Counter(w for s in streams[:100] for w in s)
    steps = collections.Counter((label[a], label[b]) for s in streams[:100] for a, b in zip(["\n", *s], s, strict=False))
    size, kinds = collections.Counter(), collections.Counter()
    for w, n in c.items():
        size[label[w]] += n
        kinds[label[w]] += 1
    start = collections.Counter()
    for (a, _), n in steps.items():
        start[a] += n
    k, d, e = classlm.CLASSES + 1, classlm.TRANSITION_SMOOTHING, classlm.EMISSION_SMOOTHING

    def word(w):
        return (c[w] + e) / (size[label[w]] + e * (kinds[label[w]] + 1))

    for cls in range(k):  # a class's words and one unseen word share its probability
        assert sum(word(w) for w in c if label[w] == cls) + e / (size[cls] + e * (kinds[cls] + 1)) == pytest.approx(1)
    got = {r.doc_id: r for r in classlm.score(df, model, counts).collect()}
    for i, s in enumerate(streams):
        want = sum(math.log10((steps[label[a], label[b]] + d) / (start[label[a]] + d * k) * word(b)) for a, b in zip(["\n", *s], s, strict=False))
        assert got[i].score == pytest.approx(want)


def test_assigned_words_join_the_words_they_behave_like(spark):
    rng = random.Random(2)
    kinds = [[f"{p}{i}" for i in range(14)] for p in ("det", "noun", "verb")]
    texts = []
    for _ in range(800):
        s = []
        for j in range(12):
            k = kinds[j % 3]
            s.append(k[min(int(rng.expovariate(0.35)), 13)])
        texts.append(" ".join(s))
    model, _ = classlm.learn(docs(spark, texts), classes=3, clustered=30)
    s = next(K.slices(pa.array([" ".join(w for k in kinds for w in k)])))
    label = model.classes.of(*(classlm._tokens(s, endings=True)[i] for i in (0, 2))).tolist()
    parts = [collections.Counter(label[i * 14 : i * 14 + 14]) for i in range(3)]
    assert sum(p.most_common(1)[0][1] for p in parts) >= 40 and len({p.most_common(1)[0][0] for p in parts}) == 3


# toxicity


def bucket(gram):
    h = 0
    for ch in gram:
        h = (h * 0x01000193 + (ord(ch) + 1) * 0x9E3779B1) & 0xFFFFFFFF
    h ^= len(gram) * 0x85EBCA6B & 0xFFFFFFFF
    h ^= h >> 16
    h = h * 0x7FEB352D & 0xFFFFFFFF
    h ^= h >> 15
    return h & (toxicity._SIZE - 1)


def grams(text):
    s = " " + re.sub("[\t-\r]", " ", (text or "").lower()) + " "
    return {bucket(s[i : i + n]) for n in toxicity.ORDERS for i in range(len(s) - n + 1)}


def test_toxicity_equals_its_definition(spark):
    rng = random.Random(5)
    words = vocabulary(rng, 60)
    texts = [prose(rng, rng.randint(5, 30), words) + (" Vile ÉVIL" if i % 4 == 0 else "") for i in range(160)] + ["", None, "Évil\tvile"]
    df = docs(spark, texts)
    model = toxicity.learn(df.where("doc_id < 160"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int"))
    counts = [collections.Counter(b for i in range(160) if (i % 4 == 0) == bool(k) for b in grams(texts[i])) for k in (0, 1)]
    n = [120, 40]
    significant = set()
    for b in set(counts[0]) | set(counts[1]):
        p, q = counts[1][b] + 0.5, counts[0][b] + 0.5
        ratio = math.log(p / 41) - math.log(q / 121)
        if abs(ratio) / math.sqrt(1 / p - 1 / 41 + 1 / q - 1 / 121 + 1e-12) >= toxicity.SIGNIFICANCE:
            significant.add(b)
    used = set(np.flatnonzero(model.weight).tolist())
    assert used and used <= significant and len(significant - used) <= len(significant) // 10
    assert sum(n) == 160
    for r in toxicity.score(df, model).collect():
        z = model.intercept + sum(float(model.weight[b]) for b in grams(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6) and r.predicted == (r.score >= 0.7)


# language


def test_mixtures_equal_plain_expectation_maximisation():
    rng = np.random.default_rng(4)
    score = np.log(rng.dirichlet([0.4, 0.4, 0.4], 60)).astype(np.float32)
    offsets = np.array([0, 25, 25, 26, 60])
    got, value = langid.mixtures(score, offsets)
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if a == b:
            assert not got[row].any()
            continue
        like, live, best = np.exp(score[a:b].astype(float)), [0, 1, 2], (-np.inf, None)
        share = np.full(3, 1 / 3)
        while live:
            p = np.where(np.isin(np.arange(3), live), share, 0)
            p /= p.sum()
            for _ in range(3000 if len(live) > 1 else 0):
                joint = like * p
                p = (joint / joint.sum(1, keepdims=True)).mean(0)
            total = np.log((like * p).sum(1)).sum() - langid.PENALTY * len(live) * math.log(b - a + 1)
            if total > best[0]:
                best = (total, p)
            live.remove(min(live, key=lambda j: (p[j], -j)))
            share = np.maximum(p, 1e-6)
        assert got[row] == pytest.approx(best[1], abs=0.02) and value[row] == pytest.approx(best[0], abs=0.05)


def test_word_scores_are_sums_over_all_grams():
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], rng.normal(size=(langid.BUCKETS, 2)).astype(np.float32))
    s = next(K.slices(pa.array(["ab cd ab é ab", "zz"])))
    x, start, end, _ = langid._padded(s)
    got = model.word_scores(x, start, end)
    for i, (a, b) in enumerate(zip(start, end, strict=True)):
        want = sum(model.logp[langid._grams(x[a:b], o)[o - 1 :]].sum(0) for o in langid.ORDERS) / len(langid.ORDERS)
        assert got[i] == pytest.approx(want - want.max(), abs=1e-4)


# quality


def test_lines_of_a_document_may_differ(spark):
    rng = random.Random(6)
    words = vocabulary(rng, 300)
    good = lambda: prose(rng, 30, words).capitalize() + "."
    junk = lambda: " | ".join(w.upper() + "!!" for w in prose(rng, 12, words).split())
    texts = ["\n".join(good() for _ in range(5)) for _ in range(60)]
    texts += ["\n".join([good(), *(junk() for _ in range(6)), good()]) for _ in range(60)]
    df = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120) if i % 3], "doc_id long, quality int")
    field = quality.learn(df, labels)
    out = {r.row.doc_id: r for r in quality.judge(df, field).collect()}
    assert all(out[i].kept == (i < 60) for i in range(120))
    assert sum(0 < out[i].content_share < 1 for i in range(60, 120)) >= 50  # both labels in one document
    assert field.move[0, 0] + field.move[1, 1] > field.move[0, 1] + field.move[1, 0]


# line dedup


def test_a_block_of_near_copies_is_settled_by_its_earliest_line(spark):
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh ") for _ in range(90))
    texts = []
    for i in range(2000):
        at = rng.randrange(3, 80)
        texts.append(line[:at] + rng.choice("xyz") + line[at + 1 :])
    texts += [line[:30] + "".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(40)]
    got = {r.doc_id: r.n_removed for r in linededup.dedup(docs(spark, texts)).collect()}
    assert [i for i, n in got.items() if n == 0 and i < 2000] == [0]
    assert all(got[i] == 0 for i in range(2000, 2040))


# joins at other thresholds


@pytest.mark.parametrize("t", [Fraction(2, 3), Fraction(1, 2)])
def test_low_thresholds_lose_no_link(spark, t):
    rng = random.Random(t.denominator)
    words = vocabulary(rng, 400)
    texts = []
    for size in (4, 6, 9, 14, 30, 70, 160):
        for _ in range(4):
            basis = prose(rng, size, words).split()
            texts.append(" ".join(basis))
            texts.append(" ".join(basis[: max(3, math.ceil(size * t))]))
            texts.append(" ".join(basis[: max(3, math.ceil(size * t) + 1)] + [rng.choice(words)]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.link_components(docs(spark, texts), n=1, threshold=t).collect()}
    assert got == jaccard_components(texts, 1, t)


def test_large_blocks_are_searched_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "PART", 4)
    rng = random.Random(8)
    words = vocabulary(rng, 300)
    basis = prose(rng, 120, words).split()
    texts = []
    for _ in range(40):
        copy = list(basis)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(120)] = rng.choice(words)
        texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.link_components(docs(spark, texts), n=3, threshold=Fraction(4, 5)).collect()}
    assert got == jaccard_components(texts, 3, Fraction(4, 5))


# urls


def test_question_mark_is_one_character():
    a = urlfilter.Automaton(["a?b", "?*"])
    got = a.match([x.encode() for x in ("axb", "aéb", "a😀b", "ab", "axxb", "é", "")])
    assert got.tolist() == [[True, True], [True, True], [True, True], [False, True], [False, True], [False, True], [False, False]]


# whole queries


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", ["quality_base", "class_lm_base", "secret_base"])
def test_base_queries_equal_sql(spark, duck, name):
    df = entries.queries()[name](spark, "/root/testdata/sf0.001")
    want = duck.sql(entries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([r[i] for i in order]) for r in want.fetchall())


WANTED = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op7_class_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_line_dedup": "doc_id bigint, text string, n_lines bigint, n_removed bigint",
    "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
}


@pytest.mark.parametrize("name", sorted(WANTED))
def test_queries_give_what_their_contract_says(spark, name):
    sf = "/root/testdata/sf0.001"
    out = entries.queries()[name](spark, sf)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema) == WANTED[name]
    rows = out.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    modulus = {"op1_toxicity": (3, 1), "op7_class_lm": (10, 0), "op10_language_id": (5, 0)}.get(name)
    if modulus:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus[0] == modulus[1]) for r in rows)
    if "score" in out.columns and name != "op7_class_lm":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "op7_class_lm":
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)  # classes tell more than counts alone
    if name == "op10_language_id":
        truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        held = [r for r in rows if r.held_out and truth[r.doc_id] and r.lang_pred != "und"]
        assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


# awkward tables


LONG = "long words of a text that goes on " * 3000


def awkward(spark):
    rows = [
        (1, "a plain text of some words, long enough for a line.\nanother line of it", "x", 1, None),
        (2, None, None, None, "k"),
        (3, "", "", 0, "k"),
        (4, LONG, "y", 2, "k"),
        (5, "a plain text of some words, long enough for a line.\nanother line of it", "x", 1, None),
        (5, "a plain text of some words, long enough for a line.\nanother line of it", "x", 1, None),
        (None, "no id at all but some words to count", "z", 3, "n"),
        (7, "\n\n \t\n", "x", 1, "k"),
        (8, "é😀\x00 user=bob Ab3Ab3Ab3Ab3Ab3Ab3Ab3Ab3", "x", 1, "k"),
    ]
    names = ["doc_id", "text", "a blank", "__n", "__kept"]
    df = spark.createDataFrame(rows, "doc_id long, text string, c string, d int, e string").toDF(*names)
    more = ["_kept", "row", "k1", "node", "key", "id", "h", "n", "line", "nid", "stay", "component_id", "label", "quality", "toxic", "lang", "n-words", "c0"]
    return df.select("*", *(F.lit(i).alias(m) for i, m in enumerate(more)))


def test_awkward_tables_through_every_operator(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, None), (99, None, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "another line of it"), (None, "plain text"), (3, None), (3, "")], "item_id int, text string")
    for table in (df, df.limit(0)):
        n = table.count()
        assert toxicity.score(table, toxicity.learn(table, labels)).count() == n
        pieces = packing.pack(table).groupBy().agg(F.sum("length").alias("n")).first().n or 0
        assert (pieces > 0) == (n > 0)
        assert urlfilter.filter_urls(table.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "url")).count() == n
        assert decontaminate.report(table, bench).count() == n
        assert ngramjoin.link_components(table).count() == n
        assert quality.judge(table, quality.learn(table, labels)).count() == n
        model, counts = classlm.learn(table)
        assert classlm.score(table, model, counts).count() == n
        assert secrets.scan(table).count() == n
        assert linededup.dedup(table).count() == n
        assert langid.identify(table, langid.learn(table.withColumn("lang", F.lit("aa")))).count() == n


def test_awkward_tables_through_the_stages(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    for table in (awkward(spark), awkward(spark).limit(0)):
        table = table.withColumn("n_chars", F.length("text"))
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, table, sf)
            assert out.columns == table.columns, name
            out.collect()
        assert P.STAGES[-1][1](spark, table, sf).columns[0] == "doc_id"


def test_mixtures_do_not_depend_on_neighbours():
    """Each row alone, all together, and shuffled together: the same doubles."""
    rng = np.random.default_rng(8)
    sizes = rng.integers(0, 120, 60)
    rows = [np.minimum(rng.normal(0, 1.5, size=(n, 4)), 0).astype(np.float32) + np.float32(rng.normal(0, 0.3)) * np.eye(4, dtype=np.float32)[rng.integers(0, 4, n)] for n in sizes]

    def together(order):
        offsets = np.concatenate([[0], np.cumsum([len(rows[i]) for i in order])])
        best, value = langid.mixtures(np.concatenate([rows[i] for i in order]), offsets)
        return {i: (best[j].tolist(), value[j]) for j, i in enumerate(order)}

    alone = {}
    for i in range(len(rows)):
        alone |= together([i])
    assert together(list(range(len(rows)))) == alone
    assert together(rng.permutation(len(rows)).tolist()) == alone
