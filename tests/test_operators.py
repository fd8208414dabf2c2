"""Operators on small literal cases, several against plain-Python models."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sporelight import schemas
from sporelight.functions import sequence as S
from sporelight.operators import alignments, cluster, contigs, hits, pileup, reads, report, search, taxonomy
from sporelight.store import written


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def seqs(spark, rows):
    return spark.createDataFrame([(i, n, n, s) for i, (n, s) in enumerate(rows)], schemas.SEQ)


def hit(**k):
    base = dict(ord=0, analysis="blastn", contig_id="c1", contig_length=100, hit_id="h", reference_id="h", hit_length=1000, genus="g", description="d", alignment_length=100, percent_identity=95.0, evalue=1e-20, bit_score=200.0, query_start=1, query_end=100, hit_start=1, hit_end=100, query_coverage=100.0, query_sequence="", hit_sequence="")
    return {**base, **k}


def hit_frame(spark, rows):
    names = [x.split()[0] for x in schemas.HITS.split(", ")]
    return spark.createDataFrame([tuple(hit(**{**r, "ord": r.get("ord", i)})[n] for n in names) for i, r in enumerate(rows)], schemas.HITS)


@pytest.mark.parametrize("raw,want", [("lcl|ref|AB123.1| x", "AB123.1"), ("sp|P99999| y", "P99999"), ("plain_id", "plain_id"), ("gi|1|gb|G1|emb|E1", "G1"), ("a|b|c|", "c"), ("", "")])
def test_normalize_id(spark, raw, want):
    assert one(spark, S.normalize_id(F.lit(raw))) == want


def test_text_functions(spark):
    assert one(spark, S.reverse_complement(F.lit("ACGTacgtN-"))) == "-NacgtACGT"
    assert one(spark, S.identity_text(F.lit("CGT-AAA"), F.lit("CGTTAAA"))) == "6/7(86%)"
    assert one(spark, S.cigar(F.lit("CGT-AAA"), F.lit("CGTTAAA"))) == "3M1D3M"
    assert one(spark, S.cigar(F.lit(""), F.lit(""))) == "0M"
    assert one(spark, S.midline(F.lit("CGT-AaA"), F.lit("CGTTAAA"))) == "||| |.|"
    assert one(spark, S.wrapped(F.lit("abcdefg"), 3)) == ["abc", "def", "g"]
    assert one(spark, S.wrapped(F.lit(""), 3)) == []
    assert one(spark, S.hamming(F.lit("ACGT"), F.lit("AGGTT"))) == 2
    assert one(spark, S.slug(F.lit("--a b|c.1 "))) == "a-b-c-1" and one(spark, S.slug(F.lit("||"))) == "item"
    assert one(spark, S.html_escape(F.lit("<a&'\">"))) == "&lt;a&amp;&#x27;&quot;&gt;"
    assert [r.x for r in spark.createDataFrame([(1e-20,), (0.5,), (123456789.0,)], "v double").select(S.general_6g("v").alias("x")).collect()] == ["1e-20", "0.5", "1.23457e+08"]
    assert S.read_lengths("21-23:25:27") == {21, 22, 23, 25, 27} and S.odd_sizes("9-15") == [9, 11, 13, 15]
    for bad in ("", "3-1", "x", "0"):
        with pytest.raises(ValueError):
            S.read_lengths(bad)


def test_read_filters(spark):
    rows = spark.createDataFrame([(0, "r1", "AAAA", "+", "####"), (1, "r2", "AAAA", "+", "!!!!"), (2, "r3", "CCCC", "+", "$$$$"), (3, "r4", "CC", "+", "$$")], schemas.READS)
    assert sorted((r.header, r.quality) for r in reads.drop_duplicates(rows).collect()) == [("r1", "####"), ("r3", "$$$$"), ("r4", "$$")]
    assert [r.header for r in reads.filter_lengths(rows, "2").collect()] == ["r4"]
    assert reads.data_type(rows) == "sRNA"
    with pytest.raises(ValueError):
        reads.data_type(rows.limit(0))


def test_alternatives_and_best(spark):
    sam = spark.createDataFrame([(0, "read1", "0", "ref1", 1, "60", "4M", "*", "0", "0", "ACGT", "IIII", 0, "ref2,+5,4M,1;ref3,-7,4M,2;")], schemas.SAM)
    out = alignments.expand_alternatives(sam).orderBy("alt").collect()
    assert [(r.rname, r.pos, r.flag, r.seq, r.nm, r.mapq) for r in out] == [("ref1", 1, "0", "ACGT", 0, "60"), ("ref2", 5, "0", "ACGT", 1, "0"), ("ref3", 7, "16", "ACGT", 2, "0")]
    rows = [("read1", "0", "ref1", 1), ("read1", "0", "ref2", 0), ("read2", "4", "*", None), ("read3", "0", "ref1", 2), ("read1", "0", "ref4", 1)]
    sam = spark.createDataFrame([(i, q, f, r, 1, "0", "4M", "*", "0", "0", "ACGT", "IIII", nm, None) for i, (q, f, r, nm) in enumerate(rows)], schemas.SAM)
    assert sorted(r.rname for r in alignments.best_alignments(sam).collect()) == ["ref2", "ref4"]
    assert [r.rname for r in alignments.best_alignments(sam, consecutive=False).collect()] == ["ref2"]
    assert alignments.mapped_reads(alignments.best_alignments(sam)) == 1
    assert [r.header for r in alignments.unmapped_reads(sam).collect()] == ["read2"]


def test_pileup(spark):
    rows = spark.createDataFrame([(i, "ref1", i + 1, "A", 3, "...", "III") for i in range(4)] + [(4, "ref2", 1, "A", 1, ".", "I")], schemas.PILEUP)
    lengths = spark.createDataFrame([("ref1", 10), ("ref2", 10)], "ref_id string, length int")
    assert {r.ref_id for r in pileup.filter_coverage(rows, lengths).collect()} == {"ref1"}
    got = pileup.contigs(rows.where("ref_id = 'ref1' AND pos <= 3"), lengths, min_length=2).collect()
    assert [(r.header, r.sequence) for r in got] == [("ALIGNED1 ref1 3", "AAA")]
    gap = spark.createDataFrame([(i, "ref1", p, "C", 2, "..", "II") for i, p in enumerate([1, 2, 3, 5, 6, 7, 8])], schemas.PILEUP)
    assert [(r.header, r.sequence) for r in pileup.contigs(gap, lengths, 2).orderBy("ord").collect()] == [("ALIGNED1 ref1 3", "CCC"), ("ALIGNED2 ref1 8", "CCCC")]


def _consensus(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ref string, depth int, marks string")
    df, counts = pileup.mark_counts(df, "marks")
    base = pileup.consensus_base(F.col("ref"), F.col("depth"), counts)
    return [r.base for r in df.select("i", base.alias("base")).orderBy("i").collect()]


@pytest.mark.parametrize("ref,depth,marks,want", [("A", 3, "...", "A"), ("A", 3, "CC.", "C"), ("A", 2, "C.", "A"), ("A", 2, "**", ""), ("A", 2, ".+2GG.+2GG", "AGG"), ("a", 0, "", "A"), ("N", 2, "..", "N"), ("G", 3, "^I.$TT", "T"), ("A", 4, "....-2CC", "A")])
def test_consensus(spark, ref, depth, marks, want):
    assert _consensus(spark, [(ref, depth, marks)]) == [want]


def _vote(ref, depth, seen, inserted):
    """The consensus rule on plain counts."""
    total = depth + 0.00001
    top = max(seen[b] for b in "ACGT")
    winner = next(b for b in "ACGT" if seen[b] == top)
    share = lambda k, d: k / d if d > 0 else 0
    base, best = (winner if top > 0 else ref), share(top, total - seen["N"])
    gone = share(seen["*"], total - seen["^"] - seen["$"])
    if gone > best:
        base, best = "", gone
    if share(len(inserted), total - seen["$"]) >= best:
        usual = max(inserted, key=lambda x: (inserted.count(x), -inserted.index(x))) if inserted else ""
        base = ref + usual
    return base


def test_marks_against_a_scan(spark):
    rng = random.Random(11)
    rows, want = [], []
    for _ in range(600):
        ref, depth, marks, seen, inserted = rng.choice("ACGTN"), rng.randint(0, 8), "", Counter(), []
        for _ in range(depth):
            kind = rng.random()
            token = "*" if kind < 0.25 else rng.choice(".,") if kind < 0.5 else rng.choice([b for b in "ACGTNacgtn" if b.upper() != ref])
            seen[ref if token in ".," else token.upper()] += token not in ".," or ref != "N"
            if rng.random() < 0.2:
                marks += "^" + rng.choice("I+-^$*.A")
                seen["^"] += 1
            marks += token
            if rng.random() < 0.35:
                size = rng.choice([1, 1, 2, 9, 10, 12])
                text = rng.choice("ACG") * size
                sign = rng.choice("++-")
                marks += f"{sign}{size}{text}"
                if sign == "+":
                    inserted.append(text)
                if size > 9:  # the last base of a long indel is read again
                    seen[text[-1]] += text[-1] != ref
            if rng.random() < 0.2:
                marks += "$"
                seen["$"] += 1
        rows.append((ref, depth, marks))
        want.append(_vote(ref, depth, seen, inserted))
    assert _consensus(spark, rows) == want


def _aligned(name, pos, cigar, seq, ref):
    """Plain counts of one alignment: {pos: [marks]} and insertions."""
    marks, inserted, r, q = [], [], pos, 0
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", cigar)):
        if op == "M":
            marks += [(r + i, seq[q + i]) for i in range(n)]
        if op == "D":
            marks += [(r + i, "*") for i in range(n)]
        if op == "I" and r > pos:
            inserted.append((r - 1, seq[q : q + n]))
        r, q = r + n * (op in "MD"), q + n * (op in "MIS")
    return marks, inserted, pos, r - 1


def test_structured_pileup_votes_on_insertions_and_deletions(spark):
    rng = random.Random(12)
    refs = {"a": "".join(rng.choice("ACGTN") for _ in range(150)), "b": "".join(rng.choice("ACGT") for _ in range(60))}
    rows = []
    for i in range(220):
        name = rng.choice("ab")
        pos = rng.randint(1, len(refs[name]) - 12)
        cigar = rng.choice(["10M", "3S7M", "4M2I6M", "4M1I6M", "5M2D5M", "5M2D5M", "2I9M", "8M2I", "1M1I1M1D8M"])
        pos = pos // 12 * 12 + 1 if rng.random() < 0.7 else pos
        read = sum(int(n) for n in re.findall(r"(\d+)[MIS]", cigar))
        rows.append((f"q{i:03}", "0", name, pos, cigar, "".join(rng.choice("ACGTN" if rng.random() < 0.3 else "GT") for _ in range(read))))
    want = {}
    seen, inserted, depth = defaultdict(Counter), defaultdict(list), Counter()
    for q, _, name, pos, cigar, seq in sorted(rows, key=lambda x: (x[3], x[0])):
        marks, more, first, last = _aligned(q, pos, cigar, seq, refs[name])
        for at, m in marks:
            depth[name, at] += 1
            seen[name, at][m] += not (m == "N" and refs[name][at - 1 : at] == "N")
        for at, x in more:
            inserted[name, at].append(x)
        seen[name, first]["^"] += 1
        seen[name, last]["$"] += 1
    for (name, at), n in depth.items():
        if at <= len(refs[name]):
            ref = refs[name][at - 1]
            want[name, at] = (n, ref, _vote(ref, n, seen[name, at], inserted[name, at]))
    df = spark.createDataFrame(rows, "qname string, flag string, rname string, pos int, cigar string, seq string").repartition(3)
    out = pileup.structured(df, spark.createDataFrame(list(refs.items()), "seq_id string, sequence string"), tile=16)
    got = {(r.ref_id, r.pos): (r.depth, r.ref_base, r.base) for r in out.collect()}
    assert got == want
    assert any(b == "" for _, _, b in got.values()) and any(len(b) > 1 for _, _, b in got.values())
    # contigs: the same by blocks of eight positions and in one stretch each
    for block in (8, 1 << 16):
        found = pileup.contigs_of(out, min_length=5, block=block).orderBy("ord").collect()
        texts, at = [], None
        for name, pos in sorted(got):
            if at != (name, pos - 1):
                texts.append([name, 0, ""])
            at = (name, pos)
            texts[-1] = [name, texts[-1][1] + 1, texts[-1][2] + got[name, pos][2]]
        assert [r.sequence for r in found] == [t for _, n, t in texts if n > 5]


def test_an_insertion_in_every_read_is_in_the_contig(spark):
    rng = random.Random(13)
    ref = "".join(rng.choice("ACGT") for _ in range(60))
    reads_ = spark.createDataFrame([(f"q{i}", "0", "r", 1, "30M2I30M", ref[:30] + "GG" + ref[30:]) for i in range(5)], "qname string, flag string, rname string, pos int, cigar string, seq string")
    out = pileup.contigs_of(pileup.structured(reads_, spark.createDataFrame([("r", ref)], "seq_id string, sequence string")))
    assert [r.sequence for r in out.collect()] == [ref[:30] + "GG" + ref[30:]]
    assert pileup.contigs_of(pileup.structured(reads_.limit(0), spark.createDataFrame([("r", ref)], "seq_id string, sequence string"))).count() == 0


def test_cigar_columns(spark):
    rows = spark.createDataFrame([("r", 5, "2S2M1I2M1D1M", "TTACGTAC")], "rname string, pos int, cigar string, seq string")
    assert [(r.pos, r.base) for r in pileup.columns_of(rows).orderBy("pos").collect()] == [(5, "A"), (6, "C"), (7, "T"), (8, "A"), (9, "*"), (10, "C")]


def test_containment(spark):
    rows = seqs(spark, [("ALIGNED1", "ATGCAATGCA"), ("NODE_1", "ATGCAATGCA"), ("NODE_2", "GCAATG"), ("NODE_3", "TGCATTGCAT"), ("NODE_4", "CCCCGGGG"), ("E", "")])
    assert [r.seq_id for r in contigs.drop_contained(rows, 4).collect()] == ["ALIGNED1", "NODE_4"]
    assert contigs.combine(seqs(spark, [("A", "AAAA")]), None, seqs(spark, [("B", "C"), ("D", "G")])).orderBy("ord").select("seq_id").collect() == [Row("A"), Row("B"), Row("D")]


def test_containment_equals_greedy(spark):
    rng = random.Random(3)
    rows = [(f"s{i}", "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 7)))) for i in range(60)]
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    kept = []
    for i in sorted(range(len(rows)), key=lambda i: -len(rows[i][1])):
        s = rows[i][1]
        if not any(s in rows[j][1] or turn(s) in rows[j][1] for j in kept):
            kept.append(i)
    assert [r.seq_id for r in contigs.drop_contained(seqs(spark, rows), 3).collect()] == [rows[i][0] for i in sorted(kept)]


def test_statistics(spark):
    r = contigs.statistics(seqs(spark, [("a", "A"), ("b", "C"), ("c", "GN"), ("d", "ACGT")])).first()
    assert (r.numSeqs, r.numBases, r.numOK, r.numNs, r.minLen, r.avgLen, r.maxLen, r.n50_asc) == (4, 8, 7, 1, 1, 2, 4, 2)
    assert contigs.grid_search([9, 11, 13], lambda k, c: {(9, 5): 100, (11, 5): 100, (13, 5): 90, (9, 7): 99}.get((k, c))) == (9, 5)


def test_assembly_joins_overlapping_reads(spark):
    genome = "ACGTTGCATGGCCTAAGTCTGACCATTAGGCAATCCGGATATCGTACCAGGT"
    rows = spark.createDataFrame([(i, f"r{i}", genome[i : i + 20], None, None) for i in range(len(genome) - 19)], schemas.READS)
    got = contigs.assemble(contigs.kmer_counts(rows, 11), 11, 1, 30).collect()
    back = genome.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert [r.sequence for r in got] in ([genome], [back])


def test_best_and_summary(spark):
    h = hit_frame(spark, [dict(hit_id="h1", reference_id="h1"), dict(hit_id="h2", reference_id="h2", evalue=1e-30, bit_score=180.0), dict(contig_id="c2", hit_id="h3", query_coverage=40.0)])
    assert [(r.contig_id, r.hit_id) for r in hits.best_final(h, 60, 50).collect()] == [("c1", "h2")]
    h = hit_frame(spark, [dict(contig_id="c1", hit_id="ref1", reference_id="ref1", hit_end=50), dict(contig_id="c2", hit_id="ref1", reference_id="ref1", hit_start=40, hit_end=90), dict(contig_id="c3", analysis="blastx", hit_id="p1", reference_id="ref2")])
    depth = spark.createDataFrame([("c1", 400), ("c2", 480), ("c3", 100)], "contig_id string, total_depth long")
    rows = {r.group_id: r for r in hits.summarize(h, depth, 1_000_000).collect()}
    assert set(rows) == {"ref1", "p1"} and rows["p1"].reference_id == "ref2"
    a = rows["ref1"]
    assert (a.contig_count, a.covered_bases, a.total_contig_length, a.reference_depth, a.passes_coverage_depth) == (2, 90, 200, 4.4, False)
    assert {r.group_id: r.covered_bases for r in hits.summarize(h, depth, 1_000_000, mode="union").collect()} == {"ref1": 90, "p1": 100}


def test_covered_modes(spark):
    rng = random.Random(1)
    for _ in range(10):
        spans = [(s, s + rng.randint(0, 9)) for s in (rng.randint(1, 40) for _ in range(rng.randint(1, 8)))]
        col = F.array(*(F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s, e in spans))
        assert one(spark, hits.covered(col)) == len({x for s, e in spans for x in range(s, e + 1)})
        assert one(spark, hits.covered(col, "reference")) <= one(spark, hits.covered(col))


def test_prune(spark):
    depth = spark.createDataFrame([(f"c{i}", 1000) for i in range(1, 6)], "contig_id string, total_depth long")
    places = {"c1": 1, "c2": 201, "c3": 401, "c4": 601, "c5": 901}
    rows = [dict(contig_id=c, hit_id="refA", reference_id="refA", hit_start=places[c], hit_end=places[c] + 99) for c in ("c1", "c2", "c3", "c4")]
    rows += [dict(contig_id=c, hit_id="refB", reference_id="refB", hit_start=places[c], hit_end=places[c] + (39 if c == "c5" else 99)) for c in ("c1", "c2", "c3", "c5")]
    h = hit_frame(spark, rows)
    summary = written(hits.summarize(h, depth, 1_000_000), "summary")
    kept = hits.kernel(summary, written(hits.redundancy_edges(summary, hits.support(h)), "edges"))
    assert [r.group_id for r in kept.collect()] == ["refA"]
    flags = {r.group_id: (r.passes_coverage_depth, r.passes_redundancy, r.passes_filters) for r in hits.flag(summary, kept).collect()}
    assert flags == {"refA": (True, True, True), "refB": (True, False, False)}


def test_kernel_is_greedy(spark):
    rng = random.Random(9)
    n = 12
    edges = [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.25]
    kept = []
    for b in range(n):
        if not any((a, b) in edges for a in kept):
            kept.append(b)
    nodes = spark.createDataFrame([("x", f"{i:02}") for i in range(n)], "analysis string, group_id string")
    e = spark.createDataFrame([("x", f"{a:02}", f"{b:02}") for a, b in edges], "analysis string, a string, b string")
    assert sorted(r.group_id for r in hits.kernel(nodes, e).collect()) == [f"{i:02}" for i in kept]


def test_trimming(spark):
    adapter = "TCGTATGCCGTCTTCTGCTTG"
    rows = [("clean", "ACGTACGTACGTACGTACGT" + adapter), ("null", adapter + "AC"), ("none", "ACGTACGTACGTACGTACGTACGTACGTACG"), ("baseN", "ACGTACGTACGTNCGTACGT" + adapter), ("short", "ACGT" + adapter), ("near", "ACGTACGTACGTACGTACGT" + "TCGAATGCCGTCTTC")]
    df = spark.createDataFrame([(n, s, "s") for n, s in rows], "header string, sequence string, sample string")
    out = {r.header: (r.pos3, r.outcome) for r in reads.trim(df, adapter3=adapter).collect()}
    assert out == {"clean": (20, "clean"), "null": (0, "rejected"), "none": (31, "rejected"), "baseN": (20, "baseN"), "short": (4, "short"), "near": (20, "clean")}
    report = reads.trim_report(reads.trim(df, adapter3=adapter)).first()
    assert (report.total, report.unmatch3, report.null3, report.match3, report.base_n, report.short, report.cleaned) == (6, 1, 1, 4, 1, 1, 2)
    five = reads.trim(df.limit(1).withColumn("sequence", F.lit("CCGATCAACGTACGTACGTACGTA")), adapter5="GGGGCCGATC").first()
    assert (five.pos5, five.status5, five.trimmed) == (6, "match", "AACGTACGTACGTACGTA")


def test_aligner_finds_every_read_with_one_edit(spark):
    rng = random.Random(4)
    genome = "".join(rng.choice("ACGT") for _ in range(300))
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = []
    for i in range(40):
        at = rng.randrange(270)
        s = list(genome[at : at + 25])
        kind, p = i % 4, rng.randrange(2, 23)
        if kind == 1:
            s[p] = "ACGT"[("ACGT".index(s[p]) + 1) % 4]
        elif kind == 2:
            del s[p]
        elif kind == 3:
            s.insert(p, rng.choice("ACGT"))
        text = "".join(s)
        rows.append((i, f"r{i}", turn(text) if i % 2 else text, None, None))
    rows.append((99, "foreign", "".join(rng.choice("ACGT") for _ in range(25)), None, None))
    out = alignments.align(spark.createDataFrame(rows, schemas.READS), seqs(spark, [("g", genome)]))
    assert {r.qname for r in out.collect()} == {f"r{i}" for i in range(40)}


def test_search_finds_both_strands_and_proteins(spark):
    rng = random.Random(2)
    ref = "".join(rng.choice("ACGT") for _ in range(200))
    back = ref.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    found = search.search(seqs(spark, [("q", back[40:120])]), seqs(spark, [("ref", ref)])).orderBy(F.desc("bitscore")).first()
    assert (found.pident, found.qstart, found.qend, found.sstart, found.send) == (100.0, 1, 80, 160, 81)
    protein = search.translate(ref[:180])
    best = search.search(seqs(spark, [("q", ref[:180])]), seqs(spark, [("p", protein.replace("*", "A"))]), True, 1.0).orderBy(F.desc("bitscore")).first()
    assert best is not None and best.qstart % 3 == 1 and best.pident > 80


def test_clusters(spark):
    rng = random.Random(6)
    a, b = ("".join(rng.choice("ACGT") for _ in range(120)) for _ in range(2))
    rows = seqs(spark, [("a", a), ("a2", a[:100]), ("b", b), ("a3", a.translate(str.maketrans("ACGT", "TGCA"))[::-1][10:])])
    assert sorted(r.seq_id for r in cluster.representatives(rows).collect()) == ["a", "b"]


def test_taxonomy(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank", 8), (2, 1, "genus", 9), (3, 2, "species", 9), (4, 3, "no rank", 9), (5, 1, "species", 4), (6, 1, "species", 5)], schemas.TAX_NODE)
    names = spark.createDataFrame([(0, 2, "somevirus", "scientific name"), (1, 5, "solanum lycopersicum", "scientific name"), (2, 5, "tomato", "common name"), (3, 6, "mus", "scientific name")], schemas.TAX_NAME)
    assert {r.tax_id: r.genus_id for r in taxonomy.genus_of(nodes, nodes).collect()} == {1: None, 2: None, 3: 2, 4: 2, 5: None, 6: None}
    records = spark.createDataFrame([("r1", "d1", [(4, "Tomato; cv. X")]), ("r2", "d2", [(3, None)]), ("r3", "d3", [(1, "x")]), ("r4", "d4", [(4, "Mus musculus")])], "id string, description string, sources array<struct<tax_id:long,host:string>>")
    table = spark.createDataFrame([("somevirus", ["G4"])], "genus string, codes array<string>")
    out = {r.id: (r.genus, r.divisions, r.source) for r in taxonomy.classify(records, nodes, names, table).collect()}
    assert out == {"r1": ("somevirus", ["Plants"], ["ICTV"]), "r2": ("somevirus", ["Plants"], ["ICTV"]), "r3": ("NA", ["Unassigned"], ["NA"]), "r4": ("somevirus", ["Plants", "Vertebrates"], ["ICTV", "genbank"])}
    h = spark.createDataFrame([(0, "q1", "s", 90.0, 50, 0.0, 100.0), (1, "q2", "s", 95.0, 40, 0.0, 200.0), (2, "q3", "s", 91.0, 51, 0.0, 101.0)], "ord long, query string, subject string, identity double, length int, evalue double, score double")
    assert [r.query for r in taxonomy.best_by_subject(h).collect()] == ["q3"]


def test_alignment_order_sorts_once_and_keeps_no_anchor(spark):
    rng = random.Random(3)
    rows = [dict(reference_id=rng.choice(["a|1", "b", "--", None]), contig_id=rng.choice(["c1", "c2", "c10"]), hit_start=rng.randint(1, 4), hit_end=rng.randint(1, 4)) for _ in range(60)] + [dict(reference_id="alone", contig_id="c1", hit_start=1, hit_end=1)]
    want = {}
    for group in {r["reference_id"] for r in rows}:
        name = "alignment" if group is None else "alignment-" + {"a|1": "a-1", "--": "item"}.get(group, group)
        own = sorted((min(r["hit_start"], r["hit_end"]), max(r["hit_start"], r["hit_end"]), r["contig_id"], i) for i, r in enumerate(rows) if r["reference_id"] == group)
        for n, (*_, i) in enumerate(own, 1):
            want[i] = (n, f"{name}-{n}", f"{name}-{n - 1}" if n > 1 else None, f"{name}-{n + 1}" if n < len(own) else None)
    frame = hit_frame(spark, rows)
    found = report.alignment_order(frame)
    assert {r.ord: (r.number, r.anchor, r.previous, r.next) for r in found.collect()} == want
    assert found.columns == [*frame.columns, "group_id", "number", "anchor", "previous", "next"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "anchor" not in windows[0]
