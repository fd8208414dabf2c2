"""The cascade with a redundant reference, and whole runs by the command line."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sporelight import cli, schemas
from sporelight.operators import contigs, hits, search
from sporelight.plans import database, identify, pipeline
from sporelight.sources import readers, writers

from .test_sources import _hits


def genome(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_a_reference_that_another_one_explains_goes(spark):
    names = ["c1", "c2", "c3"]
    records = spark.createDataFrame([(i, c, c, "A" * 100) for i, c in enumerate(names)], schemas.SEQ)
    depth = spark.createDataFrame([(c, 100, 100, 1000, 10.0, 100.0) for c in names], schemas.CONTIG_DEPTH)
    place = lambda i: dict(hit_start=1 + 300 * i, hit_end=300 * (i + 1))
    a = [dict(contig_id=c, hit_id="A", reference_id="A", bit_score=300.0, **place(i)) for i, c in enumerate(names)]
    b = [dict(contig_id=c, hit_id="B", reference_id="B", bit_score=100.0, **place(i)) for i, c in enumerate(names[:2])]
    rows = _hits(spark, a + b)
    out = identify.identify(records, rows, rows.limit(0), depth, 1_000_000)
    assert [r.group_id for r in out.kept.collect()] == ["A"]
    flags = {r.group_id: (r.passes_coverage_depth, r.passes_redundancy) for r in out.summary.collect()}
    assert flags == {"A": (True, True), "B": (True, False)}
    assert {r.hit_id for r in out.final_hits.collect()} == {"A"} and out.counts()["known_contig_count"] == 3


def _prune(rows, support, ratio, cover, length):
    """Groups kept, one after another, intervals merged in order of the contigs."""
    kept = []
    for g, _ in sorted(rows.items(), key=lambda x: (-x[1][0], -x[1][1], x[0])):
        redundant = False
        for k in kept:
            own = [c for c in sorted(support[g]) if c not in support[k]]
            total, now = 0, None
            for c in own:
                s, e = support[g][c]
                if now is None or s > now[1] + 1:
                    total += now[1] - now[0] + 1 if now else 0
                    now = [s, e]
                else:
                    now[1] = max(now[1], e)
            total += now[1] - now[0] + 1 if now else 0
            if len(own) / len(support[g]) <= ratio and total / 1000 <= cover and total <= length:
                redundant = True
                break
        if not redundant:
            kept.append(g)
    return set(kept)


@pytest.mark.parametrize("ratio", [0.25, 0.6, 1.0, 2.0])
def test_pruning_equals_a_plain_loop(spark, ratio):
    rng = random.Random(int(ratio * 100))
    support = {}
    for g in range(30):
        chosen = rng.sample(range(25), rng.randint(1, 9))
        support[f"g{g:02}"] = {f"c{c:02}": (s := rng.randint(1, 400), s + rng.randint(5, 60)) for c in chosen}
    rows = {g: (len(x), sum(e - s + 1 for s, e in x.values())) for g, x in support.items()}
    summary = spark.createDataFrame([("blastn", g, n, c, True) for g, (n, c) in rows.items()], "analysis string, group_id string, contig_count long, covered_bases long, passes_coverage_depth boolean")
    supports = spark.createDataFrame([("blastn", g, 1000, c, s, e) for g, x in support.items() for c, (s, e) in x.items()], "analysis string, group_id string, hit_length int, contig_id string, s int, e int")
    edges = hits.redundancy_edges(summary, supports, ratio, 0.5, 100, "reference")
    got = {r.group_id for r in hits.kernel(summary, edges).collect()}
    assert got == _prune(rows, support, ratio, 0.5, 100) and len(got) < 30


def test_statistics_skip_empty_records(spark):
    rows = spark.createDataFrame([(0, "ACGTRYN"), (1, "")], "ord long, sequence string")
    r = contigs.statistics(rows).first()
    assert (r.numSeqs, r.numBases, r.numOK, r.numNs, r.minLen, r.avgLen, r.maxLen, r.n50_asc) == (1, 7, 6, 1, 7, 7, 7, 7)
    assert contigs.statistics(rows.limit(0)).first().numSeqs == 0


def test_search_files_of_thirteen_columns_or_none(spark, tmp_path):
    row = ["c1", "100", "r1", "900", "50", "98.0", "1e-9", "77.5", "1", "50", "3", "52", "50"]
    path = tmp_path / "hits.tsv"
    path.write_text("\t".join(row) + "\n" + "\t".join([*row, "ACGT", "ACGA"]) + "\n\n")
    got = readers.read_search(spark, str(path), "blastn").orderBy("ord").collect()
    assert [(r.qseqid, r.qcovs, r.qseq, r.sseq) for r in got] == [("c1", 50.0, None, None), ("c1", 50.0, "ACGT", "ACGA")]
    assert readers.read_search(spark, str(tmp_path / "none.tsv"), "blastn").count() == 0


def test_circles_give_one_contig(spark):
    rng = random.Random(4)
    circle = genome(rng, 120)
    reads = spark.createDataFrame([(i, (circle + circle)[i : i + 40]) for i in range(120)] * 2, "ord long, sequence string")
    got = [r.sequence for r in contigs.assemble(contigs.kmer_counts(reads, 15), 15, 2, 30).collect()]
    assert len(got) == 1 and len(got[0]) == 120 + 14
    turned = got[0][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got[0][:120] in circle + circle or turned[:120] in circle + circle


def _best_local(q, s, cell, first, more):
    """Score of the best local alignment with affine gaps, by the whole three-state table."""
    low, best = -(10**6), 0
    above, down = [0] * (len(s) + 1), [low] * (len(s) + 1)
    for a in q:
        row, right = [0] * (len(s) + 1), low
        for j, b in enumerate(s, 1):
            down[j] = max(above[j] - first - more, down[j] - more)
            right = max(row[j - 1] - first - more, right - more)
            row[j] = max(0, above[j - 1] + cell(a, b), down[j], right)
        above, best = row, max(best, *row)
    return best


def _cost(q, s, cell, first, more):
    total, state = 0, ""
    for a, b in zip(q, s, strict=True):
        now = "q" if a == "-" else "s" if b == "-" else ""
        total += -more - first * (now != state) if now else cell(a, b)
        state = now
    return total


@pytest.mark.parametrize("protein", [False, True])
def test_batched_alignment_equals_single_ones_and_the_whole_table(protein):
    rng = random.Random(2)
    letters = "ARNDCQEGHILKMFPSTWYVX*" if protein else "ACGT"
    pairs = []
    for _ in range(60):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(20, 90)))
        at = rng.randint(0, 10)
        q = list(s[at : at + rng.randint(8, 60)])
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(q))
            q[i] = rng.choice(["", letters[0], letters[1], letters[2] * 2, letters[3] * 9])
        pairs.append(("".join(q) or "A", s, at))
    table = search.protein_scores()
    cell = lambda m, n: int(table[ord(m), ord(n)]) if protein else search.NUCLEOTIDE_MATCH if m == n else search.NUCLEOTIDE_MISMATCH
    gap = search.PROTEIN_GAP if protein else search.NUCLEOTIDE_GAP
    for band in (6, 200):
        got = search.local_alignments([p[0] for p in pairs], [p[1] for p in pairs], protein, band, [p[2] for p in pairs])
        for (q, s, at), x in zip(pairs, got, strict=True):
            assert x == search.local_alignment(q, s, protein, band, at)
            whole = _best_local(q, s, cell, *gap)
            if x is None:
                assert band < 200 or whole == 0
                continue
            score, a, b, c, d, qt, st = x
            assert qt.replace("-", "") == q[a:b] and st.replace("-", "") == s[c:d]
            assert _cost(qt, st, cell, *gap) == score <= whole
            assert band < 200 or score == whole


def test_a_band_grows_with_the_gaps():
    rng = random.Random(3)
    left, right = ("".join(rng.choice("ARNDCQEGHILKMFPSTWYV") for _ in range(80)) for _ in range(2))
    gap = "G" * 60
    score, a, b, c, d, q, s = search.local_alignment(left + right, left + gap + right, True, 4, 0)
    assert (a, b, c, d) == (0, 160, 0, 220) and q.count("-") == 60
    table = search.protein_scores()
    assert score == sum(int(table[ord(x), ord(x)]) for x in left + right) - 11 - 60


def test_matrix_and_neighbouring_words(spark):
    table = search.protein_scores()
    assert (table == table.T).all() and [int(table[ord(a), ord(b)]) for a, b in ("WW", "CC", "AR", "WG", "IV", "XA", "A*", "BZ")] == [11, 9, -1, -2, 3, -1, -4, -1]
    near = {}
    for r in search.neighbour_words(spark, 13).collect():
        near.setdefault(r.kmer, set()).add(r.near)
    letters = "ARNDCQEGHILKMFPSTWYV"
    for word in ("WWW", "AAA", "PQG", "CHM"):
        want = {x + y + z for x in letters for y in letters for z in letters if sum(int(table[ord(m), ord(n)]) for m, n in zip(word, x + y + z, strict=True)) >= 13}
        assert near.get(word, set()) == want


@pytest.mark.parametrize("protein", [False, True])
def test_statistics_follow_the_closed_formula(spark, protein):
    lam, k, alpha, beta = search.PROTEIN_STATS if protein else search.NUCLEOTIDE_STATS
    rows = [(m, float(s)) for m in (1, 9, 33, 100, 4000) for s in (20, 50.5, 300)]
    for letters, count in ((1, 1), (50_000, 40), (10**9, 10**6)):
        out = search.with_statistics(spark.createDataFrame(rows, "m long, score double"), F.lit(letters), F.lit(count), protein).collect()
        for r in out:
            fits = [x for x in range(min(r.m - 1, (letters - 1) // count) + 1) if x == 0 or x <= beta + alpha / lam * math.log(k * (r.m - x) * (letters - count * x))]
            space = (r.m - max(fits)) * (letters - count * max(fits))
            assert r.evalue == pytest.approx(k * space * math.exp(-lam * r.score), rel=1e-6)
            assert r.evalue == pytest.approx(space * 2.0**-r.bitscore, rel=1e-6)


def test_two_hits_on_a_diagonal_seed_a_distant_protein(spark):
    rng = random.Random(5)
    codons = {}
    for a in "TCAG":
        for b in "TCAG":
            for c in "TCAG":
                codons.setdefault(search.translate(a + b + c), a + b + c)
    protein = "".join(rng.choice("ARNDCQEGHILKMFPSTWYV") for _ in range(90))
    alike = str.maketrans("ILKDEFYRQS", "VMREDYFKET")
    gene = "".join(codons[x] for x in protein.translate(alike))
    rows = spark.createDataFrame([(0, "q", "q", "AC" + gene)], "ord long, header string, seq_id string, sequence string")
    subjects = spark.createDataFrame([(0, "p", "p", protein), (1, "z", "z", "".join(rng.sample(protein, 90)))], "ord long, header string, seq_id string, sequence string")
    out = search.search(rows, subjects, True, 1e-5).collect()
    assert [(r.sseqid, r.qstart, r.qend, r.sstart, r.send) for r in out] == [("p", 3, 272, 1, 90)]
    table = search.protein_scores()
    assert out[0].bitscore == pytest.approx((0.267 * sum(int(table[ord(x), ord(y)]) for x, y in zip(protein, protein.translate(alike), strict=True)) - math.log(0.041)) / math.log(2))
    assert search.search(rows.withColumn("sequence", F.lit("ACGTA")), subjects, True).count() == 0


@pytest.fixture(scope="module")
def sample(tmp_path_factory):
    rng = random.Random(7)
    folder = tmp_path_factory.mktemp("run")
    virus, other = genome(rng, 400), genome(rng, 400)
    db = folder / "database"
    db.mkdir()
    (db / "vrl_plant").write_text(f">V1 a virus\n{virus}\n>V2\n{other}\n")
    (db / "vrl_genbank.info").write_text("V1\t400\tTobamovirus\ta virus\nV2\t400\tG\tanother\n")
    import gzip

    for name, text in (("vrl_genbank.info.gz", "V1\t400\tTobamovirus\ta virus\nV2\t400\tG\tanother\n"), ("vrl_idmapping.gz", "V1\tP1\n")):
        with gzip.open(db / name, "wt") as f:
            f.write(text)
    (db / "vrl_plant_prot").write_text(">P1\n" + search.translate(virus) + "\n")
    unknown = genome(rng, 200)
    reads = [virus[i : i + 24] for i in range(0, 376)] + [unknown[i : i + 22] for i in range(0, 178)] * 4
    path = folder / "plant.fq"
    path.write_text("".join(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(reads)))
    return folder, path, len(reads)


def test_a_run_by_command_line(spark, sample, capsys):
    folder, path, n = sample
    args = cli.parser().parse_args(["run", str(path), "--db-path", str(folder / "database"), "-o", str(folder), "--kmer-range", "15-15", "--debug", "--keep-temp", "--depth-cutoff", "0.5"])
    assert cli.run(args, spark) == 0
    out = folder / "result_plant"
    names = {p.name for p in out.iterdir() if not p.name.startswith(".")}
    assert names >= {"contig_sequences.fa", "contig_sequences.blastn.fa", "contig_sequences.undetermined.fa", "blastn.references.fa", "blastn.html", "undetermined.html", "undetermined_blast.html", "blastn.sam", "blastn.xls", "no_virus_detected_by_blastx", "blastn.raw.tsv", "summary.tsv", "contig_depth.tsv", "analysis_plan.json", "blastn.V1.html"}
    assert "no_virus_detected_by_blastn" not in names
    page = (out / "blastn.html").read_text()
    assert "V1" in page and "Tobamovirus" in page and "V2" not in page and "class='strip'" in page
    text = lambda name: "".join(p.read_text() for p in sorted((out / name).glob("part-*")))
    assert text("blastn.references.fa").startswith(">V1 a virus\n")
    assert "@SQ\tSN:V1" in text("blastn.sam") and text("blastn.xls").count("\n") >= 2
    rest = (out / "undetermined.html").read_text()
    assert "class='candidate'" in rest and text("contig_sequences.undetermined.fa").count(">") >= 1
    assert '"library_size"' not in (out / "analysis_plan.json").read_text() and f'"reads": {n}' in (out / "analysis_plan.json").read_text()
    assert "known_contig_count 1" in capsys.readouterr().out


def test_stages_options_and_errors(spark, sample):
    folder, path, n = sample
    virus = readers.read_fasta(spark, str(folder / "database" / "vrl_plant"))
    notes = readers.read_annotation(spark, str(folder / "database" / "vrl_genbank.info"))
    out = pipeline.run(spark, str(path), virus, notes, config=pipeline.Config(read_lengths="24", stop_after="prepare_sample"))
    assert out["library_size"] == 376 and out["prepare_sample"].count() == 376 and set(out) == {"data_type", "library_size", "prepare_sample"}
    with pytest.raises(ValueError, match="no reads"):
        pipeline.run(spark, str(path), virus, notes, config=pipeline.Config(read_lengths="99"))
    for wrong in (dict(stop_after="x"), dict(assembler="x")):
        with pytest.raises(ValueError):
            pipeline.Config(**wrong)
    assert cli.main(["run", str(path), "--db-path", str(folder / "database"), "--check-only"]) == 0
    assert cli.sample_name("/x/leaf.fastq.gz") == "leaf" and cli.sample_name("a.fa") == "a"
    assert hits.references_of(virus, spark.createDataFrame([("V2",)], "group_id string")).first().seq_id == "V2"


def test_database_commands(sample, tmp_path, capsys, monkeypatch):
    folder, _, _ = sample
    db = str(folder / "database")
    assert cli.main(["db", "verify", "--path", db]) == 0
    assert cli.main(["db", "verify", "--path", str(tmp_path)]) == 1
    archive = str(tmp_path / "d.tar.gz")
    assert cli.main(["--", "db", "bundle", "--path", db, "--output", archive]) == 0
    assert cli.main(["db", "download", "--url", f"file://{archive}", "--path", str(tmp_path / "in"), "--sha256-url", f"file://{archive}.sha256"]) == 0
    with pytest.raises(ValueError):
        database.download(f"file://{archive}", tmp_path / "in2", sha256="00")
    monkeypatch.setenv(database.VARIABLE, db)
    assert cli.main(["db", "path"]) == 0 and db in capsys.readouterr().out
    monkeypatch.setenv("CONDA_PREFIX", str(tmp_path))
    assert str(tmp_path) in str(database.install_target())
    assert cli.main(["tools", "check", "--json", "--strict"]) == 0 and cli.main(["tools", "install-hint"]) == 0
    assert cli.main(["db", "path", "--target"]) == 0


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "ACGT", "+", "IIII"), (2, "b", "GG", None, None)], schemas.READS)
    read = lambda p: "".join(x.read_text() for x in sorted(p.glob("part-*")))
    writers.write_reads(rows, str(tmp_path / "r"))
    assert read(tmp_path / "r") == "@a\nACGT\n+\nIIII\n>b\nGG\n"
    writers.write_fasta(rows, str(tmp_path / "f"))
    assert read(tmp_path / "f") == ">a\nACGT\n>b\nGG\n"
    writers.write_text(spark, str(tmp_path / "t.html"), "<p>é</p>")
    assert (tmp_path / "t.html").read_text() == "<p>é</p>"
    assert writers.html_table([{"a": "<x>", "b": writers.Markup("<b>y</b>")}], ["a", "b"], titles=["A", "B"], ids=["r1"], classes=["k"]).count("<td>&lt;x&gt;</td><td><b>y</b></td>") == 1
