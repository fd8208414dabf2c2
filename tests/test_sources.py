"""Readers, sinks, plans and streams on files made in the test."""

import gzip

import pytest
from pyspark.sql import functions as F

from sporelight import schemas
from sporelight.operators import report
from sporelight.plans import database, identify
from sporelight.sources import readers, writers
from sporelight.streaming import reads as streams


def put(path, text):
    path.write_text(text)
    return str(path)


def test_reads_and_fasta(spark, tmp_path):
    fq = put(tmp_path / "a.fq", "@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\n##\n")
    assert [(r.ord, r.header, r.sequence, r.quality) for r in readers.read_reads(spark, fq).orderBy("ord").collect()] == [(0, "r1 x", "ACGT", "IIII"), (1, "r2", "GG", "##")]
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">s1 first one\nAC\n GT \n\n>s2\nTTT\n")
    got = readers.read_fasta(spark, str(tmp_path / "b.fa.gz")).orderBy("ord").collect()
    assert [(r.seq_id, r.header, r.sequence) for r in got] == [("s1", "s1 first one", "ACGT"), ("s2", "s2", "TTT")]
    with pytest.raises(Exception, match="cut-off"):
        readers.read_reads(spark, put(tmp_path / "c.fq", "@r1\nAC\n+\n")).collect()
    with pytest.raises(ValueError):
        readers.file_type(spark, put(tmp_path / "d", "x\n"))


def test_tables(spark, tmp_path):
    sam = put(tmp_path / "x.sam", "@SQ\tSN:r\nq\t0\tr\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tXA:Z:r2,+1,4M,0;\nshort\t1\n")
    r = readers.read_sam(spark, sam).collect()
    assert [(x.qname, x.pos, x.nm, x.xa) for x in r] == [("q", 5, 1, "r2,+1,4M,0;")]
    note = put(tmp_path / "n.tsv", "AB123\t1000\tvirusgenus\tExample\nAB123\tbad\tg2\tlast\nx\ty\n")
    assert [tuple(x) for x in readers.read_annotation(spark, note).collect()] == [("AB123", 0, "g2", "last")]
    ids = put(tmp_path / "i.tsv", "AB123\tPROT1\n")
    assert [tuple(x) for x in readers.read_id_map(spark, ids).collect()] == [("PROT1", "AB123")]
    hits = put(tmp_path / "h.tsv", "c1\t100\tref|R1|\t500\t90\t95.5\t1e-20\t180\t1\t90\t5\t94\t90\tAC\"G\tACG\n")
    row = readers.read_search(spark, hits, "blastn").first()
    assert (row.qseqid, row.evalue, row.qseq, row.sseq) == ("c1", 1e-20, 'AC"G', "ACG")
    nodes = put(tmp_path / "nodes.dmp", "2\t|\t1\t|\tgenus\t|\tXX\t|\t9\t|\n")
    assert tuple(readers.read_tax_nodes(spark, nodes).first()) == (2, 1, "genus", 9)
    gb = put(tmp_path / "g.gb", "LOCUS       AB1 20 bp\nDEFINITION  A virus\n            of things.\nACCESSION   AB1\nVERSION     AB1.2\nSOURCE      a virus\nFEATURES             Location/Qualifiers\n     source          1..20\n                     /host=\"Solanum\n                     lycopersicum\"\n                     /db_xref=\"taxon:12\"\n     CDS             1..9\n                     /protein_id=\"P1.1\"\n                     /translation=\"MK\n                     L\"\nORIGIN\n        1 acgtacgtac gtacgtacgt\n//\n")
    rec = readers.read_genbank(spark, gb)
    first = rec.first()
    assert (first.accession, first.version, first.description, first.sequence) == ("AB1", "AB1.2", "A virus of things", "ACGT" * 5)
    assert [f.key for f in first.features] == ["source", "CDS"]
    assert rec.select(readers.qualifier(F.get("features", 0), "host").alias("h")).first().h == "Solanum lycopersicum"
    from sporelight.operators import taxonomy

    assert [tuple(x) for x in taxonomy.translations(rec).collect()] == [("AB1.2", "P1.1", "MKL")]
    assert readers.aligner_report("10 reads; of these:\n    4 (40%) aligned 0 times\n") == (10, 6)


def _hits(spark, rows):
    names = [x.split()[0] for x in schemas.HITS.split(", ")]
    base = dict(analysis="blastn", contig_length=100, hit_length=1000, genus="g", description="d", alignment_length=7, percent_identity=95.0, evalue=1e-20, bit_score=200.0, query_start=2, query_end=8, hit_start=11, hit_end=5, query_coverage=100.0, query_sequence="CGT-AAA", hit_sequence="CGTTAAA")
    return spark.createDataFrame([tuple({**base, "ord": i, **r}[n] for n in names) for i, r in enumerate(rows)], schemas.HITS)


def test_hit_outputs(spark):
    h = _hits(spark, [dict(contig_id="c1", hit_id="refA", reference_id="refA")])
    head, body = writers.hit_sam(h)
    assert head.first().value == "@SQ\tSN:refA\tLN:1000"
    assert body.first().value.split("\t") == ["c1", "16", "refA", "5", "255", "92H3M1D3M1H", "*", "0", "0", "TTTACG", "*", "AS:i:200", "EV:Z:1e-20"]
    text = report.alignment_text(h).first().text.split("\n")
    assert text[0] == "Query  2 CGT-AAA  7" and text[2] == "Hit   11 CGTTAAA  5"
    assert report.ticks(1000) == [1, 250, 500, 750, 1000]
    row = writers.alignment_table(h, spark.createDataFrame([("c1", "ACGT")], "seq_id string, sequence string")).first()
    assert len(row) == 14 and row.strand == -1


def test_cascade(spark):
    contigs = spark.createDataFrame([(i, c, c, "A" * 100) for i, c in enumerate(["c1", "c2", "c3"])], schemas.SEQ)
    depth = spark.createDataFrame([(c, 100, 100, 1000, 10.0, 100.0) for c in ("c1", "c2", "c3")], schemas.CONTIG_DEPTH)
    long = dict(hit_start=1, hit_end=900)
    n = _hits(spark, [dict(contig_id="c1", hit_id="r1", reference_id="r1", **long), dict(contig_id="c3", hit_id="r9", reference_id="r9", percent_identity=10.0)])
    x = _hits(spark, [dict(contig_id="c2", hit_id="p1", reference_id="r2", analysis="blastx", **long), dict(contig_id="c1", hit_id="p1", reference_id="r2", analysis="blastx", **long), dict(contig_id="c3", hit_id="p3", reference_id="r3", analysis="blastx", evalue=1e-30, percent_identity=5.0)])
    out = identify.identify(contigs, n, x, depth, 1_000_000)
    ids = lambda df: sorted(r.seq_id for r in df.collect())
    assert (ids(out.known), ids(out.novel), ids(out.undetermined)) == (["c1"], ["c2"], ["c3"])
    assert [(r.contig_id, r.hit_id) for r in out.best_raw.collect()] == [("c3", "p3")]
    page = report.reference_page("blastn", out.summary.join(out.kept, ["analysis", "group_id"], "left_semi").withColumn("passes_filters", F.lit(True)), out.final_hits)
    assert "r1" in page and "r9" not in page
    assert "alignment-r1-1" in report.detail_page("blastn", "r1", n)


def test_database_bundle(tmp_path):
    folder = tmp_path / "db"
    folder.mkdir()
    for name in ("a.fa", "b.tsv"):
        put(folder / name, name)
    assert database.kind_of(folder, ("a.fa", "b.tsv")) == "legacy"
    digest = database.make_bundle(folder, str(tmp_path / "db.tar.gz"), "plants", "1")
    assert database.expected_sha256(str(tmp_path / "db.tar.gz.sha256")) == digest
    got = database.install(str(tmp_path / "db.tar.gz"), tmp_path / "out")
    assert database.missing_files(got) == [] and database.kind_of(got) == "manifest"
    put(tmp_path / "db.tar.gz.sha256", "0 x")
    with pytest.raises(ValueError):
        database.install(str(tmp_path / "db.tar.gz"), tmp_path / "out2")


def test_streams(spark, tmp_path):
    spark.createDataFrame([("r", "ACG", "2024-01-01 00:00:00"), ("r", "ACG", "2024-01-01 00:01:00"), ("r", "AC", "2024-01-01 00:02:00")], "rname string, seq string, ts string").selectExpr("rname", "seq", "seq AS sequence", "timestamp(ts) AS ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("rname string, seq string, sequence string, ts timestamp").parquet(str(tmp_path / "in"))
    for name, df, mode in (("h", streams.histogram(stream), "complete"), ("f", streams.first_seen(stream, "ts"), "append"), ("w", streams.windowed_counts(stream, "ts"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
    assert {(r.read_length, r.n) for r in spark.table("h").collect()} == {(3, 2), (2, 1)}
    assert sorted(r.sequence for r in spark.table("f").collect()) == ["AC", "ACG"]
    assert [r.n for r in spark.table("w").collect()] == [3]


def test_a_folder_is_read_in_name_order_whatever_the_splits(spark, tmp_path):
    def record(f, i, size):
        return f"@{f}{i}\n{'ACGT'[i % 4] * size}\n+\n{'I' * size}\n"

    (tmp_path / "reads").mkdir()
    for f, n, size in (("a", 5, 30), ("b", 3, 7), ("c", 40, 3)):
        (tmp_path / "reads" / f"{f}.fq").write_text("".join(record(f, i, size) for i in range(n)))
    with gzip.open(tmp_path / "reads" / "d.fq.gz", "wt") as f:
        f.write("".join(record("d", i, 9) for i in range(6)))
    (tmp_path / "fasta").mkdir()
    (tmp_path / "fasta" / "x.fa").write_text("".join(f">x{i} d\nAC\n\n GT\n" for i in range(20)))
    (tmp_path / "fasta" / "y.fa").write_text(">y0\nA\n")
    (tmp_path / "sam").mkdir()
    for f in "kl":
        (tmp_path / "sam" / f"{f}.sam").write_text("@HD\n" + "".join(f"{f}{i}\t0\tr\t{i}\t9\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\n" for i in range(30)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    try:
        rows = readers.read_reads(spark, str(tmp_path / "reads")).orderBy("ord").collect()
        names = [f"{f}{i}" for f, n in (("a", 5), ("b", 3), ("c", 40), ("d", 6)) for i in range(n)]
        assert [(r.ord, r.header) for r in rows] == list(enumerate(names))
        assert all(r.sequence == "ACGT"[int(r.header[1:]) % 4] * len(r.quality) and r.plus == "+" and set(r.quality) == {"I"} for r in rows)
        fasta = readers.read_fasta(spark, str(tmp_path / "fasta")).orderBy("ord").collect()
        assert [(r.seq_id, r.sequence) for r in fasta] == [(f"x{i}", "ACGT") for i in range(20)] + [("y0", "A")]
        sam = readers.read_sam(spark, str(tmp_path / "sam")).orderBy("ord").collect()
        assert [r.qname for r in sam] == [f"{f}{i}" for f in "kl" for i in range(30)]
        assert [r.ord for r in sam] == [*range(1, 31), *range(32, 62)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "reads" / "b.fq").write_text("@b0\nAC\n+\n")
    with pytest.raises(Exception, match="cut-off record"):
        readers.read_reads(spark, str(tmp_path / "reads")).collect()
    (tmp_path / "reads" / "b.fq").write_text(">b0\nAC\n")
    with pytest.raises(ValueError, match="both FASTA and FASTQ"):
        readers.read_reads(spark, str(tmp_path / "reads"))
