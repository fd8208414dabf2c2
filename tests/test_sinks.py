"""Sinks of the database preparation and of adapter trimming, read back as text."""

import glob

from pyspark.sql import functions as F

from sporelight.operators import reads, report, taxonomy
from sporelight.sources import writers


def _text(path):
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_information_and_manual_tables(spark, tmp_path):
    rows = [(1, "b", "ACGT", "Genus", "a \"virus\"", "b.1", ["Plants", "Fungi"], ["ICTV"]), (0, "a", "AC", None, "", "a.1", None, [])]
    writers.write_info(spark.createDataFrame(rows, "ord long, id string, sequence string, genus string, description string, version string, divisions array<string>, source array<string>"), str(tmp_path / "info"))
    assert _text(tmp_path / "info") == "a\t2\t\t\ta.1\t\t\nb\t4\tGenus\ta \"virus\"\tb.1\tPlants,Fungi\tICTV\n"
    writers.write_manual_hosts(spark.createDataFrame([("z",), ("m n",), (None,), ("z",)], "host string"), str(tmp_path / "hosts"))
    assert _text(tmp_path / "hosts") == "m n\nz\n"
    pairs = [("G", "Plants")] * 2 + [("G", "Algae")] * 2 + [("G", "Fungi")] + [("A", "Fungi")]
    writers.write_manual_genera(spark.createDataFrame(pairs, "genus string, division string"), str(tmp_path / "genera"))
    assert _text(tmp_path / "genera") == "A\tFungi,1,1.00\nG\tAlgae,2,0.40\tFungi,1,0.20\tPlants,2,0.40\n"


def test_descriptions_for_review(spark, tmp_path):
    records = [(0, "a", "Tomato virus X gene", "Plants"), (1, "u", "Tomato virus Y", "Unassigned"), (2, "v", None, "Unassigned")]
    hits = [(0, "a", "u", 90.5, 50, 2, 1, 80.0, "Plants")]
    out = taxonomy.classify_by_classified(spark.createDataFrame(records, "ord long, id string, description string, category string"), spark.createDataFrame(hits, "ord long, query string, subject string, identity double, length int, mismatches int, gaps int, score double, division string"))
    writers.write_manual_descriptions(out, str(tmp_path / "manual"))
    assert _text(tmp_path / "manual") == "u\tTomato virus Y\ttomato virus\tPlants\t1\t100.00\ta\tPlants\ta\t47\t90.5\t80.0\nv\t\tNA-CAT\t\t\t\t\tNA-BLAST\n"


def test_cleaned_reads_and_tables(spark, tmp_path):
    adapter = "TGGAATTCTCG"
    rows = [(0, "r0", "ACGTACGTACGTACGTAC" + adapter, "+", "I" * 29, "s1"), (1, "r1", "ACGTACGTACGTACGT" + adapter, None, None, "s 2"), (2, "r2", "ACG" + adapter, None, None, "s 2"), (3, "r3", "ACGT", None, None, "s1")]
    trimmed = reads.trim(spark.createDataFrame(rows, "ord long, header string, sequence string, plus string, quality string, sample string"), adapter3=adapter)
    writers.write_cleaned(trimmed, str(tmp_path / "clean"))
    assert _text(tmp_path / "clean" / "sample=s1") == "@r0\nACGTACGTACGTACGTAC\n+\n" + "I" * 18 + "\n"
    assert _text(tmp_path / "clean" / "sample=s 2") == ">r1\nACGTACGTACGTACGT\n"
    writers.write_trim_report(reads.trim_report(trimmed), str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), sep="\t", header=True).where("sample = 's 2'").first().asDict() == {"sample": "s 2", "total": "2", "unmatch3": "0", "null3": "0", "match3": "2", "base_n": "0", "short": "1", "cleaned": "1"}
    writers.write_size_table(reads.size_table(trimmed, ["s1", "s 2"]), str(tmp_path / "sizes"))
    assert _text(tmp_path / "sizes") == "#Size\ts1 (No. of reads)\ts 2 (No. of reads)\n16\t0\t1\n18\t1\t0\n"


def test_labels(spark):
    df = spark.createDataFrame([("blastn", "g", "r"), ("blastx", "g", "r")], "a string, g string, r string")
    out = df.select(report.accession_label(F.col("a")).alias("label"), report.accession_link(F.col("a"), F.col("g"), F.col("r")).alias("link")).collect()
    assert [(r.label, r.link.rsplit("/", 2)[1:]) for r in out] == [("Reference ID", ["nuccore", "r"]), ("Protein ID", ["protein", "g"])]
