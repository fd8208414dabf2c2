"""Text sources as DataFrames with a place number (``ord``) that follows the file.

Line numbers come from a written scan and one count by split: a line's number is the
lines of the files and splits before its own, plus its place there.  gzip is opened by suffix.  Files that must be read as a whole (several
lines to a record) stay distributed: records are cut from numbered lines.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.sequence import first_token, normalize_id
from ..store import written


def _placed(raw: DataFrame) -> DataFrame:
    """``ord, file, n, value`` of a text scan: the place among all rows, files in order of their names, and the place in the file.

    A split's rows follow each other; splits are put in order by file and offset, whichever partitions they were read in.
    The scan is written once, with its numbers in it, so that counting and numbering see the same rows."""
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"), "value")
    raw = written(raw, "text-lines")
    splits = raw.groupBy("file", "block").agg(F.min("m").alias("first"), F.count("*").alias("rows"))
    earlier = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = splits.groupBy("file").agg(F.sum("rows").alias("rows"))
    files = files.select("file", earlier(Window.orderBy("file")).alias("files_before"))  # a row for each file
    splits = splits.select("file", "block", "first", earlier(Window.partitionBy("file").orderBy("block")).alias("before")).join(files, "file")
    n = F.col("m") - F.col("first") + F.col("before")
    return raw.join(splits, ["file", "block"]).select((n + F.col("files_before")).alias("ord"), "file", n.alias("n"), "value")


def numbered_lines(spark: SparkSession, path: str, errors: str = "replace") -> DataFrame:
    """``ord`` (from 0), ``line``, ``file`` and the line's number ``n`` in it; a folder's files come in order of their names.

    With ``errors="strict"`` bytes that are no UTF-8 are an error."""
    raw = spark.read.text(path)
    if errors == "strict":
        bad = F.raise_error(F.lit(f"no UTF-8 text: {path}")).cast("string")
        raw = raw.withColumn("value", F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(bad))
    return _placed(raw).select("ord", F.col("value").alias("line"), "file", "n")


def _kind(line: str, path: str) -> str:
    if line.startswith(">"):
        return "fasta"
    if line.startswith("@"):
        return "fastq"
    raise ValueError(f"neither FASTA nor FASTQ: {path}")


def file_type(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).first()
    return _kind(first.value if first else "", path)


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """Reads by position: two lines to a FASTA record, four to a FASTQ record; a cut-off record is an error.

    Of a folder, each file begins a record of its own, and all must be of one kind."""
    lines = numbered_lines(spark, path)
    marks = sorted(r.c for r in lines.where("n = 0").select(F.substring("line", 1, 1).alias("c")).distinct().limit(3).collect())
    kinds = {_kind(c, path) for c in marks or [""]}
    if len(kinds) > 1:
        raise ValueError(f"both FASTA and FASTQ: {path}")
    size = 2 if kinds == {"fasta"} else 4
    pick = lambda i: F.max(F.when(F.col("n") % size == i, F.col("line")))
    rows = lines.groupBy("file", F.floor(F.col("n") / size).alias("rec")).agg(F.min("ord").alias("first"), *(pick(i).alias(f"l{i}") for i in range(size)), F.count("*").alias("rows"))
    header = F.when(F.col("rows") == size, F.substring("l0", 2, 1 << 30)).otherwise(F.raise_error(F.concat(F.lit("cut-off record in "), F.col("file"))).cast("string"))
    extra = [F.col("l2").alias("plus"), F.col("l3").alias("quality")] if size == 4 else [F.lit(None).cast("string").alias(c) for c in ("plus", "quality")]
    return rows.select(F.floor(F.col("first") / size).alias("ord"), header.alias("header"), F.col("l1").alias("sequence"), *extra)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line FASTA; blank lines are skipped, sequence lines trimmed and joined; a folder's files come in order of their names."""
    raw = _placed(spark.read.option("lineSep", "\n>").text(path)).select("ord", F.regexp_replace("value", "^>", "").alias("rec")).where(F.trim("rec") != "")
    lines = F.split("rec", "\r?\n")
    header = F.trim(F.get(lines, 0))
    body = F.array_join(F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.trim(x)), "")
    return raw.select("ord", header.alias("header"), first_token(header).alias("seq_id"), body.alias("sequence"))


def _fields(spark: SparkSession, path: str, least: int, comment: str | None = None) -> DataFrame:
    lines = numbered_lines(spark, path)
    if comment:
        lines = lines.where(~F.col("line").startswith(comment))
    return lines.withColumn("f", F.split("line", "\t", -1)).where(F.size("f") >= least)


def _f(i: int) -> Column:
    return F.get("f", i)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    tags = F.array_join(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), "\t")
    nm, xa = F.regexp_extract(tags, r"(?:^|\t)NM:i:(-?\d+)", 1), F.regexp_extract(tags, r"(?:^|\t)XA:Z:([^\t]*)", 1)
    rows = _fields(spark, path, 11, "@")
    return rows.select("ord", _f(0).alias("qname"), _f(1).alias("flag"), _f(2).alias("rname"), F.try_to_number(_f(3), F.lit("9999999999")).cast("int").alias("pos"), _f(4).alias("mapq"), _f(5).alias("cigar"), _f(6).alias("rnext"), _f(7).alias("pnext"), _f(8).alias("tlen"), _f(9).alias("seq"), _f(10).alias("qual"), F.when(nm != "", nm.cast("int")).alias("nm"), F.when(xa != "", xa).alias("xa"))


def read_pileup(spark: SparkSession, path: str, least: int = 6) -> DataFrame:
    """Pileup rows of at least six fields (four are enough for depths)."""
    return _fields(spark, path, least).select("ord", _f(0).alias("ref_id"), _f(1).cast("int").alias("pos"), _f(2).alias("ref_base"), _f(3).cast("int").alias("depth"), _f(4).alias("bases"), _f(5).alias("quals"))


def read_search(spark: SparkSession, path: str, analysis: str) -> DataFrame:
    """Tabular search output with ``ord``; the two last (sequence) columns may be missing. ``analysis`` names it in errors.

    A missing or empty file has no rows; a row of fewer than thirteen fields is an error."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "ord long, " + schemas.SEARCH)
    rows = _fields(spark, path, 1).where(F.col("line") != "")
    number = lambda i, t: F.when(_f(i).rlike(r"^\s*[-+0-9.eE]+\s*$"), F.trim(_f(i)).cast(t)).otherwise(F.raise_error(F.concat(F.lit(f"{analysis}: no number: "), F.coalesce(_f(i), F.lit("(missing)")))).cast(t))
    names = schemas.SEARCH.split(", ")
    return rows.select("ord", *((_f(i) if n.split()[1] == "string" else number(i, n.split()[1])).alias(n.split()[0]) for i, n in enumerate(names[:13])), _f(13).alias("qseq"), _f(14).alias("sseq"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """reference_id, hit_length (0 if no number), genus, description; the last row of an id wins."""
    lines = numbered_lines(spark, path).withColumn("f", F.split(F.rtrim("line"), "\t", -1)).where(F.size("f") >= 4)
    rows = lines.select("ord", normalize_id(_f(0)).alias("reference_id"), F.coalesce(F.try_to_number(F.trim(_f(1)), F.lit("9999999999")).cast("int"), F.lit(0)).alias("hit_length"), _f(2).alias("genus"), _f(3).alias("description"))
    last = rows.groupBy("reference_id").agg(F.max_by(F.struct("hit_length", "genus", "description"), "ord").alias("x"))
    return last.select("reference_id", "x.*")


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """protein_id to reference_id from ``nucleotide TAB protein`` rows; the last row of a protein wins."""
    rows = numbered_lines(spark, path).withColumn("f", F.split(F.rtrim("line"), "\t", -1)).where(F.size("f") >= 2)
    return rows.groupBy(normalize_id(_f(1)).alias("protein_id")).agg(F.max_by(normalize_id(_f(0)), "ord").alias("reference_id"))


def info_lengths(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """``ref_id, length`` of the ids given, 0 if the table lacks one; ids are taken as they stand."""
    rows = numbered_lines(spark, path).where((F.trim("line") != "") & ~F.col("line").startswith("#")).withColumn("f", F.split("line", "\t")).where(F.size("f") >= 2)
    lengths = rows.groupBy(_f(0).alias("ref_id")).agg(F.max_by(F.try_to_number(F.trim(_f(1)), F.lit("9999999999")).cast("int"), "ord").alias("length"))
    return ids.select("ref_id").distinct().join(lengths, "ref_id", "left").select("ref_id", F.coalesce("length", F.lit(0)).alias("length"))


def fasta_lengths(sequences: DataFrame) -> DataFrame:
    """Length by sequence id; of equal ids the last one counts."""
    return sequences.groupBy("seq_id").agg(F.max_by(F.length("sequence"), "ord").alias("length"))


def read_tax_nodes(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", r"\t\|\t?")
    return spark.read.text(path).select(F.get(f, 0).cast("long").alias("tax_id"), F.get(f, 1).cast("long").alias("parent"), F.get(f, 2).alias("rank"), F.get(f, 4).cast("int").alias("division"))


def read_tax_names(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("line", r"\t\|\t?")
    return numbered_lines(spark, path).select("ord", F.get(f, 0).cast("long").alias("tax_id"), F.lower(F.get(f, 1)).alias("name"), F.get(f, 3).alias("name_class"))


def read_genus_divisions(spark: SparkSession, base: str, update: str | None = None) -> tuple[DataFrame, DataFrame]:
    """genus to division codes, the base table first; and the genera on which the two disagree. NA rows don't count."""

    def one(path: str, priority: int) -> DataFrame:
        rows = _fields(spark, path, 2, "#")
        codes = F.split(F.regexp_replace(F.trim(_f(1)), r"\s", ""), ",")
        return rows.where(F.trim(_f(1)) != "NA").select(F.lower(F.trim(_f(0))).alias("genus"), codes.alias("codes"), F.struct(F.lit(priority), "ord").alias("at"))

    rows = one(base, 0) if update is None else one(base, 0).unionByName(one(update, 1))
    chosen = rows.groupBy("genus").agg(F.min_by("codes", "at").alias("codes"), F.size(F.collect_set(F.array_join("codes", ","))).alias("n"))
    return chosen.select("genus", "codes"), chosen.where("n > 1").select("genus")


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Host names to corrected names; rows without a correction don't count."""
    rows = _fields(spark, path, 2, "#").where(F.trim(_f(1)) != "")
    return rows.groupBy(F.lower(F.trim(_f(0))).alias("name")).agg(F.max_by(F.lower(F.trim(_f(1))), "ord").alias("corrected"))


def read_manual(spark: SparkSession, path: str, divisions: DataFrame) -> DataFrame:
    """id to division names set by hand; a name that is no division is an error."""
    rows = _fields(spark, path, 2, "#").select("ord", F.trim(_f(0)).alias("key"), F.explode(F.split(_f(1), ",")).alias("division")).withColumn("division", F.trim("division"))
    names = divisions.select(F.col("name").alias("division"), F.lit(True).alias("_ok")).distinct()
    known = rows.join(F.broadcast(names), "division", "left")  # divisions: a literal table of sixteen rows
    good = F.when(F.col("_ok"), F.col("division")).otherwise(F.raise_error(F.concat(F.lit("no division: "), "division")).cast("string"))
    return known.groupBy("key").agg(F.array_sort(F.collect_set(good)).alias("divisions"))


def read_previous(spark: SparkSession, path: str) -> DataFrame:
    """Earlier classification: id, length, genus, description, version, divisions, source."""
    rows = _fields(spark, path, 7, "#")
    return rows.select(_f(0).alias("id"), _f(1).cast("int").alias("length"), _f(2).alias("genus"), _f(3).alias("description"), _f(4).alias("version"), F.split(_f(5), ",").alias("divisions"), F.split(_f(6), ",").alias("source"))


def read_cluster_representatives(spark: SparkSession, path: str) -> DataFrame:
    text = F.regexp_extract("value", r">(\S+)\.\.\. \*", 1)
    return spark.read.text(path).select(text.alias("seq_id")).where("seq_id <> ''")


def read_hits12(spark: SparkSession, path: str) -> DataFrame:
    rows = _fields(spark, path, 12, "#")
    return rows.select("ord", _f(0).alias("query"), _f(1).alias("subject"), _f(2).cast("double").alias("identity"), _f(3).cast("int").alias("length"), _f(10).cast("double").alias("evalue"), F.trim(_f(11)).cast("double").alias("score"))


def read_genbank(spark: SparkSession, path: str) -> DataFrame:
    """GenBank flat records: accession, version, source, description, sequence, and features (key, location, qualifiers)."""
    raw = spark.read.option("lineSep", "\n//").text(path).select(F.monotonically_increasing_id().alias("ord"), F.regexp_replace("value", r"^\s*\n", "").alias("rec")).where(F.col("rec").contains("LOCUS"))
    field = lambda name: F.trim(F.regexp_replace(F.regexp_extract("rec", rf"(?s)(?:^|\n){name} +(.*?)(?=\n\S|\n {{2}}[A-Z]|$)", 1), r"\s*\n\s+", " "))
    origin = F.regexp_replace(F.regexp_extract("rec", r"(?s)\nORIGIN[^\n]*\n(.*)$", 1), r"[^A-Za-z]", "")
    table = F.regexp_extract("rec", r"(?s)\nFEATURES[^\n]*\n(.*?)(?=\nORIGIN|\nCONTIG|$)", 1)
    blocks = F.regexp_extract_all(F.concat(F.lit("\n"), table, F.lit("\n")), F.lit(r"(?s)\n {5}(\S.*?)(?=\n {5}\S|\n$)"), 1)

    def feature(b: Column) -> Column:
        key = F.regexp_extract(b, r"^(\S+)", 1)
        place = F.regexp_replace(F.regexp_extract(b, r"(?s)^\S+\s+(.*?)(?=\s+/|$)", 1), r"\s", "")
        pairs = F.regexp_extract_all(b, F.lit(r'(?s)/(\w+="(?:[^"]|"")*"|\w+=[^\s]+)'), 1)
        one = lambda p: F.struct(F.regexp_extract(p, r"^(\w+)=", 1).alias("name"), F.regexp_replace(F.regexp_replace(F.regexp_extract(p, r'(?s)^\w+="?(.*?)"?$', 1), r"\s*\n\s+", " "), '""', '"').alias("value"))
        return F.struct(key.alias("key"), place.alias("location"), F.transform(pairs, one).alias("qualifiers"))

    return raw.select("ord", F.split(field("ACCESSION"), " ")[0].alias("accession"), F.split(field("VERSION"), " ")[0].alias("version"), field("SOURCE").alias("source"), F.regexp_replace(field("DEFINITION"), r"\.$", "").alias("description"), F.upper(origin).alias("sequence"), F.transform(blocks, feature).alias("features"))


def qualifier(feature: Column, name: str) -> Column:
    """First value of a feature's qualifier."""
    return F.get(F.filter(feature["qualifiers"], lambda q: q["name"] == name), 0)["value"]


def read_manifest(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        out = json.load(f)
    if not isinstance(out, dict):
        raise ValueError(f"a manifest is an object: {path}")
    return out


def aligner_report(text: str) -> tuple[int, int]:
    """Total and mapped reads of an aligner's report."""
    import re

    total, missed = re.search(r"(\d+) reads; of these:", text), re.search(r"\s+(\d+) .*aligned 0 times", text)
    n = int(total[1]) if total else 0
    return n, max(n - (int(missed[1]) if missed else 0), 0)
