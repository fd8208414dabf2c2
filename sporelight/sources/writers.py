"""Sinks.  Distributed frames are written by Spark; report-sized ones by the driver."""

from __future__ import annotations

import hashlib
import html
import json
import tarfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.sequence import cigar, general_6g, reverse_complement


def write_fasta(records: DataFrame, path: str) -> None:
    """Header and one sequence line for each record, in order of ``ord`` (part files follow each other)."""
    lines = records.orderBy("ord").select(F.concat(F.lit(">"), "header", F.lit("\n"), "sequence").alias("value"))
    lines.write.mode("overwrite").text(path)


def write_reads(reads: DataFrame, path: str) -> None:
    """FASTQ where a record has a quality, FASTA where not."""
    fastq = F.concat_ws("\n", F.concat(F.lit("@"), "header"), "sequence", F.coalesce("plus", F.lit("+")), "quality")
    fasta = F.concat(F.lit(">"), "header", F.lit("\n"), "sequence")
    reads.orderBy("ord").select(F.when(F.col("quality").isNotNull(), fastq).otherwise(fasta).alias("value")).write.mode("overwrite").text(path)


def write_sam(alignments: DataFrame, path: str) -> None:
    """Records without header lines, edit distance as NM tag."""
    order = [c for c in ("ord", "alt") if c in alignments.columns]
    fields = ["qname", "flag", "rname", F.col("pos").cast("string"), "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", F.concat(F.lit("NM:i:"), F.col("nm").cast("string"))]
    alignments.orderBy(*order).select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)


def write_hits(hits: DataFrame, path: str) -> None:
    hits.select(*schemas.HIT_COLUMNS).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_summary(summary: DataFrame, path: str) -> None:
    """Rows by analysis, group, reference, length, genus and description."""
    rows = summary.withColumn("supporting_contigs", F.array_join("supporting_contigs", ","))
    rows.select(*schemas.SUMMARY_COLUMNS).orderBy("analysis", "group_id", "reference_id", "hit_length", "genus", "description").write.mode("overwrite").csv(path, sep="\t", header=True)


def write_depths(depths: DataFrame, path: str) -> None:
    coverage = F.when(F.col("contig_length") > 0, F.col("covered_bases") / F.col("contig_length")).otherwise(0.0)
    depths.orderBy("contig_id").select("contig_id", "contig_length", "covered_bases", F.round(coverage, 6).alias("contig_coverage"), "total_depth", F.round("mean_depth", 6).alias("mean_depth"), F.round("normalized_depth", 6).alias("normalized_depth")).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_info(records: DataFrame, path: str) -> None:
    """The information table: id, length, genus, description, version, divisions and sources (comma-joined), in order of ``ord``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    joined = [F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), ",") for c in ("divisions", "source")]
    line = F.concat_ws("\t", "id", F.length("sequence").cast("string"), text("genus"), text("description"), text("version"), *joined)
    records.orderBy("ord").select(line.alias("value")).write.mode("overwrite").text(path)


def write_manual_hosts(hosts: DataFrame, path: str) -> None:
    """Host names (``host``) that no taxon was found for, each once, in order."""
    hosts.where("host IS NOT NULL").select(F.col("host").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)


def genus_lines(pairs: DataFrame) -> DataFrame:
    """``genus, value``: a line for each genus with ``division,number,share`` of its divisions, the usual one first (of equals the first by name), then by name."""
    counts = pairs.groupBy("genus", "division").agg(F.count("*").alias("n"))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    best = F.array_max(F.transform("all", lambda x: x["n"]))
    cell = lambda x: F.concat_ws(",", x["division"], x["n"].cast("string"), F.format_string("%.2f", x["n"] / F.col("total")))
    rows = counts.groupBy("genus").agg(F.array_sort(F.collect_list(F.struct("division", "n"))).alias("all"))  # a few divisions
    rows = rows.withColumns({"total": total, "first": F.get(F.filter("all", lambda x: x["n"] == best), 0)})
    others = F.transform(F.filter("all", lambda x: x["division"] != F.col("first.division")), cell)
    return rows.select("genus", F.concat_ws("\t", "genus", cell(F.col("first")), others).alias("value"))


def write_manual_genera(pairs: DataFrame, path: str) -> None:
    """:func:`genus_lines`, in order of the genus."""
    genus_lines(pairs).orderBy("genus").select("value").write.mode("overwrite").text(path)


def write_manual_descriptions(rows: DataFrame, path: str) -> None:
    """Rows of ``taxonomy.classify_by_classified`` as lines for review: id, description, prefix, category, number, percent, examples, and the best hit.

    ``NA-CAT`` stands for a missing category (four empty fields follow), ``NA-BLAST`` for a missing hit."""
    text = lambda c: F.col(c).cast("string")
    vote = F.when(F.col("category").isNull(), F.lit("NA-CAT\t\t\t\t")).otherwise(F.concat_ws("\t", "prefix", "category", text("n"), F.format_string("%.2f", "percent"), "examples"))
    hit = F.when(F.col("query").isNull(), "NA-BLAST").otherwise(F.concat_ws("\t", "division", "query", text("match"), text("identity"), text("score")))
    rows.orderBy("id").select(F.concat(F.col("id"), F.lit("\t"), F.coalesce("description", F.lit("")), F.lit("\t"), vote, F.lit("\t"), hit).alias("value")).write.mode("overwrite").text(path)


def write_cleaned(trimmed: DataFrame, path: str) -> None:
    """Clean reads below ``path/sample=...``: FASTQ where a read has a quality, FASTA where not."""
    body = F.concat(F.col("header"), F.lit("\n"), F.col("trimmed"))
    fastq = F.concat(F.lit("@"), body, F.lit("\n"), F.coalesce("plus", F.lit("+")), F.lit("\n"), F.col("trimmed_quality"))
    clean = trimmed.where("outcome = 'clean'").orderBy("sample", "ord")
    clean.select("sample", F.coalesce(fastq, F.concat(F.lit(">"), body)).alias("value")).write.mode("overwrite").partitionBy("sample").text(path)


def write_trim_report(report: DataFrame, path: str) -> None:
    """A line for each sample with its counters (``reads.trim_report``)."""
    report.orderBy("sample").write.mode("overwrite").csv(path, sep="\t", header=True)


def write_size_table(table: DataFrame, path: str) -> None:
    """Clean reads by length and sample (``reads.size_table``), with a heading for each sample."""
    samples = [c for c in table.columns if c != "size"]
    heading = "\t".join(["#Size", *(f"{c} (No. of reads)" for c in samples)])
    lines = table.select(F.col("size").alias("_at"), F.concat_ws("\t", F.col("size").cast("string"), *(F.col(f"`{c}`").cast("string") for c in samples)).alias("value"))
    first = table.sparkSession.createDataFrame([(-1, heading)], "_at int, value string")
    first.unionByName(lines).orderBy("_at").select("value").write.mode("overwrite").text(path)


def _ordered(hits: DataFrame) -> DataFrame:
    return hits.orderBy("contig_id", "hit_id", F.least("hit_start", "hit_end"), "query_start")


def alignment_table(hits: DataFrame, records: DataFrame) -> DataFrame:
    """Fourteen columns for each hit, with the contig's sequence ('' if unknown)."""
    rows = _ordered(hits.join(records.select(F.col("seq_id").alias("contig_id"), F.col("sequence").alias("contig_sequence")), "contig_id", "left"))
    return rows.select("contig_id", F.coalesce("contig_sequence", F.lit("")).alias("contig_sequence"), "contig_length", "hit_id", "hit_length", "genus", "description", "query_start", "query_end", "hit_start", "hit_end", F.round("percent_identity", 2).alias("identity"), general_6g("evalue").alias("evalue"), F.when(F.col("hit_start") > F.col("hit_end"), -1).otherwise(1).alias("strand"))


def write_alignment_table(hits: DataFrame, records: DataFrame, path: str) -> None:
    alignment_table(hits, records).write.mode("overwrite").csv(path, sep="\t", header=True)


def by(column: str) -> Window:
    """Order of report-sized rows."""
    return Window.orderBy(column)


def sam_query(query: Column, minus: Column) -> Column:
    plain = F.replace(query, F.lit("-"), F.lit(""))
    return F.when(minus, reverse_complement(plain)).otherwise(plain)


def hit_sam(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header lines (one for each subject, by name) and record lines (``value``) of the hits as SAM."""
    head = hits.groupBy("hit_id").agg(F.min_by("hit_length", "ord").alias("n")).orderBy("hit_id").select(F.concat(F.lit("@SQ\tSN:"), "hit_id", F.lit("\tLN:"), F.col("n").cast("string")).alias("value"))
    minus = F.col("hit_start") > F.col("hit_end")
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("H"))).otherwise("")
    left, right = clip(F.least("query_start", "query_end") - 1), clip(F.col("contig_length") - F.greatest("query_start", "query_end"))
    body = cigar(F.col("query_sequence"), F.col("hit_sequence"))
    seq = sam_query(F.col("query_sequence"), minus)
    fields = ["contig_id", F.when(minus, "16").otherwise("0"), "hit_id", F.least("hit_start", "hit_end").cast("string"), F.lit("255"), F.when(minus, F.concat(right, body, left)).otherwise(F.concat(left, body, right)), F.lit("*"), F.lit("0"), F.lit("0"), F.when(seq == "", "*").otherwise(seq), F.lit("*"), F.concat(F.lit("AS:i:"), F.bround("bit_score").cast("long").cast("string")), F.concat(F.lit("EV:Z:"), general_6g("evalue"))]
    return head, _ordered(hits).select(F.concat_ws("\t", *fields).alias("value"))


def write_divisions(parts: DataFrame, path: str) -> None:
    """One folder of FASTA text for each division (columns division, id, sequence)."""
    parts.select("division", F.concat(F.lit(">"), "id", F.lit("\n"), "sequence").alias("value")).write.mode("overwrite").partitionBy("division").text(path)


class Markup(str):
    """Text that is HTML already."""


_STYLE = (
    "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:2px 6px;text-align:left}"
    ".strip{position:relative;height:12px;min-width:160px;background:#eee}.strip i{position:absolute;height:12px}.forward{background:#36c}.backward{background:#e80}"
    ".axis{display:flex;justify-content:space-between}.candidate{background:#dfd}"
    ".identity-high{color:#088}.identity-good{color:#36c}.identity-fair{color:#e80}.identity-low{color:#c22}"
)


def html_document(title: str, body: str) -> str:
    return f"<!doctype html>\n<html><head><meta charset='utf-8'><title>{html.escape(title)}</title><style>{_STYLE}</style></head><body><h1>{html.escape(title)}</h1>\n{body}\n</body></html>\n"


def html_table(rows: list[dict], columns: list[str], groups: list[tuple[str, int]] | None = None, titles: list[str] | None = None, help_: dict[str, str] | None = None, ids: list[str] | None = None, classes: list[str] | None = None) -> str:
    """Table of report-sized rows; ``groups`` gives a first header row (title, columns spanned), ``help_`` tooltips by title, ``ids`` and ``classes`` one value a row."""
    cell = lambda v: v if isinstance(v, Markup) else html.escape("" if v is None else str(v))
    top = "<tr>" + "".join(f"<th colspan='{n}'>{html.escape(t)}</th>" for t, n in groups) + "</tr>" if groups else ""
    head = "<tr>" + "".join(f"<th title='{html.escape((help_ or {}).get(t, t))}'>{html.escape(t)}</th>" for t in titles or columns) + "</tr>"
    mark = lambda name, values, i: f" {name}='{html.escape(values[i])}'" if values and values[i] else ""
    body = "".join(f"<tr{mark('id', ids, i)}{mark('class', classes, i)}>" + "".join(f"<td>{cell(r.get(c))}</td>" for c in columns) + "</tr>\n" for i, r in enumerate(rows))
    return f"<table>{top}{head}\n{body}</table>"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A report-sized text as one file, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_lines(rows: DataFrame, path: str) -> None:
    """The column ``value`` as lines."""
    rows.select("value").write.mode("overwrite").text(path)


def write_json(path: str, value: dict) -> None:
    Path(path).write_text(json.dumps(value, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def bundle(folder: str, archive: str, manifest: dict) -> str:
    """A tar.gz of a database folder with its manifest, and a checksum file beside it; gives the checksum."""
    write_json(str(Path(folder) / "manifest.json"), manifest)
    with tarfile.open(archive, "w:gz") as tar:
        tar.add(folder, arcname=Path(folder).name)
    digest = sha256_of(archive)
    Path(archive + ".sha256").write_text(f"{digest}  {Path(archive).name}\n", encoding="utf-8")
    return digest
