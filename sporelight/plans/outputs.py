"""A run's result folder: sequences, alignment tables, reports, markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators import report
from ..sources import writers
from .identify import Analysis, Identified

# Names in a result folder.
SEQUENCES = ("contig_sequences.fa", "contig_sequences.blastn.fa", "contig_sequences.blastx.fa", "contig_sequences.undetermined.fa", "blastn.references.fa", "blastx.references.fa")
PAGES = ("blastn.html", "blastx.html", "undetermined.html", "undetermined_blast.html")
TABLES = ("blastn.sam", "blastx.sam", "blastn.xls", "blastx.xls")
MARKERS = ("no_virus_detected_by_blastn", "no_virus_detected_by_blastx")


def write_results(spark: SparkSession, folder: str, found: Identified, contigs: DataFrame, depths: DataFrame, references: DataFrame, proteins: DataFrame | None = None, sirna: float | None = None, details: bool = False, keep: bool = False) -> list[str]:
    """Write everything below ``folder`` and give the names.

    Sequences and tables are folders of part files in order, pages and markers
    single files.  ``details`` adds a page for each kept reference, ``keep`` the
    hit tables, the summary and the depths."""
    at = lambda name: f"{folder.rstrip('/')}/{name}"
    names = [*SEQUENCES, *PAGES, *TABLES]
    for name, rows in zip(SEQUENCES[:4], (contigs, found.known, found.novel, found.undetermined), strict=True):
        writers.write_fasta(rows, at(name))
    subjects = {H.NUCLEOTIDE: references, H.TRANSLATED: proteins if proteins is not None else references.limit(0)}
    parts: dict[str, Analysis] = {H.NUCLEOTIDE: found.nucleotide, H.TRANSLATED: found.translated}
    targets = report.targets(found.summary)
    for i, (analysis, part) in enumerate(parts.items()):
        writers.write_fasta(H.references_of(subjects[analysis], part.kept), at(f"{analysis}.references.fa"))
        writers.write_alignment_table(part.report, contigs, at(f"{analysis}.xls"))
        head, body = writers.hit_sam(part.report)
        writers.write_lines(head.withColumn("part", F.lit(0)).withColumn("n", F.row_number().over(writers.by("value"))).unionByName(body.withColumn("part", F.lit(1)).withColumn("n", F.monotonically_increasing_id())).orderBy("part", "n"), at(f"{analysis}.sam"))
        writers.write_text(spark, at(f"{analysis}.html"), report.reference_page(analysis, part.summary, part.final, f"{analysis}.references.fa"))
        if part.final.isEmpty():
            writers.write_text(spark, at(MARKERS[i]), "")
            names.append(MARKERS[i])
        if details:
            for r in part.summary.where("passes_filters").select("group_id").distinct().orderBy("group_id").collect():  # report-sized
                name = f"{analysis}.{report.slug_text(r.group_id)}.html"
                writers.write_text(spark, at(name), report.detail_page(analysis, r.group_id, part.report))
                names.append(name)
        if keep:
            writers.write_hits(part.raw, at(f"{analysis}.raw.tsv"))
            writers.write_hits(part.top, at(f"{analysis}.top.tsv"))
            names += [f"{analysis}.raw.tsv", f"{analysis}.top.tsv"]
    for name, matched in (("undetermined.html", False), ("undetermined_blast.html", True)):
        writers.write_text(spark, at(name), report.undetermined_page(found.profile, matched, targets, sirna))
    if keep:
        writers.write_summary(found.summary, at("summary.tsv"))
        writers.write_depths(depths, at("contig_depth.tsv"))
        names += ["summary.tsv", "contig_depth.tsv"]
    return sorted(names)
