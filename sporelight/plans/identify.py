"""Identification cascade: nucleotide hits, then translated hits of what is left, then the undetermined rest."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hits as H
from ..store import written


@dataclass(frozen=True)
class Cutoffs:
    """Defaults of the cascade."""

    translated_identity: float = 25.0
    coverage: float = 0.1
    depth: float = 5.0
    normalized_depth: float = 5.0
    diff_ratio: float = 0.25
    diff_cover: float = 0.5
    diff_length: int = 100
    sirna: float = 0.5
    interval_mode: str = "reference"


@dataclass
class Analysis:
    """One search's outcome: all hits, the best above the thresholds, flagged summary, kept groups, final and reported hits."""

    raw: DataFrame
    top: DataFrame
    summary: DataFrame
    kept: DataFrame
    final: DataFrame
    report: DataFrame


@dataclass
class Identified:
    known: DataFrame
    novel: DataFrame
    undetermined: DataFrame
    summary: DataFrame
    final_hits: DataFrame
    best_raw: DataFrame
    kept: DataFrame = field(repr=False)
    nucleotide: Analysis = field(repr=False)
    translated: Analysis = field(repr=False)
    profile: DataFrame = field(repr=False)  # undetermined contigs with depth, small-RNA lengths and best raw hit

    def counts(self) -> dict[str, int]:
        return {"known_contig_count": self.known.count(), "novel_contig_count": self.novel.count(), "undetermined_contig_count": self.undetermined.count()}


def select_references(hits: DataFrame, depths: DataFrame, library_size: int, identity: float, coverage: float, cutoffs: Cutoffs) -> Analysis:
    """References that one analysis' hits support, and what remains of the hits."""
    good = H.passing(hits, identity, coverage)
    summary = written(H.summarize(good, depths, library_size, cutoffs.coverage, cutoffs.depth, cutoffs.normalized_depth, cutoffs.interval_mode), "summary")
    edges = written(H.redundancy_edges(summary, H.support(good), cutoffs.diff_ratio, cutoffs.diff_cover, cutoffs.diff_length, cutoffs.interval_mode), "edges")
    kept = H.kernel(summary.where("passes_coverage_depth").select("analysis", "group_id"), edges)
    report = good.withColumn("group_id", H.group_id()).join(kept.select("group_id").distinct(), "group_id", "left_semi")
    return Analysis(hits, H.best_by_contig(good), H.flag(summary, kept), kept, H.best_final(hits, identity, coverage, kept), report)


def identify(contigs: DataFrame, nucleotide: DataFrame, translated, depths: DataFrame, library_size: int, cutoffs: Cutoffs | None = None, lengths: DataFrame | None = None) -> Identified:
    """``translated``: hits, or a function of the remaining contigs that gives them (asked for only if any remain).

    ``lengths``: read lengths by contig, for the small-RNA profile of what stays undetermined."""
    cutoffs = cutoffs or Cutoffs()
    first = select_references(nucleotide, depths, library_size, H.NUCLEOTIDE_IDENTITY, H.NUCLEOTIDE_COVERAGE, cutoffs)
    known, remaining = H.known(contigs, first.final)
    remaining = written(remaining, "remaining")
    if remaining.isEmpty():
        found = nucleotide.limit(0)
    else:
        found = translated(remaining) if callable(translated) else translated
        found = found.join(remaining.select(F.col("seq_id").alias("contig_id")).distinct(), "contig_id", "left_semi").select(*nucleotide.columns)
    second = select_references(found, depths, library_size, cutoffs.translated_identity, H.TRANSLATED_COVERAGE, cutoffs)
    novel, rest = H.known(remaining, second.final)
    known_ids = known.select(F.col("seq_id").alias("contig_id")).distinct()
    first.report = first.report.join(known_ids, "contig_id", "left_semi")
    rest_ids = rest.select(F.col("seq_id").alias("contig_id")).distinct()
    ranked = nucleotide.withColumn("ord", F.struct(F.lit(0).alias("a"), "ord")).unionByName(found.withColumn("ord", F.struct(F.lit(1).alias("a"), "ord")))
    best_raw = written(H.best_by_contig(ranked.join(rest_ids, "contig_id", "left_semi")).withColumn("ord", F.col("ord.ord")), "best-raw")
    profile = H.undetermined(rest, depths, best_raw, lengths, cutoffs.sirna)
    return Identified(known, novel, rest, first.summary.unionByName(second.summary), first.report.unionByName(second.report), best_raw, first.kept.unionByName(second.kept), first, second, profile)
