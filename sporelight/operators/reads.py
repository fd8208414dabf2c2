"""Reads: length filter, first-wins duplicates, data type, adapter trimming."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequence import read_lengths

LONG_READS = 36.0  # mean length from which reads are mRNA


def filter_lengths(reads: DataFrame, spec: str) -> DataFrame:
    return reads.where(F.length("sequence").isin(*sorted(read_lengths(spec))))


def drop_duplicates(reads: DataFrame) -> DataFrame:
    """The first read of each sequence; the aggregate combines map-side, so hot sequences don't meet in one task."""
    others = [c for c in reads.columns if c not in ("ord", "sequence")]
    first = reads.groupBy("sequence").agg(F.min(F.struct("ord", *others)).alias("x"))
    return first.select("x.ord", "sequence", *(f"x.{c}" for c in others)).select(*reads.columns)


def data_type(reads: DataFrame, first: int = 1000) -> str:
    """mRNA or sRNA by the mean length of the first reads."""
    mean = reads.orderBy("ord").limit(first).agg(F.avg(F.length("sequence"))).first()[0]
    if mean is None:
        raise ValueError("no reads")
    return "mRNA" if mean >= LONG_READS else "sRNA"


def length_histogram(alignments: DataFrame) -> DataFrame:
    """``contig_id, read_length, n`` of mapped records with a sequence and a numeric flag."""
    flag = F.expr("try_cast(flag AS INT)")
    ok = (F.col("rname") != "*") & (F.col("seq") != "*") & flag.isNotNull() & (flag.bitwiseAND(4) == 0)
    return alignments.where(ok).groupBy(F.col("rname").alias("contig_id"), F.length("seq").alias("read_length")).agg(F.count("*").alias("n"))


def length_map(histogram: DataFrame) -> DataFrame:
    """One sorted map length -> count for each contig."""
    return histogram.groupBy("contig_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("read_length", "n")))).alias("lengths"))


def _within(probe: str, distance: int) -> str:
    """Regular expression of the strings of the probe's length that differ from it in at most ``distance`` places."""
    if distance <= 0 or not probe:
        return "".join(map(re.escape, probe))
    if len(probe) <= distance:
        return f".{{{len(probe)}}}"
    return f"(?:{re.escape(probe[0])}{_within(probe[1:], distance)}|.{_within(probe[1:], distance - 1)})"


def three_prime_position(sequence: Column, adapter: str, distance: int = 1, seed: int = 11) -> Column:
    """Where the adapter's first bases stand (from 0): the first exact place, else the first with one mismatch, and so on; the read's length if nowhere.

    A place is the length of what stands before the first match, in one pass over the read for each distance."""
    probe = adapter[:seed].upper()
    n, exact = F.length(sequence), F.instr(sequence, probe)
    before = [F.length(F.get(F.split(sequence, f"(?s){_within(probe, d)}", 2), 0)) for d in range(1, distance + 1)]  # the read's length without a match
    out = F.when(exact > 0, exact - 1)
    for at in before[:-1]:
        out = out.when(at < n, at)
    return out.otherwise(before[-1] if before else n)


def _five_prime(adapter: str, short: int = 5, long: int = 9):
    """End of the 5' adapter: after the last long seed, or the chain of whole short-seed copies, whichever reaches further."""
    adapter = adapter.upper()
    seed, long_seed = adapter[-short:], adapter[-long:]

    def mismatches(a: str, b: str) -> int:
        return sum(x != y for x, y in zip(a, b, strict=False)) + abs(len(a) - len(b))

    def ends(seq: str, probe: str) -> Iterator[int]:
        at = seq.find(probe)
        while at >= 0:
            yield at + len(probe)
            at = seq.find(probe, at + len(probe))

    def place(seq: str | None) -> int:
        if not seq:
            return 0
        far = max(ends(seq, long_seed), default=0)
        if far and 21 <= len(seq) <= 24 and mismatches(seq[:far], adapter[-far:]) > 3:
            far = 0
        near = 0
        for end in ends(seq, seed):
            piece = seq[near:end]
            if mismatches(piece, adapter[-len(piece) :]) > 0:
                break
            near = end
        return max(far, near)

    @F.pandas_udf(T.IntegerType())
    def positions(s: pd.Series) -> pd.Series:
        return s.map(place)

    return positions


def trim(reads: DataFrame, adapter3: str | None = None, adapter5: str | None = None, distance: int = 1, min_length: int = 15) -> DataFrame:
    """Adds pos5, pos3, status3, status5, outcome (clean, baseN, short, rejected) and the trimmed sequence and quality.

    Reads may carry a ``sample`` column; sequences are upper-cased."""
    rows = reads.withColumn("sequence", F.upper("sequence"))
    n = F.length("sequence")
    rows = rows.withColumn("pos3", three_prime_position(F.col("sequence"), adapter3, distance) if adapter3 else n)
    rows = rows.withColumn("pos5", _five_prime(adapter5)(F.col("sequence")) if adapter5 else F.lit(0))
    rows = rows.withColumn("status3", F.when(F.col("pos3") == 0, "null").when(F.col("pos3") == n, "unmatch").otherwise("match") if adapter3 else F.lit(None).cast("string"))
    rows = rows.withColumn("status5", F.when(F.col("pos5") == 0, "unmatch").when(F.col("pos5") == n, "null").otherwise("match") if adapter5 else F.lit(None).cast("string"))
    usable = (F.col("pos3") > F.col("pos5")) & (F.coalesce("status3", F.lit("match")) == "match") & (F.coalesce("status5", F.lit("match")) != "null")
    size = F.col("pos3") - F.col("pos5")
    cut = lambda c: F.substring(c, F.col("pos5") + 1, size)
    outcome = F.when(~usable, "rejected").when(F.contains(cut(F.col("sequence")), F.lit("N")), "baseN").when(size < min_length, "short").otherwise("clean")
    rows = rows.withColumn("outcome", outcome).withColumn("trimmed", F.when(F.col("outcome") == "clean", cut(F.col("sequence"))))
    return rows.withColumn("trimmed_quality", F.when(F.col("outcome") == "clean", cut(F.col("quality")))) if "quality" in reads.columns else rows


def trim_report(trimmed: DataFrame) -> DataFrame:
    """Counters for each sample."""
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return trimmed.groupBy("sample").agg(F.count("*").alias("total"), is_("status3", "unmatch").alias("unmatch3"), is_("status3", "null").alias("null3"), is_("status3", "match").alias("match3"), is_("outcome", "baseN").alias("base_n"), is_("outcome", "short").alias("short"), is_("outcome", "clean").alias("cleaned"))


def size_table(trimmed: DataFrame, samples: list[str]) -> DataFrame:
    """Clean reads by trimmed length (rows) and sample (columns), 0 where there are none."""
    clean = trimmed.where("outcome = 'clean'").withColumn("size", F.length("trimmed"))
    return clean.groupBy("size").pivot("sample", samples).count().na.fill(0).orderBy("size")
