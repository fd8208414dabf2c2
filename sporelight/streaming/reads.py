"""Streaming forms of the read operators (files arriving in a folder, or any stream of reads)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import read_lengths


def filtered(reads: DataFrame, spec: str) -> DataFrame:
    return reads.where(F.length("sequence").isin(*sorted(read_lengths(spec))))


def first_seen(reads: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """Reads whose sequence hasn't come before within the watermark; state expires with it."""
    return reads.withWatermark(time, delay).dropDuplicatesWithinWatermark(["sequence"])


def histogram(alignments: DataFrame) -> DataFrame:
    """Running counts of read lengths by contig (output mode complete or update)."""
    return alignments.where("rname <> '*' AND seq <> '*'").groupBy(F.col("rname").alias("contig_id"), F.length("seq").alias("read_length")).agg(F.count("*").alias("n"))


def windowed_counts(reads: DataFrame, time: str, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Reads and mean length by time window; late reads count until the watermark passes."""
    return reads.withWatermark(time, delay).groupBy(F.window(time, window).alias("w")).agg(F.count("*").alias("n"), F.avg(F.length("sequence")).alias("mean_length")).select(F.col("w.start").alias("start"), "n", "mean_length")
