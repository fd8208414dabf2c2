"""Alignment records: alternative hits, best hits by read, unmapped reads, read aligner by seed join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import alternative_alignments, reverse_complement
from . import refindex
from .extension import Penalty, extender

KEPT_FLAGS = 0x6E9  # fixed value: flag bits an alternative alignment takes over from its record


def expand_alternatives(sam: DataFrame) -> DataFrame:
    """Each record, followed by one for each item of its XA list; ``alt`` numbers them from 0."""
    flag = F.expr("try_cast(flag AS INT)")
    turned = F.coalesce(flag.bitwiseAND(16) > 0, F.lit(False))
    fields = ("flag", "rname", "pos", "mapq", "cigar", "tlen", "seq", "qual", "nm")

    def other(x: Column) -> Column:
        back = x["pos"] < 0
        flip = turned != back
        values = {
            "flag": F.coalesce(flag, F.lit(0)).bitwiseAND(KEPT_FLAGS).bitwiseOR(F.when(back, 16).otherwise(0)).cast("string"),
            "rname": x["rname"], "pos": F.abs(x["pos"]), "mapq": F.lit("0"), "cigar": x["cigar"], "tlen": F.lit("0"),
            "seq": F.when(flip, reverse_complement(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(flip, F.reverse("qual")).otherwise(F.col("qual")), "nm": x["nm"],
        }
        return F.struct(*(values[f].alias(f) for f in fields))

    rows = F.concat(F.array(F.struct(*fields)), F.transform(alternative_alignments(F.col("xa")), other))
    out = sam.select("ord", "qname", "rnext", "pnext", F.posexplode(rows).alias("alt", "x"))
    return out.select("ord", "alt", "qname", "x.flag", "x.rname", "x.pos", "x.mapq", "x.cigar", "rnext", "pnext", "x.tlen", "x.seq", "x.qual", "x.nm")


def best_alignments(sam: DataFrame, max_distance: int = 2, consecutive: bool = True) -> DataFrame:
    """Records at their read's least edit distance below ``max_distance``.

    ``consecutive``: a read's records count together only where they follow each other in the source."""
    by = ["ord", "alt"] if "alt" in sam.columns else ["ord"]
    mapped = sam.where("flag <> '4'")
    checked = F.when(F.col("nm").isNull(), F.raise_error(F.concat(F.lit("alignment without NM tag: "), "qname")).cast("int")).otherwise(F.col("nm"))
    mapped = mapped.withColumn("nm", checked)
    if not consecutive:
        least = F.min(F.when(F.col("nm") < max_distance, F.col("nm"))).over(Window.partitionBy("qname"))
        return mapped.withColumn("_least", least).where("nm = _least").drop("_least")
    # a record's place among all (mapped) ones less its place among its own read's is constant along a run
    mapped = with_place(mapped.withColumn("_key", F.struct(*by)), "_key").drop("_key")
    own = F.row_number().over(Window.partitionBy("qname").orderBy("_place"))
    mapped = mapped.withColumn("_run", F.col("_place") - own)
    least = F.min(F.when(F.col("nm") < max_distance, F.col("nm"))).over(Window.partitionBy("qname", "_run"))
    return mapped.withColumn("_least", least).where("nm = _least").drop("_least", "_run", "_place")


def with_place(df: DataFrame, key: str) -> DataFrame:
    """Adds ``_place``, the rank by a unique key, without sorting everything in one task: range partitions, then offsets."""
    from ..store import written

    spread = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_m", F.monotonically_increasing_id())
    spread = written(spread, "placed")
    part = F.shiftright("_m", 33)
    counts = sorted((r.p, r.n) for r in spread.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # a row for each partition
    firsts, total = [], 0
    for p, n in counts:
        firsts.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(firsts or [(0, 0)], "_part long, _offset long")
    return spread.withColumn("_part", part).join(F.broadcast(table), "_part").withColumn("_place", F.col("_offset") + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_part", "_offset", "_m")


def mapped_reads(best: DataFrame) -> int:
    return best.select("qname").distinct().count()


def unmapped_reads(sam: DataFrame) -> DataFrame:
    """``ord, header, sequence`` of records whose flag is just 4."""
    return sam.where("flag = '4'").select("ord", F.col("qname").alias("header"), F.col("seq").alias("sequence"))


def cap_alternatives(alignments: DataFrame, n: int) -> DataFrame:
    """At most n alignments for each read, best first (an explicit feature of the aligner)."""
    rank = F.row_number().over(Window.partitionBy("qname").orderBy("nm", "rname", "pos", "flag"))
    return alignments.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def align(reads: DataFrame, references: DataFrame | None, distance: int = 1, penalty: Penalty | None = None, index: refindex.Index | None = None) -> DataFrame:
    """Alignments of whole reads within a penalty: ``qname, flag, rname, pos, cigar, seq, nm, score``.

    ``penalty`` defaults to ``distance`` differences of one each.  Seeds of each read and
    its reverse complement meet the index (:mod:`.refindex`; of ``references`` where none
    is given), each diagonal found is extended in its tile alone, and every alignment
    within the limit lies on a diagonal some seed finds.  A read so short that the limit
    could leave none of its bases unchanged isn't aligned."""
    penalty = penalty or Penalty(limit=distance)
    text = F.upper("sequence")
    named = reads.select(F.coalesce(F.get(F.split("header", r"\s+"), 0), F.lit("")).alias("qname"), text.alias("seq")).where(F.length("seq") > penalty.edits)
    if index is None:
        lengths = [r.n for r in named.select(F.length("seq").alias("n")).distinct().collect()]  # at most as many as a read has bases
        schemes = refindex.schemes_for(lengths, penalty.edits)
        reach = max([refindex.REACH, *(n + 2 * penalty.gap for n in lengths)])
        index = refindex.build(references, schemes, reach=reach)
    elif (longest := named.agg(F.max(F.length("seq"))).first()[0] or 0) + 2 * penalty.gap > index.reach:
        raise ValueError(f"a read of {longest} bases is longer than the index reaches ({index.reach})")
    both = named.withColumn("strand", F.explode(F.array(F.lit(0), F.lit(16))))
    both = both.select("qname", "strand", F.when(F.col("strand") == 16, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("oriented"))
    hits = refindex.seed_hits(refindex.read_seeds(both, index.schemes, penalty.edits), index)
    diagonals = hits.select("qname", "strand", "seq_id", "oriented", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    tile = F.floor(F.greatest(F.col("diagonal") - penalty.gap, F.lit(0)) / index.tile)
    windows = diagonals.withColumn("tile", tile).join(index.tiles, ["seq_id", "tile"]).select("qname", "strand", "seq_id", "oriented", "text", "begin", "diagonal")
    found = windows.mapInArrow(extender(penalty, 3), "qname string, strand int, seq_id string, oriented string, pos int, cigar string, nm int, score int")
    best = found.groupBy("qname", "strand", "seq_id", "pos").agg(F.min(F.struct("score", "nm", "cigar", "oriented")).alias("x"))
    return best.select("qname", F.col("strand").cast("string").alias("flag"), F.col("seq_id").alias("rname"), "pos", "x.cigar", F.col("x.oriented").alias("seq"), "x.nm", "x.score")


#: Host subtraction of longer reads: a mismatch, an unknown base and each base of a gap cost one.
HOST_PENALTY = Penalty(limit=5, mismatch=1, gap_open=0, gap_extend=1, other=1)


def subtract_host(reads: DataFrame, host: DataFrame | None, distance: int = 1, penalty: Penalty | None = None, index: refindex.Index | None = None) -> tuple[DataFrame, DataFrame]:
    """Reads that don't align to the host, and those that do; without a host nothing aligns."""
    if host is None and index is None:
        return reads, reads.limit(0)
    named = reads.withColumn("_name", F.coalesce(F.get(F.split("header", r"\s+"), 0), F.lit("")))
    names = align(reads, host, distance, penalty, index).select(F.col("qname").alias("_name")).distinct()
    return named.join(names, "_name", "left_anti").drop("_name"), named.join(names, "_name", "left_semi").drop("_name")
