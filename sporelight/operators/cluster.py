"""Similarity clusters of sequences, longest first, and removal of duplicates found by a search against themselves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement
from ..store import written
from . import refindex, search
from .extension import least_penalties

_CELLS = 1 << 22


def _edits(n: Column, identity: float) -> Column:
    return F.floor(n * (1 - identity) + 1e-9).cast("int")


def _verified(identity: float):
    """Arrow batches of ``a, b, text (longer), oriented (shorter), diagonal`` to the pairs within the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, longer, shorter, diagonal = (c.to_pylist() for c in batch.columns)
            good = []
            by_size: dict[int, list[int]] = {}
            for i, text in enumerate(shorter):
                by_size.setdefault(len(text), []).append(i)
            for size, rows in by_size.items():
                edits = int(size * (1 - identity) + 1e-9)
                pad = 2 * edits + 1  # a lane's middle is within half the edits of the seed, the alignment within the edits of that
                step = max(1, _CELLS // (size * (2 * pad + 1) + 1))
                for lo in range(0, len(rows), step):
                    some = rows[lo : lo + step]
                    windows = []
                    for i in some:
                        at, n = diagonal[i] - pad, size + 2 * pad
                        windows.append((chr(0) * min(max(-at, 0), n) + longer[i][max(at, 0) : max(at + n, 0)]).ljust(n, chr(0)))
                    left = np.frombuffer("".join(shorter[i] for i in some).encode("latin-1", "replace"), np.uint8).reshape(len(some), size)
                    right = np.frombuffer("".join(windows).encode("latin-1", "replace"), np.uint8).reshape(len(some), size + 2 * pad)
                    good += [some[j] for j in np.flatnonzero(least_penalties(left, right, pad) <= edits).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])

    return run


def similar_pairs(records: DataFrame, identity: float = 0.95) -> DataFrame:
    """``a, b`` (places, distinct): b lies in the longer (or equally long, earlier) a, on either strand, with edits of at most ``1 - identity`` of its length.

    So few edits leave a stretch of b unchanged whose minimizer the index surely finds
    (:mod:`.refindex`); each lane of diagonals that a seed names is then verified by
    alignment.  No pair is missed and none is taken on an estimate."""
    rows = records.select("ord", F.upper("sequence").alias("u")).where("u <> ''").withColumn("n", F.length("u"))
    rows = rows.withColumn("edits", _edits(F.col("n"), identity))
    spans = [r.s for r in rows.select(F.floor((F.col("n") - F.col("edits")) / (F.col("edits") + 1)).alias("s")).distinct().collect()]  # at most as many as there are lengths
    schemes = refindex.schemes_for(spans, 0)
    if not schemes:
        return rows.select(F.col("ord").alias("a"), F.col("ord").alias("b")).limit(0)
    index = refindex.build(rows.select(F.col("ord").cast("string").alias("seq_id"), F.col("u").alias("sequence")), schemes)
    both = rows.withColumn("strand", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("oriented", F.when(F.col("strand") == 1, reverse_complement(F.col("u"))).otherwise(F.col("u")))
    # the index names longest spans by a read's own length; what is unchanged here depends on the length too
    probes = both.withColumn("span", F.floor((F.col("n") - F.col("edits")) / (F.col("edits") + 1)).cast("int"))
    seeds = refindex.read_seeds(probes.select("ord", "n", "edits", "strand", "span", "oriented"), index.schemes, 0, "span").drop("oriented", "span")
    hits = refindex.seed_hits(seeds, index).withColumn("a", F.col("seq_id").cast("long"))
    sizes = rows.select(F.col("ord").alias("a"), F.col("n").alias("na"))
    hits = hits.join(sizes, "a").where("na > n OR na = n AND a < ord")
    lanes = hits.select("a", F.col("ord").alias("b"), "strand", (F.floor((F.col("at") - F.col("place")) / (F.col("edits") + 1)) * (F.col("edits") + 1) + F.floor(F.col("edits") / 2)).alias("diagonal")).distinct()
    pairs = lanes.join(rows.select(F.col("ord").alias("a"), F.col("u").alias("longer")), "a").join(both.select(F.col("ord").alias("b"), "strand", "oriented"), ["b", "strand"])
    return pairs.select("a", "b", "longer", "oriented", "diagonal").mapInArrow(_verified(identity), "a long, b long").distinct()


def representatives(records: DataFrame, identity: float = 0.95) -> DataFrame:
    """Records that no longer (or equally long, earlier) representative covers at the identity; empty ones stay.

    Greedy choice, longest first, is the kernel of that acyclic graph, settled round by round."""
    from .hits import kernel

    edges = written(similar_pairs(records, identity).select(F.lit("all").alias("analysis"), F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")), "cluster-edges")
    nodes = records.select(F.lit("all").alias("analysis"), F.col("ord").cast("string").alias("group_id"))
    kept = kernel(nodes, edges).select(F.col("group_id").cast("long").alias("ord"))
    return records.join(kept, "ord", "left_semi")


def self_search_removals(found: DataFrame, lengths: DataFrame, identity: float = 95.0, coverage: float = 95.0, best: int = 2) -> DataFrame:
    """``id, partner, identity``: of two records that a search of all against all finds alike, the shorter goes.

    ``found``: ``ord, query, subject, identity, coverage`` (of the query) and ``score``; ``lengths``: ``id, length, place``.
    A record's hits are its ``best`` subjects by score, itself included; of equal lengths the later record goes.  A record
    goes once, for the partner of greatest score; partners may themselves go for a longer one."""
    by = Window.partitionBy("query")
    subjects = found.groupBy("query", "subject").agg(F.min(F.struct((-F.col("score")).alias("s"), "ord", "identity", "coverage")).alias("x"))
    top = subjects.withColumn("_r", F.row_number().over(by.orderBy("x.s", "x.ord"))).where((F.col("_r") <= best) & (F.col("query") != F.col("subject")))
    alike = top.where((F.col("x.identity") >= identity) & (F.col("x.coverage") >= coverage))
    size = lambda c: lengths.select(F.col("id").alias(c), F.col("length").alias(f"{c}_n"), F.col("place").alias(f"{c}_at"))
    both = alike.join(size("query"), "query").join(size("subject"), "subject")
    # a hit is reported from the query; it is the shorter one that goes, whichever of the two was searched with
    shorter = (F.col("query_n") < F.col("subject_n")) | ((F.col("query_n") == F.col("subject_n")) & (F.col("query_at") > F.col("subject_at")))
    gone = both.select(F.when(shorter, F.col("query")).otherwise(F.col("subject")).alias("id"), F.when(shorter, F.col("subject")).otherwise(F.col("query")).alias("partner"), "x.identity", "x.s", F.col("x.ord").alias("ord"))
    return gone.groupBy("id").agg(F.min(F.struct("s", "ord", "partner", "identity")).alias("x")).select("id", "x.partner", "x.identity")


def without_duplicates(records: DataFrame, shortest: int = 100, longest: int = 40_000, identity: float = 95.0, coverage: float = 95.0) -> tuple[DataFrame, DataFrame]:
    """Records that stay, and a removal table ``id, reason, partner``.

    Out of the length limits (reason: the length), an exact copy or reverse complement of an earlier record (``Dup``), or
    the shorter of two that a search of the rest against itself finds alike (``Search``)."""
    from ..functions.sequence import canonical, upper

    rows = records.withColumn("_n", F.coalesce(F.length("sequence"), F.lit(0)))
    inside = rows.where(F.col("_n").between(shortest, longest)).withColumn("_key", F.sha2(canonical(upper(F.col("sequence"))).cast("binary"), 256))
    first = inside.groupBy("_key").agg(F.min("ord").alias("_first"))
    inside = written(inside.join(first, "_key").drop("_key"), "deduplicate")
    unique = inside.where("ord = _first")
    found = search.search(unique, unique).select(F.monotonically_increasing_id().alias("ord"), F.col("qseqid").alias("query"), F.col("sseqid").alias("subject"), F.col("pident").alias("identity"), F.col("qcovs").alias("coverage"), F.col("bitscore").alias("score"))
    found = written(found, "self-search")
    gone = written(self_search_removals(found, unique.select(F.col("seq_id").alias("id"), F.col("_n").alias("length"), F.col("ord").alias("place")), identity, coverage), "self-search")
    firsts = unique.select(F.col("ord").alias("_first"), F.col("seq_id").alias("partner"))
    none = F.lit(None).cast("string")
    table = rows.where(~F.col("_n").between(shortest, longest)).select(F.col("seq_id").alias("id"), F.col("_n").cast("string").alias("reason"), none.alias("partner"))
    table = table.unionByName(inside.where("ord <> _first").join(firsts, "_first").select(F.col("seq_id").alias("id"), F.lit("Dup").alias("reason"), "partner"))
    table = table.unionByName(gone.select("id", F.lit("Search").alias("reason"), "partner"))
    kept = unique.join(gone.select(F.col("id").alias("seq_id")), "seq_id", "left_anti").select(*records.columns)
    return kept, table
