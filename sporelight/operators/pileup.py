"""Pileups: coverage filter, consensus bases and contigs, depths; from text rows or straight from alignments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import discard, written
from . import refindex
from .alignments import with_place


def _starts(ref: pa.Array, follows: np.ndarray) -> np.ndarray:
    """Where stretches of one reference begin, if ``follows`` tells which rows but the first go on with the row before."""
    code = np.asarray(ref.dictionary_encode("encode").indices)
    return np.concatenate([[0], np.flatnonzero((code[1:] != code[:-1]) | ~follows) + 1])


def _steps(column: pa.Array) -> np.ndarray:
    """Differences of neighbours in a column of whole numbers; a null follows nothing."""
    return np.diff(column.cast(pa.int64()).fill_null(-(1 << 61)).to_numpy(zero_copy_only=False))


def _folded(rows: DataFrame) -> DataFrame:
    """``ord, ref_id, first, last, n, known, total, text``: rows (``ord, ref_id, pos, depth, base``) that follow each other where they lie, ``ord`` and ``pos`` growing by one.

    No other row can come between such rows, so only stretches need be sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, ref, pos, depth, base = batch.columns
                begin = _starts(ref, (_steps(at) == 1) & (_steps(pos) == 1))
                end = np.append(begin[1:], batch.num_rows)
                add = lambda x: pa.array(np.add.reduceat(x.cast(pa.int64()).to_numpy(zero_copy_only=False), begin))  # noqa: B023, E731
                base = pa.concat_arrays([base.cast(pa.string())])
                _, ends, letters = base.buffers()
                ends = np.frombuffer(ends, np.int32)[np.append(begin, batch.num_rows) + base.offset]
                text = pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends.tobytes()), letters or pa.py_buffer(b""))
                first = pa.array(begin)
                yield pa.RecordBatch.from_arrays([at.take(first), ref.take(first), pos.take(first), pos.take(pa.array(end - 1)), pa.array(end - begin), add(depth.is_valid()), add(depth.fill_null(0)), text], names=["ord", "ref_id", "first", "last", "n", "known", "total", "text"])

    rows = rows.select(F.col("ord").cast("long"), "ref_id", F.col("pos").cast("long"), F.col("depth").cast("long"), F.coalesce("base", F.lit("")).alias("base"))
    return rows.mapInArrow(run, "ord long, ref_id string, first long, last long, n long, known long, total long, text string")


def _packed(rows: DataFrame) -> DataFrame:
    """``_first, _last, _n, ref_id`` and the other columns as lists: rows of one reference that follow each other where they lie, ``ord`` growing."""
    others = [f for f in rows.schema.fields if f.name != "ref_id"]
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("_first", "_last", "_n")), rows.schema["ref_id"], *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in others)])
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, ref = batch.column("ord").cast(pa.int64()), batch.column("ref_id")
                begin = _starts(ref, _steps(at) > 0)
                ends = np.append(begin, batch.num_rows)
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column(c)) for c in names]
                first = pa.array(begin)
                yield pa.RecordBatch.from_arrays([at.take(first), at.take(pa.array(ends[1:] - 1)), pa.array(np.diff(ends)), ref.take(first), *lists], names=["_first", "_last", "_n", "ref_id", *names])

    return rows.mapInArrow(run, schema)


def _laid(stretches: DataFrame, first: str, last: str, n: str) -> tuple[DataFrame, bool]:
    """Adds ``_before``, how many rows come before a stretch in the whole order; and whether each stretch ends before the next begins.

    Stretches are sorted by range; a row for each partition goes to the driver."""
    i, j, k = (stretches.columns.index(c) for c in (first, last, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, reach = 0, np.iinfo(np.int64).min
        for batch in batches:
            if batch.num_rows:
                end, size = np.asarray(batch.column(j)), np.asarray(batch.column(k))
                reached = np.maximum.accumulate(np.append(reach, end))
                total = rows + np.cumsum(size)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total - size), pa.array(np.asarray(batch.column(i)) <= reached[:-1])], names=[*batch.schema.names, "_before", "_late"])
                rows, reach = int(total[-1]), reached[-1]

    schema = T.StructType([*stretches.schema.fields, T.StructField("_before", T.LongType()), T.StructField("_late", T.BooleanType())])
    laid = written(stretches.repartitionByRange(first).sortWithinPartitions(first).mapInArrow(run, schema).withColumn("_part", F.spark_partition_id()), "laid")
    facts = laid.groupBy("_part").agg(F.max(F.col("_before") + F.col(n)).alias("rows"), F.min(first).alias("first"), F.max(last).alias("last"), F.bool_or("_late").alias("late")).collect()
    before, total, reach, apart = [], 0, None, True
    for part in sorted(facts, key=lambda x: x["_part"]):
        apart &= not part["late"] and (reach is None or part["first"] > reach)
        before.append((part["_part"], total))
        total, reach = total + part["rows"], part["last"]
    table = laid.sparkSession.createDataFrame(before or [(0, 0)], "_part int, _rows long")
    return laid.join(F.broadcast(table), "_part").withColumn("_before", F.col("_before") + F.col("_rows")).drop("_part", "_rows", "_late"), apart


def filter_coverage(pileup: DataFrame, lengths: DataFrame, share: float = 0.3) -> DataFrame:
    """Rows of references' runs with more rows than ``share`` of the reference's length (``ref_id, length``; 0 if unknown).

    Rows stay packed as they lie; only stretches of them are sorted and counted. Where rows of different
    places lie mixed, they are sorted first."""
    packed = written(_packed(pileup), "packed")
    ends = ("_first", "_last", "_n")
    laid, apart = _laid(packed.select(*ends, "ref_id"), *ends)
    if not apart:
        discard(packed, laid)
        packed = written(_packed(pileup.repartitionByRange("ord").sortWithinPartitions("ord")), "packed")
        laid, _ = _laid(packed.select(*ends, "ref_id"), *ends)
    # along a run of one reference, a stretch's place among all rows and among the reference's own grow alike
    own = F.sum("_n").over(Window.partitionBy("ref_id").orderBy("_before").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    runs = laid.withColumn("_run", F.col("_before") - own)
    counted = runs.withColumn("_rows", F.sum("_n").over(Window.partitionBy("ref_id", "_run")))
    kept = counted.join(lengths, "ref_id", "left").where(F.col("_rows") > F.coalesce("length", F.lit(0)) * share)
    rows = packed.join(kept.select("_first"), "_first", "left_semi")
    return rows.select("ref_id", F.inline(F.arrays_zip(*(c for c in pileup.columns if c != "ref_id")))).select(*pileup.columns)


def mark_counts(rows: DataFrame, marks: str = "bases") -> tuple[DataFrame, dict[str, Column]]:
    """Rows with the counts of a pileup column's text, by built-in expressions, and the counts' columns by name.

    Marks: ``^x`` read start and its quality, ``$`` read end, ``+n..``/``-n..``
    indels, ``*`` deleted base, ``.``/``,`` match.  An indel's scan goes on n
    characters after its first digit, so the last bases of one of ten or more are
    read again as bases (kept for equal results)."""
    rows = rows.withColumn("_marks", F.upper(marks))
    rows = rows.withColumn("_rest", F.when(F.instr("_marks", "^") > 0, F.regexp_replace("_marks", r"(?s)\^.?", "")).otherwise(F.col("_marks")))
    token = r"(?s)([+-])(\d+)([^+-]*)"
    sign, digits, after = (F.regexp_extract_all("_rest", F.lit(token), F.lit(i)) for i in (1, 2, 3))
    found = F.transform(F.arrays_zip(sign.alias("s"), digits.alias("d"), after.alias("t")), lambda x: F.struct(x["s"].alias("s"), x["d"].cast("int").alias("n"), F.length(x["d"]).alias("digits"), x["t"].alias("t")))
    rows = rows.withColumn("_indels", F.when(F.col("_rest").rlike("[+-]"), found).otherwise(F.array().cast("array<struct<s:string,n:int,digits:int,t:string>>")))
    again = F.transform("_indels", lambda x: F.substring(x["t"], F.greatest(x["n"] - x["digits"] + 2, F.lit(1)), F.length(x["t"])))
    plain = F.concat(F.regexp_extract("_rest", r"(?s)^[^+-]*", 0), F.array_join(again, ""))
    inserted = F.transform(F.filter("_indels", lambda x: x["s"] == "+"), lambda x: F.substring(x["t"], 1, x["n"]))
    none = F.size("_indels") == 0
    rows = rows.withColumns({"_plain": F.when(none, F.col("_rest")).otherwise(plain), "_texts": F.when(none, F.array().cast("array<string>")).otherwise(inserted)})
    seen = lambda c: F.length("_plain") - F.length(F.replace("_plain", F.lit(c)))
    often = F.transform(F.array_distinct("_texts"), lambda x: F.struct(F.size(F.filter("_texts", lambda y: y == x)).alias("n"), x.alias("x")))
    first = F.aggregate(often, F.struct(F.lit(0).alias("n"), F.lit("").alias("x")), lambda a, x: F.when(x["n"] > a["n"], x).otherwise(a), lambda a: a["x"])
    starts = F.length("_marks") - F.length("_rest") - F.when(F.instr("_marks", "^") > 0, F.regexp_count("_marks", F.lit(r"(?s)\^."))).otherwise(0)
    values = {b.lower(): seen(b) for b in "ACGTN"} | {"same": seen(".") + seen(","), "deleted": seen("*"), "ends": seen("$"), "starts": starts, "inserted": F.size("_texts"), "usual": F.when(F.size("_texts") > 0, first).otherwise("")}
    rows = rows.withColumns({f"_{k}": v for k, v in values.items()}).drop("_rest", "_indels", "_plain", "_texts")
    return rows, {k: F.col(f"_{k}") for k in values}


def consensus_base(ref: Column, depth: Column, counts: dict[str, Column]) -> Column:
    """Consensus of one position: a base, a base and an insertion, or nothing (a deletion).

    ``counts``: ``a c g t n`` (where a base equals the reference, its number may be given as ``same``
    instead), ``deleted starts ends inserted`` and the ``usual`` insertion."""
    ref = F.upper(ref)
    total = depth + F.lit(0.00001)
    same = counts.get("same")
    votes = {b: counts[b.lower()] if same is None else F.when(ref == b, same).otherwise(counts[b.lower()]) for b in "ACGT"}
    top = F.greatest(*votes.values())
    winner = F.coalesce(*(F.when(v == top, F.lit(b)) for b, v in votes.items()))  # the first of equals
    share = lambda k, d: F.when(d > 0, k / d).otherwise(F.lit(0.0))
    best = share(top, total - counts["n"])
    gone = share(counts["deleted"], total - counts["starts"] - counts["ends"])
    base = F.when(gone > best, F.lit("")).when(top > 0, winner).otherwise(ref)
    return F.when(share(counts["inserted"], total - counts["ends"]) >= F.greatest(gone, best), F.concat(ref, F.coalesce(counts["usual"], F.lit("")))).otherwise(base)


def contigs(pileup: DataFrame, lengths: DataFrame, min_length: int = 40, min_depth: float = 0.0, prefix: str = "ALIGNED") -> DataFrame:
    """Consensus contigs of runs of consecutive positions: ``ord, header, seq_id, sequence``.

    Rows beyond the reference's length are skipped (but not the very first row);
    length counts positions; the last run's depth must exceed the cutoff, the
    others' must reach it; the header names the run's last position."""
    reach = written(pileup.groupBy("ref_id").agg(F.min("ord").alias("_first"), F.max("pos").alias("_reach")), "reach")
    first = reach.agg(F.min("_first")).first()[0]
    beyond = reach.join(lengths, "ref_id", "left").select("ref_id", F.coalesce("length", F.lit(0)).alias("length")).where(F.col("_reach") > F.col("length"))
    rows = pileup.where((F.col("ord") == F.lit(first)) | F.col("pos").isNotNull())
    if not beyond.isEmpty():  # else no row need meet its length
        length = F.coalesce("_length", "pos")
        over = beyond.select(F.col("ref_id").alias("_id"), F.col("length").alias("_length"))
        rows = rows.join(over, F.col("ref_id").eqNullSafe(F.col("_id")), "left").where((F.col("ord") == F.lit(first)) | (F.col("pos") <= length)).drop("_id", "_length")
    rows, counts = mark_counts(rows)
    stretches = written(_folded(rows.select("ord", "ref_id", "pos", "depth", consensus_base(F.col("ref_base"), F.col("depth"), counts).alias("base"))), "stretches")
    laid, _ = _laid(stretches.withColumn("_end", F.col("ord") + F.col("n") - 1), "ord", "_end", "n")
    # along a run of one reference, position and place grow alike
    laid = laid.withColumn("_run", F.col("_before") - F.col("first"))
    own = F.sum("n").over(Window.partitionBy("ref_id", "_run").orderBy("_before").rowsBetween(Window.unboundedPreceding, 0))
    runs = laid.withColumn("_own", F.col("_before") - own + F.col("n")).groupBy("ref_id", "_run", "_own").agg(
        F.min("_before").alias("_at"), F.max("last").alias("last"), F.sum("n").alias("n"), F.when(F.sum("known") > 0, F.sum("total")).alias("total"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "text"))), lambda x: x["text"]), "").alias("sequence")
    ).withColumnRenamed("_at", "first")
    runs = written(runs, "runs")
    discard(reach, stretches, laid)
    end = runs.agg(F.max("first")).first()[0]
    mean = F.col("total") / F.col("n")
    good = runs.where((F.col("n") > min_length) & F.when(F.col("first") == F.lit(end), mean > min_depth).otherwise(mean >= min_depth))
    named = with_place(good, "first").withColumn("seq_id", F.concat(F.lit(prefix), (F.col("_place") + 1).cast("string")))
    discard(runs)
    return named.select(F.col("_place").alias("ord"), F.concat_ws(" ", "seq_id", "ref_id", F.col("last").cast("string")).alias("header"), "seq_id", "sequence")


def _operations(alignments: DataFrame) -> DataFrame:
    """``rname, pos, seq, qname, flag, b``: each aligned, deleted or inserted stretch with its offsets on reference and read; ``b.reach``: reference bases of the whole alignment."""
    ops = F.regexp_extract_all("cigar", F.lit(r"(\d+[MIDNSHP=X])"), 1)
    parsed = F.transform(ops, lambda o: F.struct(F.regexp_extract(o, r"\d+", 0).cast("int").alias("n"), F.substring(o, -1, 1).alias("op")))
    kind = "array<struct<r:int,q:int,n:int,op:string>>"
    start = F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.array().cast(kind).alias("out"))

    def step(a, x):
        reads, moves = x["op"].isin("M", "=", "X", "I", "S"), x["op"].isin("M", "=", "X", "D", "N")
        more = F.when(x["op"].isin("M", "=", "X", "D", "I"), F.array(F.struct(a["r"].alias("r"), a["q"].alias("q"), x["n"].alias("n"), x["op"].alias("op")))).otherwise(F.array().cast(kind))
        return F.struct((a["r"] + F.when(moves, x["n"]).otherwise(0)).alias("r"), (a["q"] + F.when(reads, x["n"]).otherwise(0)).alias("q"), F.concat(a["out"], more).alias("out"))

    whole = F.aggregate(parsed, start, step, lambda a: F.struct(a["r"].alias("reach"), a["out"].alias("out")))
    named = [F.col(c) if c in alignments.columns else F.lit("").alias(c) for c in ("qname", "flag")]
    return alignments.select("rname", "pos", "seq", *named, whole.alias("w")).select("rname", "pos", "seq", "qname", "flag", F.col("w.reach").alias("reach"), F.explode("w.out").alias("b"))


def columns_of(alignments: DataFrame) -> DataFrame:
    """``rname, pos, base, starts, ends`` for each aligned or deleted ('*') position of each alignment (CIGAR M, =, X, D, N, I, S, H)."""
    cells = _operations(alignments).where("b.op <> 'I' AND b.n > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("b.n") - 1)).alias("i"))
    base = F.when(F.col("b.op") == "D", "*").otherwise(F.upper(F.substring(F.col("seq"), F.col("b.q") + F.col("i") + 1, 1)))
    at = F.col("b.r") + F.col("i")
    return cells.select("rname", (F.col("pos") + at).alias("pos"), base.alias("base"), (at == 0).alias("starts"), (at == F.col("reach") - 1).alias("ends"))


def _cells(cigar: str) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Of a CIGAR (M, =, X, D, N, I, S, H, P): offsets on reference and read (-1: deleted) of each position, and each insertion's offsets and length; the last offset is followed by the alignment's reach."""
    r = q = 0
    at, of, inserted = [], [], []
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
        if op in "M=XD":
            at += range(r, r + n)
            of += range(q, q + n) if op != "D" else [-1] * n
        elif op == "I":
            inserted.append((r, q, n))
        r += n if op in "M=XDN" else 0
        q += n if op in "M=XIS" else 0
    return np.array([*at, r], np.int64), np.array(of, np.int64), inserted


def _by_cigar(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, tuple]]:
    """The rows of each CIGAR of a batch with its cells; a batch has few of them."""
    codes = batch.column(column).dictionary_encode()
    number = np.asarray(codes.indices.fill_null(-1))
    order = np.argsort(number, kind="stable")
    ends = np.searchsorted(number[order], np.arange(len(codes.dictionary) + 1))
    for i, cigar in enumerate(codes.dictionary.to_pylist()):
        yield order[ends[i] : ends[i + 1]], _cells(cigar)


#: Which of A, C, G, T, N a byte is; 5 is a deletion, 6 anything else.
_KIND = np.full(256, 6, np.int64)
for _i, _c in enumerate("ACGTN"):
    _KIND[ord(_c)] = _KIND[ord(_c.lower())] = _i
_COUNTED = ("a", "c", "g", "t", "n", "deleted")


def _tallied(alignments: DataFrame) -> DataFrame:
    """Counts of :func:`depth_by_position` as far as each batch of alignments reaches."""
    names = ["rname", "pos", "depth", *_COUNTED, "starts", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names_of = batch.column(0).dictionary_encode()
            name, pos = np.asarray(names_of.indices).astype(np.int64), np.asarray(batch.column(1)).astype(np.int64)
            data, offsets = refindex.joined_bytes(pc.replace_substring_regex(batch.column(3), r"[^\x00-\x7F]", "?"))
            data, size = np.append(data, np.uint8(0)), np.diff(offsets)  # the last byte stands for what is beyond a read
            place, kind, edge = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for rows, (at, of, _) in _by_cigar(batch, 2):
                at, reach = at[:-1], at[-1]
                inside = (of >= 0) & (of < size[rows, None])
                seen = _KIND[data[np.where(inside, offsets[rows, None] + of, len(data) - 1)]]
                place.append(((name[rows, None] << 40) + pos[rows, None] + at + (1 << 39)).ravel())
                kind.append(np.where(of < 0, 5, seen).ravel())
                edge.append(np.tile((at == 0) + 2 * (at == reach - 1), len(rows)))
            place, group = np.unique(np.concatenate(place), return_inverse=True)
            kind, edge, n = np.concatenate(kind), np.concatenate(edge), len(place)
            if n:
                table = np.bincount(group * 7 + kind, minlength=7 * n).reshape(n, 7)
                edges = np.bincount(group * 4 + edge, minlength=4 * n).reshape(n, 4)
                columns = [table.sum(1), *(table[:, i] for i in range(6)), edges[:, 1] + edges[:, 3], edges[:, 2] + edges[:, 3]]
                yield pa.RecordBatch.from_arrays([names_of.dictionary.take(pa.array(place >> 40)), pa.array((place & ((1 << 40) - 1)) - (1 << 39), pa.int32()), *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns)], names=names)

    rows = alignments.where("rname IS NOT NULL AND pos IS NOT NULL AND cigar IS NOT NULL")
    return rows.select("rname", F.col("pos").cast("int"), "cigar", F.coalesce("seq", F.lit("")).alias("seq")).mapInArrow(run, "rname string, pos int, " + ", ".join(f"{c} long" for c in names[2:]))


def insertions_of(alignments: DataFrame) -> DataFrame:
    """``rname, pos, bases, first`` of each insertion, at the position before it; ``first`` orders the alignments (those before any position have none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, (_, _, inserted) in _by_cigar(batch, 2):
                own = batch.take(pa.array(rows))
                for r, q, n in inserted:
                    if r > 0:
                        pos = own.column(1)
                        yield pa.RecordBatch.from_arrays([own.column(0), pc.add(pos, pa.scalar(r - 1, pos.type)), pc.utf8_upper(pc.utf8_slice_codeunits(own.column(3), q, q + n)), pos, own.column(4), own.column(5)], names=["rname", "pos", "bases", "start", "qname", "flag"])

    named = [F.col(c) if c in alignments.columns else F.lit("").alias(c) for c in ("qname", "flag")]
    found = alignments.where(F.instr("cigar", "I") > 0).select("rname", F.col("pos").cast("int"), "cigar", "seq", *named).mapInArrow(run, "rname string, pos int, bases string, start int, qname string, flag string")
    return found.select("rname", "pos", "bases", F.struct(F.col("start").alias("pos"), "qname", "flag").alias("first"))


def depth_by_position(alignments: DataFrame) -> DataFrame:
    """``rname, pos, depth`` with counts of A, C, G, T, N, deletions, read starts and ends: aligned or deleted positions are added up batch by batch, so deep references don't skew."""
    return _tallied(alignments).groupBy("rname", "pos").agg(*(F.sum(c).alias(c) for c in ("depth", *_COUNTED, "starts", "ends")))


def insertions_by_position(alignments: DataFrame) -> DataFrame:
    """``rname, pos, inserted, usual``: insertions after a position and the most frequent one, of equals that of the first alignment.

    Equal insertions are added up before those of a position meet."""
    each = insertions_of(alignments).groupBy("rname", "pos", "bases").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    return each.groupBy("rname", "pos").agg(F.sum("n").alias("inserted"), F.min(F.struct((-F.col("n")).alias("n"), "first", "bases")).alias("x")).select("rname", "pos", "inserted", F.col("x.bases").alias("usual"))


def structured(alignments: DataFrame, references: DataFrame, tile: int = refindex.TILE) -> DataFrame:
    """``ref_id, pos, ref_base, depth, base``: typed counts of every covered position and their consensus, without any text of marks.

    A position's reference base comes from its tile, so no position carries a reference."""
    counts = depth_by_position(alignments).join(insertions_by_position(alignments), ["rname", "pos"], "left")
    tiled = refindex.tiles(references, tile, 0, 0).withColumnRenamed("seq_id", "rname")
    rows = counts.withColumn("tile", F.floor((F.col("pos") - 1) / tile)).join(tiled, ["rname", "tile"])
    ref = F.substring(F.col("text"), (F.col("pos") - F.col("begin")).cast("int"), F.lit(1))
    unknown = F.when(ref == "N", F.lit(0)).otherwise(F.col("n"))  # N beside N is a match
    votes = {c: F.col(c) for c in ("a", "c", "g", "t", "deleted", "starts", "ends", "usual")} | {"n": unknown, "inserted": F.coalesce("inserted", F.lit(0))}
    return rows.where(ref != "").select(F.col("rname").alias("ref_id"), "pos", ref.alias("ref_base"), F.col("depth").cast("int").alias("depth"), consensus_base(ref, F.col("depth"), votes).alias("base"))


def covered(positions: DataFrame, lengths: DataFrame, share: float = 0.3) -> DataFrame:
    """Positions of references with more covered positions than ``share`` of their length."""
    enough = positions.groupBy("ref_id").agg(F.count("*").alias("_n")).join(lengths, "ref_id", "left").where(F.col("_n") > F.coalesce("length", F.lit(0)) * share)
    return positions.join(enough.select("ref_id"), "ref_id", "left_semi")


def contigs_of(positions: DataFrame, min_length: int = 40, min_depth: float = 0.0, prefix: str = "ALIGNED", block: int = 1 << 16) -> DataFrame:
    """Consensus contigs of stretches of neighbouring positions: ``ord, header, seq_id, sequence`` as :func:`contigs` gives them, in order of reference and position.

    Stretches are found inside blocks of positions and joined where they touch, so a long reference isn't one task's."""
    blocked = positions.withColumn("_block", F.floor(F.col("pos") / block))
    row = F.row_number().over(Window.partitionBy("ref_id", "_block").orderBy("pos"))
    parts = blocked.withColumn("_run", F.col("pos") - row).groupBy("ref_id", "_block", "_run").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n"), F.sum("depth").alias("total"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("text")
    )
    along = Window.partitionBy("ref_id").orderBy("first")
    begins = F.coalesce((F.col("first") != F.lag("last").over(along) + 1).cast("int"), F.lit(1))
    joined = parts.withColumn("_begins", begins).withColumn("_stretch", F.sum("_begins").over(along))
    runs = joined.groupBy("ref_id", "_stretch").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "text"))), lambda x: x["text"]), "").alias("sequence"))
    runs = runs.withColumn("_at", F.struct("ref_id", "first"))
    end = runs.agg(F.max("_at")).first()[0]
    mean = F.col("total") / F.col("n")
    final = (F.col("ref_id") == F.lit(end["ref_id"])) & (F.col("first") == F.lit(end["first"])) if end else F.lit(False)
    good = runs.where((F.col("n") > min_length) & F.when(final, mean > min_depth).otherwise(mean >= min_depth))
    named = with_place(good, "_at").withColumn("seq_id", F.concat(F.lit(prefix), (F.col("_place") + 1).cast("string")))
    return named.select(F.col("_place").alias("ord"), F.concat_ws(" ", "seq_id", "ref_id", F.col("last").cast("string")).alias("header"), "seq_id", "sequence")


def contig_depths(positions: DataFrame, contigs_: DataFrame, library_size: int) -> DataFrame:
    """Depth of every contig from rows (ref_id, pos, depth); rows of unknown contigs are dropped, contigs without rows get zeros."""
    sums = positions.groupBy(F.col("ref_id").alias("contig_id")).agg(F.sum(F.col("depth").cast("long")).alias("total"), F.count_if(F.col("depth") > 0).cast("int").alias("covered"))
    rows = contigs_.select(F.col("seq_id").alias("contig_id"), F.length("sequence").alias("contig_length")).join(sums, "contig_id", "left")
    total = F.coalesce("total", F.lit(0)).cast("long")
    n = F.col("contig_length")
    mean = F.when(n > 0, total / n).otherwise(0.0)
    norm = F.when((n > 0) & F.lit(library_size > 0), total * F.lit(1e6) / (n * F.lit(float(max(library_size, 1))))).otherwise(0.0)
    return rows.select("contig_id", "contig_length", F.coalesce("covered", F.lit(0)).alias("covered_bases"), total.alias("total_depth"), mean.alias("mean_depth"), norm.alias("normalized_depth"))
