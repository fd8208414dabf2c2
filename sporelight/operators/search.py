"""Similarity search in Spark: seeds by equi-join, local alignment with affine gaps in Arrow batches.

Protein words meet their neighbouring words (BLOSUM62) and need a second hit near
on the same diagonal.  Alignments have three states and a band that is widened
until the alignment stays clear of its edges.  Expectation values follow the
published gapped statistics with the lengths corrected for edge effects.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequence import kmers, reverse_complement

NUCLEOTIDE_WORD, PROTEIN_WORD = 11, 3
# Published gapped statistics (lambda, K, alpha, beta) of match 1, mismatch -2, 2.5 for each base of a gap, and of BLOSUM62 with 11 and 1.
NUCLEOTIDE_STATS, PROTEIN_STATS = (1.28, 0.46, 1.5, -2.0), (0.267, 0.041, 1.9, -30.0)
# The standard genetic code, codons in TCAG order.
_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
_BASES = "TCAG"
# The published BLOSUM62 matrix, a row for each residue up to itself; X and stops beside it.
_RESIDUES = "ARNDCQEGHILKMFPSTWYV"
_BLOSUM62 = """4
-1 5
-2 0 6
-2 -2 1 6
0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4"""
_UNKNOWN, _STOP = -1, -4
# Gap costs (opening, each base) in the units of the scores; nucleotide scores are doubled, as a gap costs 2.5 a base.
PROTEIN_GAP, NUCLEOTIDE_GAP = (11, 1), (0, 5)
NUCLEOTIDE_MATCH, NUCLEOTIDE_MISMATCH, NUCLEOTIDE_SCALE = 2, -4, 2
PROTEIN_DROP, NUCLEOTIDE_DROP = 65, 27  # 25 bits, in the units of the scores
NEIGHBOURS, TWO_HITS = 12, 40  # least score of a neighbouring word; greatest distance of two hits on a diagonal


def translate(seq: str) -> str:
    """Protein of a reading frame; unknown codons give X."""
    at = {b: i for i, b in enumerate(_BASES)}
    out = []
    for i in range(0, len(seq) - 2, 3):
        a, b, c = (at.get(x, -1) for x in seq[i : i + 3])
        out.append(_CODE[16 * a + 4 * b + c] if min(a, b, c) >= 0 else "X")
    return "".join(out)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("frame", T.IntegerType()), T.StructField("protein", T.StringType())])))
def six_frames(s: pd.Series) -> pd.Series:
    """Proteins of the six reading frames; frames -1 to -3 are those of the reverse complement."""
    back = str.maketrans("ACGT", "TGCA")

    def frames(x):
        if x is None:
            return []
        x = x.upper()
        turned = x.translate(back)[::-1]
        return [{"frame": f + 1, "protein": translate(x[f:])} for f in range(3)] + [{"frame": -f - 1, "protein": translate(turned[f:])} for f in range(3)]

    return s.map(frames)


def protein_scores() -> np.ndarray:
    """Score of each pair of residues by their character codes; letters beyond the twenty count as X."""
    table = np.full((128, 128), _UNKNOWN, np.int32)
    for i, row in enumerate(_BLOSUM62.split("\n")):
        for j, value in enumerate(row.split()):
            table[ord(_RESIDUES[i]), ord(_RESIDUES[j])] = table[ord(_RESIDUES[j]), ord(_RESIDUES[i])] = int(value)
    table[ord("*"), :] = table[:, ord("*")] = _STOP
    table[ord("*"), ord("*")] = 1
    return table


def neighbour_words(spark, threshold: int = NEIGHBOURS) -> DataFrame:
    """``kmer, near``: the words of three residues that score at least ``threshold`` against each other (8,000 words, whatever the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.frombuffer(_RESIDUES.encode(), np.uint8)
        one = protein_scores()[np.ix_(codes, codes)]
        words = np.array([a + b + c for a in _RESIDUES for b in _RESIDUES for c in _RESIDUES])
        for batch in batches:
            for w in batch.column(0).to_pylist():
                i, j, k = w // 400, w // 20 % 20, w % 20
                near = words[np.flatnonzero((one[i][:, None, None] + one[j][None, :, None] + one[k][None, None, :]).ravel() >= threshold)]
                yield pa.RecordBatch.from_arrays([pa.array([words[w]] * len(near), pa.string()), pa.array(near.tolist(), pa.string())], names=["kmer", "near"])

    return spark.range(20**3).mapInArrow(run, "kmer string, near string")


_CELLS = 1 << 23  # traceback cells held at once


def local_alignments(queries: list[str], subjects: list[str], protein: bool, band: int, diagonals: list[int]) -> list[tuple | None]:
    """Best local alignment (affine gaps) of each pair around its diagonal (subject start less query start).

    Gives score, query and subject ranges (from 0, ends exclusive) and both gapped
    texts, or None.  Pairs of like length advance together, a query position a step.
    ``band`` is what is tried first: a pair whose alignment reaches the band's edge, or
    that scores at the edge less than ``DROP`` below its best, is aligned again in a band
    twice as wide."""
    out: list[tuple | None] = [None] * len(queries)
    order, at = sorted(range(len(queries)), key=lambda p: -len(queries[p])), 0
    wider = []
    while at < len(order):
        size = max(1, _CELLS // (max(1, len(queries[order[at]])) * (2 * band + 1)))
        chosen = order[at : at + size]
        for p, found in zip(chosen, _banded([queries[p] for p in chosen], [subjects[p] for p in chosen], protein, band, [diagonals[p] for p in chosen]), strict=True):
            if found is not None:
                out[p], edge = found
                if edge and band < len(queries[p]) + len(subjects[p]):
                    wider.append(p)
        at += size
    if wider:
        for p, found in zip(wider, local_alignments([queries[p] for p in wider], [subjects[p] for p in wider], protein, 2 * band, [diagonals[p] for p in wider]), strict=True):
            out[p] = found
    return out


def local_alignment(query: str, subject: str, protein: bool, band: int, diagonal: int) -> tuple | None:
    return local_alignments([query], [subject], protein, band, [diagonal])[0]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.encode("latin-1", "replace") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    return np.frombuffer(b"".join(raw) + b"\0", np.uint8) & 127, np.cumsum(size) - size, size


_LOW = -(1 << 24)


def _banded(queries: list[str], subjects: list[str], protein: bool, band: int, diagonals: list[int]) -> list[tuple | None]:
    """An alignment and whether it touches the band's edge, for each pair; three states: pair, gap in the subject, gap in the query."""
    (first, more), table, width = PROTEIN_GAP if protein else NUCLEOTIDE_GAP, protein_scores() if protein else None, 2 * band + 1
    drop = PROTEIN_DROP if protein else NUCLEOTIDE_DROP
    (q, q_at, n), (s, s_at, m) = _codes(queries), _codes(subjects)
    diagonal, pairs, slot = np.array(diagonals, np.int64), len(queries), np.arange(width)
    score = np.zeros((pairs, width + 1), np.int32)
    score[:, width] = _LOW
    down = np.full((pairs, width + 1), _LOW, np.int32)  # gap in the subject: query letters alone
    trace = np.zeros((int(n.max(initial=0)), pairs, width), np.int8)  # 0-1: where the best comes from; 4: the subject's gap goes on; 8: the query's does
    best, row, column, edge = (np.zeros(pairs, np.int64) for _ in range(4))
    for i in range(len(trace)):
        live = int(np.searchsorted(-n, -i, side="left"))  # longest first
        at = (i + diagonal[:live] - band)[:, None] + slot
        inside = (at >= 0) & (at < m[:live, None])
        code = s[np.minimum(s_at[:live, None] + np.clip(at, 0, np.maximum(m[:live, None] - 1, 0)), len(s) - 1)]
        own = q[q_at[:live] + i][:, None]
        pair = table[own, code] if protein else np.where(code == own, NUCLEOTIDE_MATCH, NUCLEOTIDE_MISMATCH)
        # a pair stays in its slot; a query letter alone comes from the slot to the right of the row above
        along = score[:live, :width] + pair
        opened, longer = score[:live, 1:] - first - more, down[:live, 1:] - more
        alone = np.maximum(opened, longer)
        new = np.where(inside, np.maximum(0, np.maximum(along, alone)), _LOW)
        # subject letters alone, any number of slots: the best start to the left less its cost
        reach = np.maximum.accumulate(new + more * slot, axis=1)
        right = np.full((live, width), _LOW, np.int32)
        right[:, 1:] = reach[:, :-1] - first - more * slot[1:]
        goes_on = np.zeros((live, width), bool)
        goes_on[:, 2:] = right[:, 1:-1] - more >= new[:, 1:-1] - first - more
        whole = np.where(inside, np.maximum(new, right), _LOW)
        step = np.where(whole <= 0, 0, np.where(right > new, 3, np.where(along == new, 1, 2)))
        trace[i, :live] = step | (longer > opened).astype(np.int8) << 2 | goes_on.astype(np.int8) << 3
        score[:live, :width] = np.where(inside, whole, 0)
        down[:live, :width] = np.where(inside, alone, _LOW)
        edge[:live] = np.maximum(edge[:live], np.maximum(whole[:, 0], whole[:, -1]))
        top = whole.argmax(1)
        value = whole[np.arange(live), top]
        better = np.flatnonzero(value > best[:live])
        best[better], row[better], column[better] = value[better], i, top[better]
    near = (best > drop) & (edge >= best - drop)
    out = []
    for p in range(pairs):
        found, touches = _traced(trace[:, p], queries[p], subjects[p], int(best[p]), int(row[p]), int(column[p]), int(diagonal[p]) - band) if best[p] else (None, False)
        out.append((found, touches or bool(near[p])) if best[p] else None)
    return out


def _traced(trace: np.ndarray, query: str, subject: str, score: int, i: int, j: int, shift: int) -> tuple[tuple, bool]:
    q_end, s_end, q, h, state, edge = i + 1, i + shift + j + 1, [], [], 0, False
    while i >= 0 and 0 <= j < trace.shape[1]:
        cell = int(trace[i, j])
        move = state or cell & 3
        if not move:
            break
        edge |= j in (0, trace.shape[1] - 1)
        q.append("-" if move == 3 else query[i])
        h.append("-" if move == 2 else subject[i + shift + j])
        state = move if move == 2 and cell & 4 or move == 3 and cell & 8 else 0
        i, j = (i, j - 1) if move == 3 else (i - 1, j + (move == 2))
    q_text, h_text = "".join(reversed(q)), "".join(reversed(h))
    return (score, q_end - sum(c != "-" for c in q_text), q_end, s_end - sum(c != "-" for c in h_text), s_end, q_text, h_text), edge


def length_adjustment(m: Column, letters: Column, count: Column, protein: bool) -> Column:
    """Letters by which edge effects shorten a query of m letters and each of ``count`` subjects: the largest whole number
    that does not exceed beta + alpha / lambda * ln(K * (m - l) * (letters - count * l))."""
    lam, k, alpha, beta = PROTEIN_STATS if protein else NUCLEOTIDE_STATS
    room = F.greatest(F.least(m - 1, F.floor((letters - 1) / F.greatest(count, F.lit(1)))), F.lit(0)).cast("long")

    def step(a, _):
        middle = F.floor((a["low"] + a["high"] + 1) / 2).cast("long")
        fits = middle <= beta + alpha / lam * F.log(k * (m - middle) * (letters - count * middle))
        return F.struct(F.when(fits, middle).otherwise(a["low"]).alias("low"), F.when(fits, a["high"]).otherwise(F.greatest(middle - 1, a["low"])).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(F.lit(0).cast("long").alias("low"), room.alias("high")), step, lambda a: a["low"])


def with_statistics(rows: DataFrame, letters: Column, count: Column, protein: bool) -> DataFrame:
    """Rows (``score``, and ``m``, the letters searched with) with ``bitscore`` and ``evalue``."""
    lam, k, _, _ = PROTEIN_STATS if protein else NUCLEOTIDE_STATS
    sizes = rows.select("m").distinct().select("m", length_adjustment(F.col("m"), letters, count, protein).alias("_l"))
    space = F.greatest(F.col("m") - F.col("_l"), F.lit(1)).cast("double") * F.greatest(letters - count * F.col("_l"), F.lit(1))
    out = rows.join(sizes, "m")
    return out.withColumns({"bitscore": (lam * F.col("score") - math.log(k)) / math.log(2), "evalue": k * space * F.exp(-lam * F.col("score"))}).drop("_l")


_OUT = "qseqid string, qlen int, sseqid string, slen int, length int, pident double, evalue double, bitscore double, qstart int, qend int, sstart int, send int, qcovs double, qseq string, sseq string"


_RAW = "qseqid string, qlen int, sseqid string, slen int, length int, pident double, qstart int, qend int, sstart int, send int, qcovs double, qseq string, sseq string, m long, score double"


def _extended(protein: bool, band: int):
    scale = 1.0 if protein else float(NUCLEOTIDE_SCALE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [c.to_pylist() for c in batch.columns]
            aligned = local_alignments(columns[3], columns[4], protein, band, columns[6])
            for q_id, q_len, s_id, query, subject, frame, _, found in zip(*columns, aligned, strict=True):
                if found is None:
                    continue
                score, a, b, c, d, q_text, h_text = found
                same = sum(x == y and x != "-" for x, y in zip(q_text, h_text, strict=True))
                step, off = (3, abs(frame) - 1) if protein else (1, 0)
                start, end = off + a * step + 1, off + b * step
                if protein and frame < 0:
                    start, end = q_len - start + 1, q_len - end + 1
                lo, hi = (c + 1, d)
                if not protein and frame < 0:  # the query was turned: report it forward and the subject backward
                    start, end, lo, hi = q_len - end + 1, q_len - start + 1, d, c + 1
                rows.append((q_id, q_len, s_id, len(subject), len(q_text), 100.0 * same / len(q_text), start, end, lo, hi, 100.0 * (abs(end - start) + 1) / q_len, q_text, h_text, len(query), score / scale))
            columns = list(zip(*rows, strict=True)) or [[]] * 15
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.string(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _RAW.split(", ")])

    return run


def search(contigs: DataFrame, references: DataFrame, translated: bool = False, max_evalue: float = 1e-5, band: int = 12, word: int | None = None) -> DataFrame:
    """Tabular search rows (see ``schemas.SEARCH``) of contigs against nucleotide references, or proteins when ``translated``.

    Seeds are shared words; for proteins a query's word meets all its neighbouring
    words, and a seed counts if another one that does not overlap it lies at most
    ``TWO_HITS`` residues before it on the same diagonal.  Each (query frame, subject,
    band of diagonals) is extended once.  A frequent word's join is split by Spark's
    own skew handling; no word is dropped.  A query too short for two words that do
    not overlap has no hits."""
    k = word or (PROTEIN_WORD if translated else NUCLEOTIDE_WORD)
    refs = references.select("seq_id", F.upper("sequence").alias("subject"))
    facts = refs.agg(F.coalesce(F.sum(F.length("subject")), F.lit(0)).alias("letters"), F.count("*").alias("n")).first()
    base = contigs.select("seq_id", F.length("sequence").alias("qlen"), F.upper("sequence").alias("u"))
    if translated:
        frames = base.select("seq_id", "qlen", F.explode(six_frames("u")).alias("x")).select("seq_id", "qlen", F.col("x.frame").alias("frame"), F.col("x.protein").alias("query"))
    else:
        frames = base.select("seq_id", "qlen", F.explode(F.array(F.struct(F.lit(1).alias("frame"), F.col("u").alias("query")), F.struct(F.lit(-1).alias("frame"), reverse_complement(F.col("u")).alias("query")))).alias("x")).select("seq_id", "qlen", "x.frame", "x.query")
    words = frames.select("seq_id", "frame", F.explode(kmers(F.col("query"), k)).alias("w")).select("seq_id", "frame", F.col("w.kmer").alias("kmer"), F.col("w.start").alias("i"))
    theirs = refs.select(F.col("seq_id").alias("subject_id"), F.explode(kmers(F.col("subject"), k)).alias("w")).select("subject_id", F.col("w.kmer").alias("kmer"), F.col("w.start").alias("j"))
    if translated:
        near = F.broadcast(neighbour_words(contigs.sparkSession))  # of 8,000 words
        same = words.where(~F.col("kmer").rlike(f"^[{_RESIDUES}]{{{k}}}$"))  # with a stop or an unknown residue: only itself
        words = (words.join(near, "kmer").drop("kmer").withColumnRenamed("near", "kmer").unionByName(same) if k == PROTEIN_WORD else words)
    seeds = words.join(theirs, "kmer").withColumn("diagonal", F.col("j") - F.col("i"))
    if translated:
        along = Window.partitionBy("seq_id", "frame", "subject_id", "diagonal").orderBy("i").rangeBetween(-TWO_HITS, -k)
        seeds = seeds.withColumn("earlier", F.count("*").over(along)).where("earlier > 0")
    lanes = seeds.groupBy("seq_id", "frame", "subject_id", F.floor(F.col("diagonal") / band).alias("lane")).agg(F.percentile_approx("diagonal", 0.5).alias("diagonal"))
    pairs = lanes.join(frames, ["seq_id", "frame"]).join(refs.withColumnRenamed("seq_id", "subject_id"), "subject_id")
    raw = pairs.select("seq_id", "qlen", "subject_id", "query", "subject", "frame", "diagonal").mapInArrow(_extended(translated, band), _RAW)
    raw = raw.dropDuplicates(["qseqid", "sseqid", "qstart", "qend", "sstart", "send"])
    found = with_statistics(raw, F.lit(max(facts["letters"], 1)), F.lit(facts["n"]), translated).where(F.col("evalue") <= max_evalue)
    return found.select(*(x.split()[0] for x in _OUT.split(", ")))
