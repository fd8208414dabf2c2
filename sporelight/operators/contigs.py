"""Contig sets: combination, containment, statistics, assembly by k-mer graph."""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequence import canonical_digest, complement_codes, kmers, reverse_complement, upper, upper_codes
from ..store import discard, written
from .alignments import with_place

#: letters of the longest stretch; bits of the largest filter of asked words (64 MB), and its probes; positions compared at once
_STRETCH, _FILTER_BITS, _PROBES, _AT_ONCE = 4096, 1 << 29, 4, 1 << 18
#: letters of texts that are hashed together
_TOGETHER = 1 << 16
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def combine(*parts: DataFrame | None) -> DataFrame:
    """All records, part after part; missing parts don't count. ``ord`` is renumbered."""
    given = [p for p in parts if p is not None]
    if not given:
        raise ValueError("nothing to combine")
    rows = None
    for i, p in enumerate(given):
        more = p.select(F.struct(F.lit(i).alias("i"), "ord").alias("_at"), "header", "seq_id", "sequence")
        rows = more if rows is None else rows.unionByName(more)
    return with_place(rows, "_at").select(F.col("_place").alias("ord"), "header", "seq_id", "sequence")


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each."""
    out = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        x = np.full(n, np.uint64(base))
        x[0] = 1
        out.append(np.cumprod(x))
    return tuple(out)


def _hashes(x: np.ndarray) -> Callable[..., np.ndarray]:
    """A function of k (and of places, else all of them) to the hashes of a text's words of k letters, a word and its reverse complement counting as one."""
    up, down = _powers(1 << max(12, len(x).bit_length()))
    forward, back = np.zeros(len(x) + 1, np.uint64), np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * down[: len(x)], out=forward[1:])
    np.cumsum(complement_codes(x) * up[: len(x)], out=back[1:])

    def of(k, at: np.ndarray | None = None) -> np.ndarray:
        if at is None:
            n = len(x) - k + 1
            both = (forward[k:] - forward[:n]) * up[k - 1 : len(x)], (back[k:] - back[:n]) * down[:n]
        else:
            both = (forward[at + k] - forward[at]) * up[at + k - 1], (back[at + k] - back[at]) * down[at]
        mixed = [(h ^ (h >> np.uint64(29))) * _MIX for h in both]
        return np.minimum(*(h ^ (h >> np.uint64(32)) for h in mixed)).view(np.int64)

    return of


def _size(n: int, k: int) -> int:
    """Letters of the stretches that a record of n letters asks by: all if they are fewer than k, else a power of two (k at least) that goes 8 to 15 times into it, up to ``_STRETCH``."""
    return n if n < k else max(k, min(1 << max(n.bit_length() - 4, 0), _STRETCH))


def _asked(k: int, of_sequence: int):
    """Records with ``_n`` letters, hash ``_h`` and digest ``_k`` of either strand, and what they ask by: ``_size`` and the place and hash of the least word of each stretch."""

    def asks(x: np.ndarray, of) -> tuple[np.ndarray, np.ndarray]:
        size = _size(len(x), k)
        words = of(min(size, k))
        starts = np.append(np.arange(0, len(x) - size, size), len(x) - size)
        at = starts + np.lib.stride_tricks.sliding_window_view(words, size - min(size, k) + 1)[starts].argmin(axis=1)
        h, first = np.unique(words[at], return_index=True)
        return h, at[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                n, h, key, asked = [], [], [], []
                for text in batch.column(of_sequence).to_pylist():
                    x = upper_codes(text)
                    of = _hashes(x)
                    n.append(len(x))
                    h.append(int(of(len(x))[0]))
                    key.append(canonical_digest(x, iupac=False))
                    asked.append(asks(x, of))
                ends = np.append(0, np.cumsum([len(a) for a, _ in asked]))
                words = pa.StructArray.from_arrays([pa.array(np.concatenate([a for a, _ in asked])), pa.array(np.concatenate([o for _, o in asked]).astype(np.int32))], names=["h", "o"])
                more = [pa.array(n, pa.int32()), pa.array(h, pa.int64()), pa.array(key, pa.binary()), pa.array([_size(i, k) for i in n], pa.int32()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "_n", "_h", "_k", "_size", "_asks"])

    return run


def _mixed(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First place of a filter for the words of a size, and the step to the next ones (both to be masked)."""
    x = (h.view(np.uint64) ^ np.uint64(size * 0x9E3779B1)) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _BASE
    x ^= x >> np.uint64(29)
    return x, (x >> np.uint64(33)) | np.uint64(1)


def _let_through(h: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Which of the words of a size are in the filter."""
    mask, (x, step) = np.uint64(8 * len(known) - 1), _mixed(h, size)
    left = np.arange(len(h))
    for _ in range(_PROBES):
        at = (x & mask).astype(np.int64)
        ok = np.flatnonzero((known[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
        left, step = left[ok], step[ok]
        x = x[ok] + step
    return left


def _filter_of(words: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the ``size, h`` of n rows, 16 bits for each up to ``_FILTER_BITS``; parts of it are made in a few tasks and fetched one by one."""
    bits = min(max(1 << (16 * n).bit_length(), 1 << 16), _FILTER_BITS)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            sizes, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for s in np.unique(sizes):
                x, step = _mixed(h[sizes == s], int(s))
                for _ in range(_PROBES):
                    at = (x & np.uint64(bits - 1)).astype(np.int64)
                    np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
                    x = x + step
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(own, 1)], pa.binary())], names=["bits"])

    out = np.zeros(bits >> 3, np.uint8)
    for row in words.select("size", "h").coalesce(4).mapInArrow(part, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return out


def _offered(sizes: list[int], known: np.ndarray, k: int):
    """``ord, sequence`` to ``ord_b, n_b, size, h``: the least hashes of all stretches of the sizes that are in the filter; texts are hashed end to end, ``_TOGETHER`` letters at once."""
    words = sorted({min(s, k) for s in sizes})

    def of(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size the numbers of texts and their hashes."""
        lengths = np.array([len(t) for t in texts])
        x, ends = upper_codes("".join(texts)), np.cumsum(lengths)
        hashes, starts, longest = _hashes(x), ends - lengths, int(lengths.max())
        for word in words:
            if longest < word:
                break
            least, span = hashes(word), 1  # least of ``span`` words from each place; those beyond a text's end are left out below
            for size in [s for s in sizes if min(s, k) == word]:
                width = size - word + 1
                if longest < size:
                    break
                while 2 * span <= width:
                    least, span = np.minimum(least[:-span], least[span:]), 2 * span
                rest = width - span
                found = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
                new = np.append(True, found[1:] != found[:-1])
                new[starts[starts < len(new)]] = True
                at = np.flatnonzero(new)
                at = at[_let_through(found[at], size, known)]
                text = np.searchsorted(ends, at, "right")
                inside = at + size <= ends[text]
                text, h = text[inside], found[at[inside]]
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                once = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(h)]
                yield size, text[once], h[once]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                ords, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                lengths = np.array([len(t) for t in texts])
                cut = np.flatnonzero(np.diff(np.cumsum(lengths) // _TOGETHER)) + 1
                out = [(ords[i:j][text], lengths[i:j][text].astype(np.int32), np.full(len(h), size, np.int32), h) for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(texts)]) for size, text, h in of(texts[i:j])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["ord_b", "n_b", "size", "h"])

    return run


def _inside(k: int):
    """``sequence`` and the candidates ``c`` for it to the ``ord`` of those that it holds: around each place of the candidate's word its hash is compared, then its digest."""

    def held(x: np.ndarray, n: np.ndarray, size: np.ndarray, h: np.ndarray, o: np.ndarray, whole: np.ndarray, keys: list[bytes]) -> set[int]:
        of, found = _hashes(x), set()
        for word in np.unique(np.minimum(size, k)).tolist():
            mine = np.flatnonzero(np.minimum(size, k) == word)
            words = of(word)
            order = np.argsort(words, kind="stable")
            lo, hi = (np.searchsorted(words[order], h[mine], side) for side in ("left", "right"))
            ends = np.cumsum(hi - lo)
            for piece in range(0, int(ends[-1]), _AT_ONCE):  # a word may be at every place of a text
                place = np.arange(piece, min(piece + _AT_ONCE, int(ends[-1])))
                i = np.searchsorted(ends, place, "right")
                p, c = order[hi[i] - (ends[i] - place)], mine[i]
                for start in (p - o[c], p - (n[c] - word - o[c])):
                    able = (start >= 0) & (start + n[c] <= len(x))
                    s, own = start[able], c[able]
                    same = of(n[own], s) == whole[own]
                    for j, at in zip(own[same].tolist(), s[same].tolist()):
                        if j not in found and canonical_digest(x[at : at + n[j]], iupac=False) == keys[j]:
                            found.add(j)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                out = []
                for text, c in zip(batch.column(0), batch.column(1)):
                    cols = [c.values.field(i) for i in range(7)]
                    ords, n, size, h, o, hashes = (x.to_numpy() for x in cols[:6])
                    out.append(ords[sorted(held(upper_codes(text.as_py()), n.astype(np.int64), size, h, o.astype(np.int64), hashes, cols[6].to_pylist()))])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["ord"])

    return run


def drop_contained(records: DataFrame, k: int = 16) -> DataFrame:
    """Records that aren't, on either strand, part of a longer record (or of an equally long earlier one); empty ones go.

    Containment is transitive, so comparing with all longer records equals
    comparing with kept ones.  Equal sequences meet by their digests.  A record is cut
    into stretches of a power of two; all of them occur in its container, and so do
    the words of least hash in them, either strand's counting as one.  Containers
    offer the least words of all their stretches of that size, those that a filter
    of the asked ones lets through; a record then asks by the word that the fewest
    offer, so text that many records share brings no pairs where there is other text
    beside it.  That equi-join moves numbers only.  A container's text meets the list of
    its candidates once, whatever their number, and is compared with them by
    a hash and by the SHA-256 digest.  Records shorter than k ask by all their letters."""
    kind = T.StructType([*records.schema.fields, *T._parse_datatype_string("_n int, _h long, _k binary, _size int, _asks array<struct<h long, o int>>").fields])
    rows = written(records.where(F.length("sequence") > 0).mapInArrow(_asked(k, records.columns.index("sequence")), kind), "contained-rows")
    texts = rows.select(F.col("ord").cast("long").alias("ord"), "sequence")
    asked = rows.select(F.col("ord").cast("long").alias("ord"), F.col("_size").alias("size"), F.explode("_asks").alias("a")).select("ord", "size", "a.h", "a.o")
    first = rows.groupBy("_k").agg(F.min("ord").cast("long").alias("ord"), F.min("_n").alias("n"), F.min("_h").alias("whole"))
    sizes = sorted(r[0] for r in rows.select("_size").distinct().collect())  # k and ten more at most
    known = _filter_of(asked, asked.count())
    offered = written(texts.mapInArrow(_offered(sizes, known, k), "ord_b long, n_b int, size int, h long"), "contained-offered")
    counts = offered.groupBy("size", "h").agg(F.count("*").alias("c"), F.max("n_b").alias("longest"))
    rarest = asked.join(counts, ["size", "h"]).groupBy("ord").agg(F.min(F.struct("c", "size", "h", "o")).alias("a"), F.min("longest").alias("longest"))
    asking = rarest.join(first, "ord").where("longest > n").select("ord", "n", "a.size", "a.h", "a.o", "whole", F.col("_k").alias("key"))
    pairs = asking.join(offered, ["size", "h"]).where("n_b > n").groupBy("ord_b").agg(F.collect_list(F.struct("ord", "n", "size", "h", "o", "whole", "key")).alias("c"))
    found = texts.join(pairs, F.col("ord") == F.col("ord_b")).select("sequence", "c").mapInArrow(_inside(k), "ord long")
    held = written(found.distinct(), "contained-found")
    discard(offered)
    return rows.join(first.select("ord").join(held, "ord", "left_anti"), "ord", "left_semi").select(*records.columns).orderBy("ord")


def statistics(records: DataFrame) -> DataFrame:
    """One row of numbers over the records that aren't empty: numSeqs, numBases, numOK (all but N), numNs, minLen, avgLen, maxLen, n50_asc (cumulated from the shortest); 0 where there are none."""
    rows = records.select("sequence", F.length("sequence").alias("len")).where("len > 0")
    by_length = rows.groupBy("len").agg(F.count("*").alias("c"))  # a row for each length
    window = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)
    reached = by_length.withColumn("cum", F.sum(F.col("len") * F.col("c")).over(window)).withColumn("all", F.sum(F.col("len") * F.col("c")).over(Window.partitionBy()))
    half = reached.where(F.col("cum") * 2 >= F.col("all")).agg(F.min("len").cast("double").alias("n50_asc"))
    unknown = F.col("len") - F.length(F.translate("sequence", "Nn", ""))
    sums = rows.agg(F.count("*").cast("double").alias("numSeqs"), F.sum("len").cast("double").alias("numBases"), F.sum(F.col("len") - unknown).cast("double").alias("numOK"), F.sum(unknown).cast("double").alias("numNs"), F.min("len").cast("double").alias("minLen"), F.avg("len").alias("avgLen"), F.max("len").cast("double").alias("maxLen"))
    return sums.crossJoin(half).na.fill(0.0)  # one row by one row


def _words(k: int, letters: int = 1 << 21):
    """Arrow batches of texts to ``kmer, n``: words counted by slices of texts."""

    def counted(texts: list[str]) -> tuple[list[str], np.ndarray]:
        x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = np.unique(x)
        bits = max(1, int(len(seen) - 1).bit_length())
        if bits * k > 64 or (len(seen) and seen[0] == 0):  # too many letters for one number, or one that ends a numpy text
            plain = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
            return list(plain), np.array(list(plain.values()), np.int64)
        codes = np.zeros(int(seen[-1]) + 1, np.uint64)
        codes[seen] = np.arange(len(seen), dtype=np.uint64)
        codes, n = codes[x], len(x) - k + 1
        packed = np.zeros(n, np.uint64)
        for j in range(k):
            packed = (packed << np.uint64(bits)) | codes[j : j + n]
        ends = np.cumsum([len(t) for t in texts])
        left = np.repeat(ends, [len(t) for t in texts])[:n] - np.arange(n)  # letters to the end of the text
        words, counts = np.unique(packed[left >= k], return_counts=True)
        shifts = np.arange(k - 1, -1, -1, dtype=np.uint64) * np.uint64(bits)
        at = (words[:, None] >> shifts) & np.uint64((1 << bits) - 1)
        return np.ascontiguousarray(seen[at.astype(np.int64)]).view(f"<U{k}").ravel().tolist(), counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, size = [], 0
            texts = [t for t in batch.column(0).to_pylist() if t is not None and len(t) >= k]
            for i, t in enumerate(texts):
                some.append(t)
                size += len(t)
                if i == len(texts) - 1 or size >= letters:
                    words, counts = counted(some)
                    for lo in range(0, len(words), 1 << 17):
                        yield pa.RecordBatch.from_arrays([pa.array(words[lo : lo + (1 << 17)], pa.string()), pa.array(counts[lo : lo + (1 << 17)], pa.int64())], names=["kmer", "n"])
                    some, size = [], 0

    return run


def word_counts(texts: DataFrame, k: int) -> DataFrame:
    """``kmer, n``: words of k letters as they stand; a task sends a word once for each slice of its texts."""
    return texts.mapInArrow(_words(k), "kmer string, n long").groupBy("kmer").agg(F.sum("n").alias("n"))


def kmer_counts(reads: DataFrame, k: int) -> DataFrame:
    """``kmer, n`` over both strands (a k-mer and its reverse complement are one, named by the lesser)."""
    runs = reads.select(F.explode(F.regexp_extract_all(upper(F.col("sequence")), F.lit(f"[ACGT]{{{k},}}"), F.lit(0))).alias("run"))
    words = runs.select(F.explode(kmers(F.col("run"), k)).alias("w")).select(F.col("w.kmer").alias("kmer"))
    return words.groupBy(F.least("kmer", reverse_complement(F.col("kmer"))).alias("kmer")).agg(F.count("*").alias("n"))


def _ancestors(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``x, p, d, done``: the first node of each node's chain and the distance to it; not done are the nodes of cycles.

    Each round some chain's nodes get done, so the number of open ones falls until only cycles are left."""
    into = links.withColumnRenamed("x", "p").withColumnRenamed("y", "x")
    first = nodes.join(links.select(F.col("y").alias("x")), "x", "left_anti").select(F.col("x").alias("p"), F.lit(True).alias("head"))
    state = nodes.join(into, "x", "left").select("x", F.coalesce("p", "x").alias("p"), F.when(F.col("p").isNotNull(), 1).otherwise(0).cast("long").alias("d"))
    state = written(state.join(first, "p", "left").select("x", "p", "d", F.coalesce("head", F.lit(False)).alias("done")), "graph-state")
    open_, before = state.where("NOT done").count(), None
    while open_ and open_ != before:
        up = state.select(F.col("x").alias("p"), F.col("p").alias("pp"), F.col("d").alias("dd"), F.col("done").alias("up"))
        jumped = state.where("NOT done").join(up, "p").select("x", F.col("pp").alias("p"), (F.col("d") + F.col("dd")).alias("d"), F.col("up").alias("done"))
        state = written(state.where("done").unionByName(jumped), "graph-state")
        open_, before = state.where("NOT done").count(), open_
    return state


def _least_of_cycles(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``x, m``: the least node, either strand's, of the cycle that each node is on, by doubling the stretch looked at."""
    into = links.withColumnRenamed("x", "p").withColumnRenamed("y", "x")
    state, mark = written(nodes.join(into, "x").select("x", "p", F.least("x", "p", reverse_complement(F.col("x")), reverse_complement(F.col("p"))).alias("m")), "graph-cycles"), None
    while True:
        now = state.agg(F.sum(F.xxhash64("x", "m").cast("decimal(20,0)"))).first()[0]
        if now == mark:
            return state.select("x", "m")
        mark = now
        up = state.select(F.col("x").alias("p"), F.col("p").alias("pp"), F.col("m").alias("mm"))
        state = written(state.join(up, "p").select("x", F.col("pp").alias("p"), F.least("m", "mm").alias("m")), "graph-cycles")


def _opened(least: DataFrame, links: DataFrame) -> DataFrame:
    """The links of cycles, each cycle opened before its least node, or behind that node's reverse complement: both strands give one sequence."""
    own = least.where("x = m").select("m").distinct().withColumn("own", F.lit(True))
    known = links.join(least.withColumnRenamed("x", "y"), "y").join(own, "m", "left")
    return known.where((F.col("y") != F.col("m")) & (F.col("own").isNotNull() | (F.col("x") != reverse_complement(F.col("m"))))).select("x", "y")


def assemble_many(reads: DataFrame, sizes: list[int], long_reads: bool = False, min_coverage: int = 2, min_length: int = 30) -> DataFrame:
    """Contigs of several k-mer sizes together, without those that another one holds; long (mRNA) reads take the largest size only."""
    chosen = [max(31, *sizes)] if long_reads else sizes
    parts = [assemble(written(kmer_counts(reads, k), f"kmers-{k}"), k, min_coverage, min_length) for k in chosen]
    return drop_contained(combine(*parts))


def assemble(counts: DataFrame, k: int, min_coverage: int = 2, min_length: int = 30) -> DataFrame:
    """Unitigs of the de Bruijn graph of k-mers seen at least ``min_coverage`` times: ``ord, header, seq_id, sequence``.

    Both strands are nodes.  A link joins a k-mer to the only one that can follow
    it, if it is also the only one before that.  Chains are gathered by pointer
    jumping: each round doubles the distance to the known ancestor.  A cycle that
    nothing leads into, such as a circular genome, begins at its least k-mer."""
    nodes = counts.where(F.col("n") >= min_coverage).select(F.explode(F.array_distinct(F.array("kmer", reverse_complement(F.col("kmer"))))).alias("x"))
    nodes = written(nodes, "graph-nodes")
    left = nodes.select("x", F.substring("x", 2, k - 1).alias("o"))
    right = nodes.select(F.col("x").alias("y"), F.substring("x", 1, k - 1).alias("o"))
    alone = lambda df, c: df.groupBy("o").agg(F.count("*").alias("m"), F.min(c).alias(c)).where("m = 1").drop("m")
    links = written(alone(left, "x").join(alone(right, "y"), "o").where("x <> y").select("x", "y"), "graph-links")
    chained = _ancestors(nodes, links)
    # what never ends are whole cycles
    round_ = chained.where("NOT done").select("x")
    if not round_.isEmpty():
        chained = chained.where("done").unionByName(_ancestors(round_, written(_opened(_least_of_cycles(round_, links), links), "graph-links")))
    order = F.array_sort(F.collect_list(F.struct("d", "x")))
    chains = chained.groupBy("p").agg(order.alias("c")).select(F.concat(F.col("p"), F.array_join(F.transform(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda s: F.substring(s["x"], -1, 1)), "")).alias("sequence"))
    unique = chains.select(F.least("sequence", reverse_complement(F.col("sequence"))).alias("sequence")).distinct().where(F.length("sequence") >= min_length)
    placed = with_place(unique.withColumn("_at", F.struct(-F.length("sequence"), "sequence")), "_at")
    name = F.concat(F.lit("NODE_"), (F.col("_place") + 1).cast("string"))
    return placed.select(F.col("_place").alias("ord"), name.alias("header"), name.alias("seq_id"), "sequence")


def grid_search(sizes: list[int], objective, coverages=range(7, 26), first_coverage: int = 5) -> tuple[int, int]:
    """Best (k, coverage): each k at the first coverage, then the other coverages at the best k; the first of equals wins.

    ``objective(k, coverage)`` gives a number, or None for a failed run."""
    best, best_value = None, None
    for k in sizes:
        value = objective(k, first_coverage)
        if value is not None and (best_value is None or value > best_value):
            best, best_value = (k, first_coverage), value
    if best is None:
        raise ValueError("no assembly succeeded")
    for c in coverages:
        value = objective(best[0], c)
        if value is not None and value > best_value:
            best, best_value = (best[0], c), value
    return best


def assemble_best(reads: DataFrame, sizes: list[int], min_length: int = 30, long_reads: bool = False) -> DataFrame:
    """Assembly at the grid's best parameters by longest contig; fixed ones for long (mRNA) reads."""
    counts = {}

    def at(k: int, c: int) -> DataFrame:
        if k not in counts:
            counts[k] = written(kmer_counts(reads, k), f"kmers-{k}")
        return assemble(counts[k], k, c, min_length)

    if long_reads:
        return at(31, 10)
    longest = lambda k, c: at(k, c).agg(F.max(F.length("sequence"))).first()[0]
    return at(*grid_search(sizes, longest))
