"""Near-duplicate line removal by a segment-partition edit join, in DataFrame functions only.

A line of at least ``MIN_CHARS`` characters is removed if it equals an earlier
line, or if an earlier distinct line lies within ``THRESHOLD`` edits of it.
Order is document id (null last), then the text's hash, then line number.
``MIN_CHARS`` is the least length the segments allow; shorter lines (at most twice
as many characters as edits allowed) always stay, exact copies included.

1. Equal lines are one node, found by hash with map-side minima; text isn't moved.
   Nodes are numbered in that order by a range sort and written.
2. *Segments*: a line is cut into threshold + 1 even segments; of a line within
   the threshold at least one segment is unchanged.  Keys are (length, segment
   number, segment hash).  A line also probes the segments of lines that are up
   to ``THRESHOLD`` shorter, at just the starts where an alignment could put them.
   A key row is the key, the line's number and its role; rows whose key no other
   line has are left out where they meet, the others form *blocks* and are written.
3. *Earliest first*: each line of a block is compared with the block's earliest
   line.  One earlier line within the threshold is all it takes, so of a block of
   near copies next to nothing is left after as many comparisons as it has lines.
4. *Rest*: lines that are still open meet the other lines of their blocks.
5. Before pairs are compared, their letter counts are: an edit changes them by
   two in sum at most.  The counts (modulo 4, in Gray code) of 31 letters fit one
   long, and the set bits of two such longs' difference are a lower bound.
6. Pairs are verified with a banded bit-parallel edit distance: one machine word
   holds the band of the column's vertical differences, a step handles a column.

Each step's result is a written table, so a lost executor costs a step's share
of one step.  Document text crosses the network by document key, once for the
keys, once for the lines of blocks and once for the result; each time its shuffle
files are deleted when the step has been written.

Edge cases: a null text stays null, an empty one empty; line feeds alone separate
lines; rows equal in id and text are one document and keep the same lines;
a document may lose all its lines (its text is then empty); an empty table gives
no rows; other columns are carried along unchanged by :func:`dedup_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, written

THRESHOLD = 2
MIN_CHARS = 2 * THRESHOLD + 1
#: 31 letters: what a line's Gray-coded counts are taken of.
_LETTERS = " etaonisrhdlcumgpbfvwykjxqz,.éS"
_LAST = (1 << 63) - 1


def _probes(t: int) -> list[tuple[int, int, int, int]]:
    """(gap, segment, shift, role): role 1 is an own segment; role 0 a place where a segment of a line that is ``gap`` shorter may stand."""
    out = []
    for gap in range(t + 1):
        for i in range(t + 1):
            for shift in range(max(-i, gap - (t - i)), min(i, gap + (t - i)) + 1):
                out.append((gap, i, shift, int(not gap and not shift)))
    return out


def line_keys(lines: DataFrame, t: int, least: int) -> DataFrame:
    """``key, node`` for each segment and probe of the lines (``nid``, ``line``, ``n`` characters); node is twice the number, plus one for an own segment.

    A line is cut into t + 1 segments, the last ones longer by one.  The probes
    are a literal list that each line is spread over; key and place are then
    plain expressions of a compiled stage."""
    specs = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("gap", "i", "shift", "role"), p, strict=True))) for p in _probes(t)))
    spread = lines.select("nid", "line", "n", F.explode(specs).alias("p")).select("nid", "line", "n", "p.*")
    other = F.col("n") - F.col("gap")
    short = F.expr(f"(n - gap) div {t + 1}").cast("int")
    first_long = F.lit(t + 1) - other % (t + 1)
    start = short * F.col("i") + F.greatest(F.lit(0), F.col("i") - first_long) + F.col("shift")
    size = short + (F.col("i") >= first_long).cast("int")
    spread = spread.where((other >= least) & (start >= 0) & (start + size <= F.col("n")))
    return spread.select(F.xxhash64(other, "i", F.substring("line", start + 1, size)).alias("key"), (F.shiftleft("nid", 1) + F.col("role")).alias("node"))


def letter_counts(line: Column) -> Column:
    """Counts (modulo 4) of 31 letters in Gray code, two bits each: the distance of two counts is at least that of the bits."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(_LETTERS):
        gone = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
        n = F.shiftright(gone, len(c.encode()) - 1).bitwiseAND(3)  # letters of one or two bytes
        out = out.bitwiseOR(F.shiftleft(n.bitwiseXOR(F.shiftright(n, 1)).cast("long"), 2 * i))
    return out


def edit_distance(a: Column, b: Column, t: int) -> Column:
    """Distance of two strings (arrays of characters) of more than t characters each, lengths at most t apart; larger than t if it isn't within t.

    Bit k of a word is row j - t + k of column j, so the band slides with the
    column.  The distance is followed down the band's lowest diagonal to the last
    row, then along that row.  A column's matches come first, as an array of
    words; the state is one long: column, distance, VN and VP."""
    width = 2 * t + 1
    mask = (1 << width) - 1
    m, n = F.size(a), F.size(b)
    at_d, at_j = 2 * width, 2 * width + 8

    def matches(c: Column, i: Column) -> Column:
        return sum((F.when((i - t + k >= 0) & (F.get(a, i - t + k) == c), F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)), F.lit(0)).cast("long")

    def column(s: Column, x: Column) -> Column:
        vp, vn = s.bitwiseAND(mask), F.shiftright(s, width).bitwiseAND(mask)
        d0 = ((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(mask)

        def rest(d0: Column) -> Column:
            hp, hn = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(mask)), d0.bitwiseAND(vp)
            half = F.shiftright(d0, 1)
            j = F.shiftright(s, at_j).cast("int")
            row = m - j + t  # bit of the last row once it is in the band
            bit = lambda w: F.call_function("shiftright", w, row).bitwiseAND(1)
            moved = F.when(j + t <= m, F.lit(1).cast("long") - F.shiftright(d0, width - 1)).otherwise(bit(hp) - bit(hn))
            new_vp, new_vn = hn.bitwiseOR(F.bitwise_not(half.bitwiseOR(hp)).bitwiseAND(mask)), half.bitwiseAND(hp)
            d = F.least(F.shiftright(s, at_d).bitwiseAND(255) + moved, F.lit(250).cast("long"))  # far beyond t nothing matters
            return F.shiftleft((j + 1).cast("long"), at_j) + F.shiftleft(d, at_d) + F.shiftleft(new_vn, width) + new_vp

        return F.get(F.transform(F.array(d0), rest), 0)  # names d0, which is needed four times

    start = F.lit((1 << at_j) + (t << at_d) + (mask & ~((1 << t) - 1))).cast("long")
    return F.aggregate(F.transform(b, matches), start, column, lambda s: F.shiftright(s, at_d).bitwiseAND(255).cast("int"))


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key and row of each document."""
    row = F.array(F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns))))
    return documents.select(*_key(id_col, text_col), row.alias("row"))


def _key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("k1"), F.xxhash64(F.col(f"`{text_col}`")).alias("k2")]


def _field(documents: DataFrame, name: str) -> Column:
    number = documents.columns.index(name)
    return F.get(F.transform("row", lambda r: r[f"c{number}"]), 0)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _fetched(documents: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``nid, line`` of the wanted places (k1, k2, pos, nid).

    Never by broadcast: the planner takes places for as small as their file, which packs them well."""
    places = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "nid")).alias("places"))  # at most a document's lines
    texts = documents.where(F.col(f"`{text_col}`").isNotNull()).select(*_key(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    # the lines get a name, or the text would be split for each of the places
    picked = F.transform(F.array(_lines(F.col("text"))), lambda lines: F.transform("places", lambda p: F.struct(p["nid"].alias("nid"), F.get(lines, p["pos"]).alias("line"))))
    return texts.join(places.hint("merge"), ["k1", "k2"]).select(F.explode(F.get(picked, 0)).alias("w")).select("w.nid", "w.line")


def nodes(documents: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """``nid, k1, k2, pos``: the distinct long lines at their first places, numbered in order."""
    # what stands beside a generator is computed for each of its rows, so keys and arrays come before it
    split = documents.where(F.col(f"`{text_col}`").isNotNull()).select(*_key(id_col, text_col), _lines(F.col(f"`{text_col}`")).alias("l"))
    long = split.select("k1", "k2", F.posexplode_outer("l").alias("pos", "line")).where(F.length("line") >= min_chars)
    first = long.groupBy(F.xxhash64("line").alias("id"), F.hash("line").alias("id2"), F.length("line").alias("size")).agg(F.min(F.struct("k1", "k2", "pos")).alias("f"))
    first = written(first.select("f.k1", "f.k2", "f.pos"), "first-lines")  # the range sort reads it twice
    numbered = first.repartitionByRange("k1", "k2", "pos").sortWithinPartitions("k1", "k2", "pos").select(F.monotonically_increasing_id().alias("nid"), "k1", "k2", "pos")
    out = written(numbered, "lines")
    discard(first)
    return out


def blocks(lines: DataFrame, t: int, min_chars: int) -> DataFrame:
    """``key, nid, role`` of all keys that several lines have, one of them as an own segment."""
    rows = line_keys(lines.select("nid", "line", F.length("line").alias("n")), t, min_chars)
    block = Window.partitionBy("key")
    met = rows.select("key", "node", F.count("*").over(block).alias("n"), F.max(F.col("node").bitwiseAND(1)).over(block).alias("own"))
    return met.where("n > 1 AND own = 1").select("key", F.shiftright("node", 1).alias("nid"), F.col("node").bitwiseAND(1).alias("role")).distinct()  # rows equal in id and text give equal rows


def _near(pairs: DataFrame, texts: DataFrame, t: int) -> DataFrame:
    """``nid`` of the later lines (b) of pairs (a, b) within the threshold."""
    counts = texts.select("nid", "n", "counts")
    ends = [counts.select(*(F.col(c).alias(f"{c}_{e}") for c in counts.columns)) for e in "ab"]
    likely = pairs.join(ends[0], F.col("a") == F.col("nid_a")).join(ends[1], F.col("b") == F.col("nid_b"))
    likely = likely.where((F.abs(F.col("n_a") - F.col("n_b")) <= t) & (F.bit_count(F.col("counts_a").bitwiseXOR(F.col("counts_b"))) <= 2 * t)).select("a", "b")
    # lines are joined as they are: split into characters, they are a hundred times what the planner reads off the file, and a broadcast of them fills the driver
    text = lambda e: texts.select(F.col("nid").alias(e), F.col("line").alias(f"line_{e}")).hint("merge")
    both = likely.join(text("a"), "a").join(text("b"), "b")
    # the characters get a name: split in the filter, they would be for every step of the distance
    chars = F.struct(*(F.split(f"line_{e}", "").alias(f"c{e}") for e in "ab"))
    distance = F.get(F.transform(F.array(chars), lambda x: edit_distance(x["ca"], x["cb"], t)), 0)
    return both.where(distance <= t).select(F.col("b").alias("nid")).distinct()


def kept_lines(documents: DataFrame, *, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k1, k2, stay``: by document key, the numbers of the long lines that stay."""
    t = threshold
    if min_chars <= 2 * t:
        raise ValueError("lines to compare must have more than twice as many characters as edits allowed")
    lines = nodes(documents, min_chars, id_col, text_col)
    block = written(blocks(_fetched(documents, lines, id_col, text_col), t, min_chars), "line-blocks")
    asked = lines.join(block.select("nid").distinct(), "nid")
    texts = written(_fetched(documents, asked, id_col, text_col).select("nid", "line", F.length("line").alias("n"), letter_counts(F.col("line")).alias("counts")).dropDuplicates(["nid"]), "block-lines")

    hubs = written(block.groupBy("key").agg(F.min(F.struct("nid", "role")).alias("hub")).select("key", F.col("hub.nid").alias("hub"), F.col("hub.role").alias("hub_role")), "block-hubs")
    star = block.join(hubs, "key").where("nid > hub AND role + hub_role > 0").select(F.col("hub").alias("a"), F.col("nid").alias("b")).distinct()
    near = written(_near(star, texts, t), "near-first")
    rest = block.join(near, "nid", "left_anti").join(texts.select("nid", "n", "counts"), "nid")
    open_ = rest.join(hubs, "key").where("nid > hub").select("key", F.col("nid").alias("b"), F.col("role").alias("role_b"), F.col("counts").alias("counts_b"), "hub")
    others = block.join(texts.select("nid", "counts"), "nid").select("key", F.col("nid").alias("a"), F.col("role").alias("role_a"), F.col("counts").alias("counts_a"))
    close = F.bit_count(F.col("counts_a").bitwiseXOR(F.col("counts_b"))) <= 2 * t
    met = (F.col("a") < F.col("b")) & (F.col("a") > F.col("hub")) & (F.col("role_a") + F.col("role_b") > 0) & close
    pairs = open_.withColumnRenamed("key", "key_b").join(others, (F.col("key") == F.col("key_b")) & met).select("a", "b").distinct()
    late = written(_near(pairs, texts, t), "near-rest")
    discard(block, hubs, texts)
    stay = lines.join(near.union(late), "nid", "left_anti").groupBy("k1", "k2").agg(F.collect_list("pos").alias("stay"))
    return stay.hint("merge")


def _rest(text: Column, stay: Column, min_chars: int) -> Column:
    """The lines that stay, in order, as an array."""
    held = F.coalesce(stay, F.array().cast("array<int>"))

    def rest(lines: Column) -> Column:
        short = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.length(F.get(lines, i)) < min_chars)
        return F.transform(F.sort_array(F.concat(held, short)), lambda i: F.get(lines, i))

    return F.get(F.transform(F.array(_lines(text)), rest), 0)


def dedup(documents: DataFrame, *, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` (what is left), ``n_lines`` and ``n_removed``."""
    source = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    stay = kept_lines(source, threshold=threshold, min_chars=min_chars)
    docs, text = _keyed(source, "doc_id", "text"), _field(source, "text")
    rest = docs.join(stay, ["k1", "k2"], "left").select(_field(source, "doc_id").alias("doc_id"), F.size(_lines(text)).alias("n"), _rest(text, F.col("stay"), min_chars).alias("rest"))
    known = F.col("rest").isNotNull()
    n, kept = F.when(known, F.col("n")).otherwise(0), F.when(known, F.size("rest")).otherwise(0)
    return rest.select("doc_id", F.array_join("rest", "\n").alias("text"), n.cast("long").alias("n_lines"), (n - kept).cast("long").alias("n_removed"))


def dedup_documents(documents: DataFrame, *, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", with_size: str | None = None) -> DataFrame:
    """The documents with all their columns, ``text`` without the removed lines; the column ``with_size``, if any, gets the new length."""
    stay = kept_lines(documents, threshold=threshold, min_chars=min_chars, id_col=id_col, text_col=text_col)
    docs = _keyed(documents, id_col, text_col)
    text = F.array_join(_rest(_field(documents, text_col), F.col("stay"), min_chars), "\n")
    out = docs.join(stay, ["k1", "k2"], "left").select(*((text if c == text_col else _field(documents, c)).alias(c) for c in documents.columns))
    return out.withColumn(with_size, F.length(F.col(f"`{text_col}`")).cast(documents.schema[with_size].dataType)) if with_size else out


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
