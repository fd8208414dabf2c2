"""Prefix trie of conversations: which openings are shared, by how many, and what storing them once saves.

Method
------
1. *Order.*  Turns are numbered inside their conversation from a range
   partitioning by (conversation, turn, role, text digest); a conversation's parts
   are joined by adding up the sizes of the ones before, so one that holds a third
   of all turns is spread over many tasks.
2. *Digests.*  A prefix is known by a SHA-256 digest.  Turns are folded in blocks
   of ``BLOCK``; the digests of whole blocks are folded alike, level by level, and a
   turn's prefix is the digest of the blocks before its own and its place in it.
   No group is larger than a block.
3. *Minima.*  One aggregate by digest gives each prefix's smallest conversation and
   its members.  A conversation *owns* the depths at which it is the smallest member,
   and once it owns one, it owns all deeper ones.
4. *Search.*  Every conversation's first owned depth is found by binary search: all
   conversations look up the digest at their own middle depth in one join with the
   minima and go on in the half that remains, as many rounds as the longest
   conversation needs to be halved.
5. *Chains.*  A conversation's owned depths are a chain of nodes that hangs from the
   node above its first, which another conversation owns.  Chains are far fewer than
   nodes; their totals are summed bottom-up, each round passing them to ancestors
   twice as far away, so a tree of height h takes log h rounds.  Sums along a chain
   are taken in blocks, too.
6. *Ends.*  The ids that end at a node are packed in order by range partitions and
   their packs hashed one after another: no list of a node's ids is held anywhere.

Edge cases: turns of a null conversation belong to none and are left out; a null
turn number is first, equal ones follow their role and the SHA-256 of their text;
repeated rows are turns of their own; a null role or text is empty; an empty table
gives no rows; text ids are cast to long and must be numbers; other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, written

BLOCK = 256
FAMILY = 20  # fixed value: conversations that share an opening
OPENING = 4  # fixed value: an opening has fewer turns than this
PACK = 256
WORD = r"[^\x20\x09-\x0D]+"


def _sha(x: Column) -> Column:
    return F.unhex(F.sha2(x, 256))


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, n, digest, words``: the turns of each conversation, numbered from 1; the texts themselves travel no further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), F.sha2(text.cast("binary"), 256).alias("tie"),
        _sha(F.concat(size, F.lit(":"), role, text).cast("binary")).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv_id", F.col("at").asc_nulls_first(), "role", "tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.select("conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), "turns")
    parts = rows.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "conv_id", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = written(rows.join(parts, ["part", "conv_id"]).select("conv_id", (F.col("place") + F.col("shift")).alias("n"), "digest", "words"), "turns")
    discard(rows)
    return numbered


def rebuilt(own: DataFrame, family: int = FAMILY, opening: int = OPENING) -> tuple[DataFrame, DataFrame]:
    """Turns ``c, d, digest, words`` (d from 1) and conversations ``c, size`` once each has its family's opening."""
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % opening
    convs = sizes.select(F.col("conv_id").alias("c"), "n", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), head.alias("h"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(base, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = written(convs.select("c", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "conversations")
    rest = own.join(convs.select(F.col("c").alias("conv_id"), "h", "lent"), "conv_id").where("n > h")
    rest = rest.select(F.col("conv_id").alias("c"), (F.col("n") - F.col("h") + F.col("lent")).alias("d"), "digest", "words")
    first = own.where(F.col("n") < opening).select(F.col("conv_id").alias("base"), "n", "digest", "words")
    lent = first.join(convs.select("c", "base", "h"), "base").where("n <= h").select("c", F.col("n").alias("d"), "digest", "words")
    return rest.union(lent), convs.select("c", "size")


def prefixes(rows: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """``c, i, prefix`` from ``c, i, digest`` (i from 0, gapless): the digest of each conversation's first i + 1 digests."""
    part = F.floor(F.col("i") / block).alias("part")
    inside = F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"])
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)), F.unhex(F.lit("")))
    folded = F.aggregate("inside", F.array().cast("array<binary>"), lambda acc, x: F.concat(acc, F.array(_sha(F.concat(last(acc), x)))))
    parts = rows.groupBy("c", part).agg(inside.alias("inside")).select("c", "part", folded.alias("local"))
    if longest <= block:
        return parts.select("c", F.posexplode("local").alias("i", "prefix")).select("c", F.col("i").cast("long").alias("i"), "prefix")
    parts = written(parts, "prefix-blocks")
    whole = parts.where(F.size("local") == block).select("c", F.col("part").alias("i"), F.element_at("local", -1).alias("digest"))
    upper = prefixes(whole, longest // block, block).select("c", (F.col("i") + 1).alias("part"), F.col("prefix").alias("before"))
    joined = parts.join(upper, ["c", "part"], "left").select("c", "part", "before", F.posexplode("local").alias("j", "prefix"))
    prefix = F.when(F.col("before").isNull(), F.col("prefix")).otherwise(_sha(F.concat("before", "prefix")))
    return joined.select("c", (F.col("part") * block + F.col("j")).alias("i"), prefix.alias("prefix"))


def first_owned(paths: DataFrame, minima: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """``c, size, first``: the depth from which a conversation is the smallest member of its prefixes (size + 1: never)."""
    state = written(convs.select("c", "size", F.lit(0).cast("long").alias("low"), (F.col("size") + 1).alias("high")), "search")
    owners = minima.select("d", "prefix", "conv_id")
    for _ in range((longest + 1).bit_length()):
        probes = state.where("low < high").select("c", F.floor((F.col("low") + F.col("high")) / 2).alias("d"))
        seen = probes.join(paths.select("c", "d", "prefix"), ["c", "d"]).join(owners, ["d", "prefix"]).select("c", F.col("d").alias("middle"), (F.col("conv_id") == F.col("c")).alias("owned"))
        low = F.when(~F.col("owned"), F.col("middle") + 1).otherwise(F.col("low"))
        high = F.when(F.col("owned"), F.col("middle")).otherwise(F.col("high"))
        state, used = written(state.join(seen, "c", "left").select("c", "size", F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high")), "search"), state
        discard(used)
    return state.select("c", "size", F.col("low").alias("first"))


def subtree_sums(chains: DataFrame, *values: str) -> DataFrame:
    """``c`` with the sums of ``values`` over the chain and all below it; ``chains``: c, up (null: none) and the values.

    Each round adds up what chains hold at their ancestors twice as far away as in the round before."""
    state = written(chains.select("c", "up", *values), "chains")
    while state.where("up IS NOT NULL").limit(1).count():
        given = state.where("up IS NOT NULL").groupBy("up").agg(*(F.sum(v).alias(f"more_{v}") for v in values))
        above = state.select(F.col("c").alias("up"), F.col("up").alias("next"))
        sums = state.join(given.withColumnRenamed("up", "c"), "c", "left").join(above, "up", "left")
        state, used = written(sums.select("c", F.col("next").alias("up"), *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values)), "chains"), state
        discard(used)
    return state.select("c", *values)


def sums_below(nodes: DataFrame, *values: str, block: int = BLOCK) -> DataFrame:
    """Each value summed from its node to the end of the chain: inside blocks of depths, plus the blocks after."""
    part = nodes.withColumn("part", F.floor(F.col("depth") / block))
    totals = part.groupBy("conv_id", "part").agg(*(F.sum(v).alias(f"all_{v}") for v in values))
    after = Window.partitionBy("conv_id").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select("conv_id", "part", *(F.coalesce(F.sum(f"all_{v}").over(after), F.lit(0)).alias(f"all_{v}") for v in values))
    down = Window.partitionBy("conv_id", "part").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = part.select(*(F.sum(v).over(down).alias(v) if v in values else v for v in part.columns))
    return inside.join(later, ["conv_id", "part"]).select(*((F.col(v) + F.col(f"all_{v}")).alias(v) if v in values else v for v in nodes.columns))


def ends_hashed(ends: DataFrame) -> DataFrame:
    """``d, prefix, ends_sha256`` from ``d, prefix, c``: SHA-256 of the ascending ids, comma-joined."""
    order = ["d", "prefix", "c"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def flush() -> None:
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def taken() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.string()), strict=True)], names=["d", "prefix", "first", "ids"])

        for batch in batches:
            for d, prefix, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (d, prefix) != node or len(ids) == PACK:
                    flush()
                    node = (d, prefix)
                ids.append(c)
            yield taken()
        flush()
        yield taken()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for d, prefix, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (d, prefix) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (d, prefix), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("d", "prefix", "ends_sha256"), x, strict=True)) for x in done], schema=out)
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip(("d", "prefix", "ends_sha256"), (*node, state.hexdigest()), strict=True))], schema=out)

    out = pa.schema([("d", pa.int64()), ("prefix", pa.binary()), ("ends_sha256", pa.string())])
    packs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, "d long, prefix binary, first long, ids string")
    return packs.repartition("d", "prefix").sortWithinPartitions("d", "prefix", "first").select("d", "prefix", "ids").mapInArrow(hashed, "d long, prefix binary, ends_sha256 string")


def trie(conversations: DataFrame, *, family: int = FAMILY, opening: int = OPENING, block: int = BLOCK) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    own = turns(conversations)
    rows, convs = rebuilt(own, family, opening)
    longest = convs.agg(F.max("size")).first()[0] or 0
    rows = written(rows.withColumn("i", F.col("d") - 1), "rebuilt")
    folded = prefixes(rows.select("c", "i", "digest"), longest, block)
    paths = rows.select("c", "i", "d", "words").join(folded, ["c", "i"]).select("c", "d", "prefix", "words")
    root = convs.select("c", F.lit(0).cast("long").alias("d"), F.unhex(F.lit("")).alias("prefix"), F.lit(0).cast("long").alias("words"))
    paths = written(paths.union(root), "paths")
    discard(own, rows)
    minima = written(paths.groupBy("d", "prefix").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words")), "minima")
    found = first_owned(paths, minima, convs, longest)

    # chains and what they hang from
    chains = found.where("first <= size")
    above = chains.where("first > 0").select("c", (F.col("first") - 1).alias("d")).join(paths.select("c", "d", "prefix"), ["c", "d"]).join(minima.select("d", "prefix", F.col("conv_id").alias("up")), ["d", "prefix"])
    chains = written(chains.join(above.select("c", "up", F.col("d").alias("hung")), "c", "left"), "chain-heads")
    worth = minima.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    held = worth.groupBy(F.col("conv_id").alias("c")).agg(F.sum("saved").alias("saved"))
    topped = chains.where("up IS NOT NULL").select(F.col("up").alias("c"), F.col("hung").alias("size")).distinct().withColumn("leaf", F.lit(0).cast("long"))
    own_sums = chains.join(held, "c").join(topped, ["c", "size"], "left").select("c", "up", "saved", F.coalesce("leaf", F.lit(1)).alias("leaves"))
    sums = subtree_sums(own_sums, "saved", "leaves")
    hanging = chains.where("up IS NOT NULL").select("c", F.col("up").alias("conv_id"), F.col("hung").alias("depth")).join(sums, "c")
    hanging = hanging.groupBy("conv_id", "depth").agg(F.count("*").alias("branches"), F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))

    # nodes
    nodes = worth.select("conv_id", F.col("d").alias("depth"), "prefix", "n_convs", "saved").join(hanging, ["conv_id", "depth"], "left")
    nodes = nodes.join(chains.select(F.col("c").alias("conv_id"), "size", "first", "up"), "conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0))
    children = zero("branches") + (F.col("depth") < F.col("size")).cast("long")
    nodes = nodes.select(
        "conv_id", "depth", "prefix", "n_convs", F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), children.alias("n_children"),
        (zero("hung_leaves") + (children == 0).cast("long")).alias("n_leaves"), (zero("hung_saved") + F.col("saved")).alias("saved_tokens"),
    )
    nodes = sums_below(nodes, "n_leaves", "saved_tokens", block=block)
    ends = ends_hashed(paths.join(convs.select("c", F.col("size").alias("d")), ["c", "d"]))
    nodes = nodes.join(ends.withColumnRenamed("d", "depth"), ["depth", "prefix"], "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# unsigned CRC-32 of an id's decimal text, bit by bit
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(CAST(c AS VARCHAR), '')]), lambda a, b: list_reduce(list_prepend(xor(a, b), [z::BIGINT for z in range(8)]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"

ORACLE_SQL = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS n FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(struct_pack(r := role, t := text) ORDER BY n) AS w FROM t GROUP BY c),
k AS (SELECT c, c - c % {FAMILY} AS base, {_CRC} % {OPENING} AS h, w FROM l),
r AS (SELECT k.c, list_concat(coalesce(b.w[1 : k.h], []), k.w[k.h + 1 :]) AS w FROM k LEFT JOIN l b ON b.c = k.base),
p AS (SELECT c, len(w) AS size, d, w[1 : d] AS w FROM r, unnest(range(0, len(w) + 1)) AS u(d)),
node AS (SELECT w, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '') AS ends FROM p GROUP BY w, d),
x AS (SELECT *, (n_convs - 1) * len(regexp_extract_all(coalesce(w[d].t, ''), '[^\x20\x09-\x0D]+')) AS saved FROM node),
up AS (SELECT x.*, y.conv_id AS parent_conv_id FROM x LEFT JOIN x y ON x.d = y.d + 1 AND x.w[1 : y.d] = y.w),
kids AS (SELECT y.conv_id, y.d, count(*) AS n_children FROM x JOIN x y ON x.d = y.d + 1 AND x.w[1 : y.d] = y.w GROUP BY 1, 2),
whole AS (SELECT x.w, x.conv_id, x.d, x.saved, coalesce(n_children, 0) AS n_children FROM x LEFT JOIN kids ON kids.conv_id = x.conv_id AND kids.d = x.d),
sub AS (SELECT a.conv_id, a.d, sum(b.saved) AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves FROM x a JOIN whole b ON b.d >= a.d AND b.w[1 : a.d] = a.w GROUP BY 1, 2)
SELECT up.conv_id, CAST(up.d AS BIGINT) AS depth, up.parent_conv_id, up.n_convs, whole.n_children, sub.n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, sha256(up.ends) AS ends_sha256
FROM up JOIN whole ON whole.conv_id = up.conv_id AND whole.d = up.d JOIN sub ON sub.conv_id = up.conv_id AND sub.d = up.d"""
