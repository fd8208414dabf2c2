"""Secret scan with multipart credential linking, in DataFrame functions only.

Base findings (leftmost, non-overlapping by kind; those too short are dropped):
``assign`` a secret's name, a sign and a value of 8+ characters; ``access`` an
AKIA identifier of 16+ characters; ``hex`` a run of 32+ lower-case hex digits.

Weak parts mean nothing alone: ``ident`` (an account or client name, or an AKIA
run too short for ``access``), ``secret`` (a long token mixing digits and
letters, or a named value too short for ``assign``) and ``endpoint`` (an IPv4
address or URL).  They are linked by an interval join within scopes: two parts
of a document co-occur if at most ``SCOPE`` characters lie between them.
A ``secret`` is reported where an identifier co-occurs, an ``ident`` where a
secret does, an ``endpoint`` where both do; base findings count as parts too.

The interval join is binned by ``SCOPE``: a part counts in every bin it reaches
into.  For each document, role and bin only the least start and the greatest end
are needed to tell whether something lies within reach of a part in this or a
neighbouring bin, so each part meets at most one row for each role in the bins it
touches and their neighbours, and no group of pairs arises.

Match positions are sums of lengths: ``split`` gives what lies between the
matches that ``regexp_extract_all`` lists.  Positions are code points.

Edge cases: null and empty texts have no findings; rows equal in id and text
share their findings; rows with a null id are scanned like others; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

SCOPE = 200
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")

_VALUE = "[A-Za-z0-9+/_.=-]"
#: pattern and group whose length decides; least and largest length of a finding
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?(""" + _VALUE + "+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # runs are maximal, so this equals all runs less the short ones
IDENT = r"""(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"(?:https?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?)|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9])"

_CHUNK = 256
_EMPTY = "array<struct<start:int,end:int,size:int>>"
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _matches(df: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds ``name``: start, end of each match, and the length of its deciding group."""
    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    sizes = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else F.col("_m")
    steps = F.arrays_zip(F.transform(F.split("text", pattern, -1), lambda x: F.length(x)).alias("gap"), F.transform("_m", lambda x: F.length(x)).alias("own"), F.transform(sizes, lambda x: F.length(x)).alias("size"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["gap"]
        end = begin + F.coalesce(x["own"], F.lit(0))
        more = F.when(x["own"].isNotNull(), F.array(F.struct(begin.alias("start"), end.alias("end"), x["size"].alias("size")))).otherwise(F.array().cast(_EMPTY))
        return F.struct(end.alias("at"), F.concat(a["out"], more).alias("out"))

    def located(steps: Column) -> Column:
        # an array grows by copying, so long lists of matches are taken in chunks
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _CHUNK).cast("int")), lambda i: F.slice(steps, i * _CHUNK + 1, F.lit(_CHUNK)))
        sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["gap"] + F.coalesce(x["own"], F.lit(0))))
        begun = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(chunks, begun, lambda c, at: F.aggregate(c, F.struct(at.alias("at"), F.array().cast(_EMPTY).alias("out")), step, lambda a: a["out"])))

    found = F.get(F.transform(F.array(steps), located), 0)  # names the steps
    return df.withColumn(name, F.when(F.size("_m") > 0, found).otherwise(F.array().cast(_EMPTY))).drop("_m")


def _kind(name: str) -> Column:
    return F.lit(KINDS.index(name))


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), _kind(kind).alias("kind"), m["end"].alias("end")))


def _clear_of(spans: Column, others: Column) -> Column:
    """Spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def parts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2`` (key of id and text), ``base`` findings and ``weak`` parts of each row."""
    df = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for name, pattern, group in (("a", ASSIGN, 2), ("k", ACCESS, 0), ("h", HEX, 0), ("i", IDENT, 0), ("t", TOKEN, 0), ("e", ENDPOINT, 0)):
        df = _matches(df, name, pattern, group)
    at_least = lambda c, n: F.filter(c, lambda m: m["size"] >= n)
    less = lambda c, n: F.filter(c, lambda m: m["size"] < n)
    base = F.array_sort(F.concat(_spans(at_least("a", 8), "assign"), _spans(at_least("k", 16), "access"), _spans(F.col("h"), "hex")))
    df = df.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"), base.alias("base"), F.concat(_spans(F.col("i"), "ident"), _spans(less("k", 16), "ident")).alias("ident"), _spans(less("a", 8), "secret").alias("named"), _spans(F.col("t"), "secret").alias("token"), _spans(F.col("e"), "endpoint").alias("endpoint"))
    df = df.withColumn("ident", _clear_of(F.col("ident"), F.col("base"))).withColumn("named", _clear_of(F.col("named"), F.col("base")))
    df = df.withColumn("token", _clear_of(F.col("token"), F.concat("base", "ident", "named")))
    weak = F.array_distinct(F.concat("ident", "named", "token", _clear_of(F.col("endpoint"), F.concat("base", "ident", "named", "token"))))
    return df.select("doc_id", "k1", "k2", "base", weak.alias("weak"))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``k1, k2, linked``: the weak parts with their complement in scope."""
    has = lambda *kinds: F.exists(F.concat("base", "weak"), lambda s: s["kind"].isin(*(KINDS.index(k) for k in kinds)))
    likely = found.where((F.size("weak") > 0) & has("access", "ident") & has("assign", "hex", "secret")).select("k1", "k2", F.explode(F.concat("base", "weak")).alias("s")).select("k1", "k2", "s.start", "s.kind", "s.end").distinct()
    bins = lambda more: F.explode(F.sequence(F.floor(F.col("start") / scope) - more, F.floor((F.col("end") - 1) / scope) + more)).alias("bin")
    role = F.when(F.col("kind").isin(KINDS.index("access"), KINDS.index("ident")), "i").when(F.col("kind") != KINDS.index("endpoint"), "s")
    reach = likely.where(role.isNotNull()).select("k1", "k2", role.alias("role"), "start", "end", bins(0)).groupBy("k1", "k2", "role", "bin").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    near = likely.where(F.col("kind") >= KINDS.index("ident")).select("*", bins(1))
    near = near.join(reach, ["k1", "k2", "bin"]).where((F.col("low") - F.col("end") <= scope) & (F.col("start") - F.col("high") <= scope))
    roles = near.groupBy("k1", "k2", "start", "kind", "end").agg(F.max((F.col("role") == "i").cast("int")).alias("i"), F.max((F.col("role") == "s").cast("int")).alias("s"))
    kept = roles.where(((F.col("kind") == KINDS.index("secret")) & (F.col("i") == 1)) | ((F.col("kind") == KINDS.index("ident")) & (F.col("s") == 1)) | ((F.col("kind") == KINDS.index("endpoint")) & (F.col("i") == 1) & (F.col("s") == 1)))
    return kept.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def scan(documents: DataFrame, *, scope: int = SCOPE, **columns) -> DataFrame:
    """``doc_id, base, spans`` of each row; spans are (start, kind number in KINDS, end), sorted."""
    found = written(parts(documents, **columns), "secret-parts")
    linked = link(found, scope)
    both = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPANS))))
    return found.join(linked, ["k1", "k2"], "left").select("doc_id", "base", both.alias("spans"))


def _joined(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
