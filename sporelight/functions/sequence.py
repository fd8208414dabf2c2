"""Sequence and text functions: Column to Column, built-in expressions unless noted."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Complement tables.
_DNA, _DNA_C = "ACGTacgt", "TGCAtgca"
_IUPAC, _IUPAC_C = "ABCDGHMNRSTUVWXYabcdghmnrstuvwxy", "TVGHCDKNYSAABWXRtvghcdknysaabwxr"
# Database tags that name the following part of an identifier, most trusted first.
_TAGS = ("ref", "gb", "emb", "dbj", "sp", "tr")
# Letters without a capital of one letter of their own (and those whose capital is newer than Unicode 15), and what SQL's upper makes of each.
_NEWER = "ƛɤ\u1c8a\ua7cd\ua7db" + "".join(map(chr, range(0x10D70, 0x10D86)))
_WIDE = "".join(c for c in map(chr, range(0x80, 0x20000)) if len(c.upper()) > 1 and c != "ß") + _NEWER
_WIDE_UPPER = "".join(c.title() if len(c.title()) == 1 and len(c.upper()) > 1 else c for c in _WIDE)


def upper(s: Column) -> Column:
    """Capitals, one letter for one: the built-in function makes SS of ß and two or three letters of some others, which changes lengths.

    Texts that have such letters are those the built-in function lengthens; a search for one of a hundred letters would cost more than all the rest."""
    plain = F.upper(F.replace(s, F.lit("ß"), F.lit("ẞ")))
    single = F.transform(F.split(s, ""), lambda c: F.when(F.instr(F.lit(_WIDE), c) > 0, F.translate(c, _WIDE, _WIDE_UPPER)).otherwise(F.upper(F.replace(c, F.lit("ß"), F.lit("ẞ")))))
    return F.when((F.length(plain) != F.length(s)) | s.rlike(f"[{_NEWER[:5]}{_NEWER[5]}-{_NEWER[-1]}]"), F.array_join(single, "")).otherwise(plain)


@functools.cache
def _capitals() -> np.ndarray:
    """What ``upper`` makes of each letter, by code point; from 0x20000 on no letter has a capital."""
    wide = dict(zip(_WIDE, _WIDE_UPPER)) | {"ß": "ẞ"}
    return np.array([ord(wide.get(c) or c.upper()) for c in map(chr, range(0x20000))], np.uint32)


@functools.cache
def _complements(iupac: bool) -> np.ndarray:
    table = np.arange(0x20000, dtype=np.uint32)
    for c, d in zip(*((_IUPAC, _IUPAC_C) if iupac else (_DNA, _DNA_C))):
        table[ord(c)] = ord(d)
    return table


def _looked_up(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[x] if not len(x) or x.max() < len(table) else np.where(x < len(table), table[np.minimum(x, len(table) - 1)], x)


def upper_codes(text: str) -> np.ndarray:
    """Code points of what ``upper`` makes of a text, outside Spark's expressions."""
    return _looked_up(_capitals(), np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))


def complement_codes(u: np.ndarray) -> np.ndarray:
    """Complements of code points over ACGT."""
    return _looked_up(_complements(False), u)


def canonical_digest(u: np.ndarray, iupac: bool = True) -> bytes:
    """SHA-256 of the lesser of a text and its reverse complement, given the code points of its capitals."""
    rc = _looked_up(_complements(iupac), u)[::-1]
    differ = u != rc
    at = int(differ.argmax()) if len(u) else 0
    return hashlib.sha256((rc if len(u) and differ[at] and rc[at] < u[at] else u).tobytes()).digest()


@F.arrow_udf(T.StringType())
def upper_reverse_complement(s: pa.Array) -> pa.Array:
    """``iupac_reverse_complement(upper(s))``, letters looked up by batches of texts (Arrow)."""

    def of(text: str | None) -> str | None:
        return None if text is None else _looked_up(_complements(True), upper_codes(text))[::-1].tobytes().decode("utf-32-le", "surrogatepass")

    return pa.array([of(t.as_py()) for t in s], pa.string())


def reverse_complement(s: Column) -> Column:
    """Reverse complement; characters other than ACGT (either case) stay as they are."""
    return F.reverse(F.translate(s, _DNA, _DNA_C))


def iupac_reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, _IUPAC, _IUPAC_C))


def canonical(s: Column) -> Column:
    """One of a sequence and its IUPAC reverse complement, the same for both."""
    return F.least(s, iupac_reverse_complement(s))


def first_token(s: Column) -> Column:
    """First white-space separated token ('' for a blank text)."""
    return F.coalesce(F.get(F.split(F.trim(F.regexp_replace(s, r"\s+", " ")), " "), 0), F.lit(""))


def normalize_id(raw: Column) -> Column:
    """Accession of a piped identifier: the part after the most trusted tag, else the last part that isn't empty."""
    token = F.regexp_replace(first_token(raw), r"^lcl\|", "")
    parts = F.filter(F.split(token, r"\|"), lambda p: p != "")
    tagged = [F.get(parts, F.nullif(F.array_position(parts, t), F.lit(0)).cast("int")) for t in _TAGS]
    return F.coalesce(*tagged, F.try_element_at(parts, F.lit(-1)), F.lit(""))


def hamming(a: Column, b: Column) -> Column:
    """Mismatches over the common length plus what one text is longer."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    return F.aggregate(pairs, F.lit(0), lambda n, x: n + x)


def kmers(s: Column, k: int) -> Column:
    """Substrings of length k with their start (from 1); none if the text is shorter.

    One pass of a regular expression: a substring for each start would read a long text once for each."""
    words = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))
    return F.transform(words, lambda w, i: F.struct((i + 1).alias("start"), w.alias("kmer")))


def columns_of(query: Column, hit: Column) -> Column:
    """Columns (q, h) of a gapped pair, as far as both reach."""
    n = F.least(F.length(query), F.length(hit))
    both = F.arrays_zip(F.split(query, "").alias("q"), F.split(hit, "").alias("h"))
    return F.when(n > 0, F.slice(both, 1, F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<struct<q:string,h:string>>"))


def cigar(query: Column, hit: Column) -> Column:
    """Run-length M/I/D string of a gapped pair; columns gapped on both sides don't count."""
    ops = F.transform(
        F.filter(columns_of(query, hit), lambda c: ~((c["q"] == "-") & (c["h"] == "-"))),
        lambda c: F.when(c["q"] == "-", "D").when(c["h"] == "-", "I").otherwise("M"),
    )
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("op"), F.lit(0).alias("n"))
    token = lambda a: F.when(a["n"] > 0, F.concat(a["n"].cast("string"), a["op"])).otherwise("")

    def step(a: Column, op: Column) -> Column:
        same = a["op"] == op
        return F.struct(F.when(same, a["out"]).otherwise(F.concat(a["out"], token(a))).alias("out"), op.alias("op"), F.when(same, a["n"] + 1).otherwise(F.lit(1)).alias("n"))

    text = F.aggregate(ops, start, step, lambda a: F.concat(a["out"], token(a)))
    return F.when(text == "", F.concat(F.length(F.replace(query, F.lit("-"), F.lit(""))).cast("string"), F.lit("M"))).otherwise(text)


def matched_columns(query: Column, hit: Column) -> Column:
    """Columns with the same residue on both sides, case ignored."""
    return F.size(F.filter(columns_of(query, hit), lambda c: (F.upper(c["q"]) == F.upper(c["h"])) & (c["q"] != "-")))


def identity_text(query: Column, hit: Column) -> Column:
    """``matched/aligned(percent%)`` over columns not gapped on both sides; percent to the nearest whole, ties to even."""
    aligned = F.size(F.filter(columns_of(query, hit), lambda c: ~((c["q"] == "-") & (c["h"] == "-"))))
    matched = matched_columns(query, hit)
    percent = F.bround(F.when(aligned > 0, matched * F.lit(100.0) / aligned).otherwise(0.0)).cast("int")
    return F.concat(matched.cast("string"), F.lit("/"), aligned.cast("string"), F.lit("("), percent.cast("string"), F.lit("%)"))


def midline(query: Column, hit: Column) -> Column:
    """``|`` for equal characters, a space beside a gap, ``.`` for other pairs."""
    return F.array_join(F.transform(columns_of(query, hit), lambda c: F.when((c["q"] == "-") | (c["h"] == "-"), " ").when(c["q"] == c["h"], "|").otherwise(".")), "")


def wrapped(s: Column, width: int = 95) -> Column:
    """Pieces of fixed width."""
    n = F.ceil(F.length(s) / width).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.substring(s, i * width + 1, width))


def slug(s: Column) -> Column:
    """Anchor text: runs aside, every character that is no letter or digit becomes a hyphen; ends are stripped."""
    text = F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}]", "-"), r"^-+|-+$", "")
    return F.when(text == "", "item").otherwise(text)


def html_escape(s: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(raw), F.lit(safe))
    return s


def percent_text(x: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", x)


@F.pandas_udf(T.StringType())
def general_6g(x: pd.Series) -> pd.Series:
    """``%.6g`` as C and Python write it, which the JVM's formatter doesn't."""
    return x.map(lambda v: None if v is None or v != v else format(v, ".6g"))


def edit_tag(tags: Column) -> Column:
    """The NM:i tag of a record's optional fields; an error if there is none."""
    text = F.regexp_extract(tags, r"(?:^|\t)NM:i:(-?\d+)", 1)
    return F.when(text != "", text.cast("int")).otherwise(F.raise_error(F.concat(F.lit("alignment without NM tag: "), tags)).cast("int"))


def alternative_alignments(xa: Column) -> Column:
    """Items of an XA list: rname, pos (negative on the reverse strand), cigar, nm."""
    items = F.regexp_extract_all(F.coalesce(xa, F.lit("")), F.lit(r"([^,;]+,[-+]\d+,[^,]+,\d+);"), 1)
    split = F.transform(items, lambda t: F.split(t, ","))
    return F.transform(split, lambda p: F.struct(F.get(p, 0).alias("rname"), F.get(p, 1).cast("int").alias("pos"), F.get(p, 2).alias("cigar"), F.get(p, 3).cast("int").alias("nm")))


def read_lengths(spec: str) -> set[int]:
    """Lengths of a spec such as ``21-23:25:27``."""
    out: set[int] = set()
    for part in spec.split(":"):
        low, _, high = part.strip().partition("-")
        if not low.isdigit() or (high and not high.isdigit()):
            raise ValueError(f"no read length: {part!r}")
        first, last = int(low), int(high or low)
        if not 0 < first <= last:
            raise ValueError(f"no range of read lengths: {part!r}")
        out.update(range(first, last + 1))
    return out


def odd_sizes(span: str) -> list[int]:
    """Odd k-mer sizes in a span such as ``9-23``."""
    low, _, high = span.partition("-")
    if not (low.isdigit() and high.isdigit()) or int(low) > int(high):
        raise ValueError(f"no span of k-mer sizes: {span!r}")
    return [k for k in range(int(low), int(high) + 1) if k % 2]
