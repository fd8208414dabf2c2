"""URL filtering with a bit-parallel wildcard automaton (multiword Shift-And).

Rules are globs over the canonical URL ``"." + host + path``:

* ``*`` matches any run of characters other than ``/`` (it stays in one label
  sequence or path segment), ``**`` any run at all, ``?`` one character;
* a glob is anchored at both ends; ``*.example.org/es/**`` therefore fits
  ``example.org`` and all of its subdomains below ``/es/``.

All globs are packed into one state set of ``ceil(total positions / 64)`` words.
Each character of the URL moves every glob at once: ``D = ((D << 1) & B[c]) |
(D & L[c])`` with carries between words; ``L`` holds the self-loops of the
wildcards.  The automaton runs over a block of URLs column by column in numpy,
so a step costs the same for every rule set of that many words.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; the path what follows up to ``?``, ``#`` or the end.  A
null URL or one without ``://`` has an empty host and path.  Host/path rules
(``Rule``) win over plain globs, the longest first; then any fitting block glob
blocks; else the default verdict holds.  Repeated rows and ties keep their own
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICTS = "page_id long, host string, path string, rule string, verdict string"
BLOCK = 4096


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        if not self.path.startswith("/"):
            raise ValueError(f"the path of a rule begins with /: {self}")
        return f"*.{escape(self.host)}{escape(self.path)}**"


def escape(literal: str) -> str:
    return "".join("\\" + c if c in "*?\\" else c for c in literal)


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Pages of no use for training text, whatever the host.
GLOBS = ("**/login**", "**/signin**", "**/cart/**", "**/checkout/**", "**/wp-admin/**", "**/search/**", "**.exe", "**.zip", "**.jpg", "**.png", "**.gif", "**.mp4", "*.adserver.*/**", "*.tracker.*/**")


class Automaton:
    """Shift-And over byte strings for many globs at once."""

    def __init__(self, globs: Sequence[str]):
        positions: list[list[tuple[str, bytes]]] = []
        for g in globs:
            items, i = [], 0
            while i < len(g):
                if g[i] == "*":
                    wide = g[i : i + 2] == "**"
                    items.append(("any" if wide else "segment", b""))
                    i += 2 if wide else 1
                    continue
                if g[i] == "?":
                    items.append(("one", b""))
                elif g[i] == "\\":
                    i += 1
                    items.append(("byte", g[i].encode()))
                else:
                    items.append(("byte", g[i].encode()))
                i += 1
            positions.append([(k, bytes([b])) for k, v in items for b in (v or b"\0")])
        # A glob takes one start state and one state per consuming position; a
        # wildcard is a self-loop on the state before it.
        n = sum(1 + sum(k in ("byte", "one") for k, _ in p) for p in positions)
        self.words = max(1, -(-n // 64))
        self.move = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accept = np.zeros(len(globs), np.int64)
        state = 0

        def put(table: np.ndarray, bytes_: Sequence[int] | slice, bit: int) -> None:
            table[bytes_ if isinstance(bytes_, slice) else list(bytes_), bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

        for g, items in enumerate(positions):
            self.start[state // 64] |= np.uint64(1) << np.uint64(state % 64)
            for kind, value in items:
                if kind == "any":
                    put(self.loop, slice(None), state)
                elif kind == "segment":
                    put(self.loop, [c for c in range(256) if c != 0x2F], state)
                elif kind == "one":  # a character's first byte, then those that continue it
                    state += 1
                    put(self.move, [c for c in range(256) if c & 0xC0 != 0x80], state)
                    put(self.loop, range(0x80, 0xC0), state)
                else:
                    state += 1
                    put(self.move, [value[0]], state)
            self.accept[g] = state
            state += 1

    def match(self, strings: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: strings by globs."""
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        order = np.argsort(-size, kind="stable")
        longest = int(size.max(initial=0))
        buffer = np.frombuffer(b"".join(strings), np.uint8)
        first = np.concatenate([[0], np.cumsum(size)])[:-1][order]
        length = size[order]
        active = np.searchsorted(-length, -np.arange(longest), side="left")  # strings longer than j
        d = np.broadcast_to(self.start, (len(strings), self.words)).copy()
        one = np.uint64(1)
        for j in range(longest):
            m = active[j]
            c = buffer[first[:m] + j]
            now = d[:m]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            d[:m] = (moved & self.move[c]) | (now & self.loop[c])
        out = np.empty((len(strings), len(self.accept)), bool)
        out[order] = (d[:, self.accept // 64] >> (self.accept % 64).astype(np.uint64)) & one
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower-case) and path of a URL; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def filter_urls(pages: DataFrame, *, rules: Sequence[Rule] = RULES, block_globs: Sequence[str] = GLOBS, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    rules = sorted(rules, key=lambda r: (-len(r.text), r.text))
    automaton = Automaton([*(r.glob for r in rules), *block_globs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([r.text for r in rules] + [None], object)
        verdicts = np.array([r.verdict for r in rules] + [default], object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                fits = automaton.match(part.column(3).to_pylist())
                ruled, n = fits[:, : len(rules)], len(rules)
                best = np.where(ruled.any(1), ruled.argmax(1), n) if n else np.zeros(part.num_rows, np.int64)
                verdict = verdicts[best]
                verdict[(best == n) & fits[:, n:].any(1)] = "block"
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    host, path = host_and_path(F.col(f"`{url_col}`"))
    split = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return split.select("page_id", "host", "path", F.concat(F.lit("."), "host", "path").cast("binary").alias("text")).mapInArrow(run, VERDICTS)


def query(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql_verdicts() -> str:
    def like(glob: str) -> str:
        out, i = "", 0
        while i < len(glob):
            if glob.startswith("**", i):
                out, i = out + ".*", i + 2
            elif glob[i] == "*":
                out, i = out + "[^/]*", i + 1
            else:
                out, i = out + ("\\" + glob[i] if not glob[i].isalnum() and glob[i] != "/" else glob[i]), i + 1
        return f"regexp_matches('.' || host || path, '^(?s:{out})$')"

    best = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM cut
), split AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts
)
SELECT page_id, host, path,
  CASE {' '.join(f"WHEN {fits(r)} THEN '{r.text}'" for r in best)} END AS rule,
  CASE {' '.join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in best)} WHEN {' OR '.join(like(g) for g in GLOBS)} THEN 'block' ELSE 'allow' END AS verdict
FROM split"""


ORACLE_SQL = _sql_verdicts()
