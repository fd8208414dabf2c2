"""The parts of op6, op7 and op8 that SQL can express, as queries of their own beside the same in DuckDB SQL.

Each query runs the operator and leaves out what its trained model or its method adds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import classlm, quality, secrets


def quality_base(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    nothing_learned = quality.Field(np.zeros((quality.FEATURES, 2)), np.zeros((2, 2)))
    return quality.judge(documents, nothing_learned).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def class_lm_base(spark, sf_dir: str) -> DataFrame:
    """The base score to three decimals: sums of floating-point numbers depend on their order."""
    return classlm.query(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score"))


def secret_base(spark, sf_dir: str) -> DataFrame:
    return secrets.query(spark, sf_dir).drop("spans")


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
lines AS (SELECT doc_id, line, count(*) - 1 AS again FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dup AS (SELECT doc_id, sum(again) AS n FROM lines GROUP BY 1),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS win FROM w, unnest(range(1, len(w) - 1)) AS r(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)"""

# crc32 of an id's decimal text, bit by bit
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(CAST(doc_id AS VARCHAR), '')]), lambda a, b: list_reduce(list_prepend(xor(a, b), [z::BIGINT for z in range(8)]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"

CLASS_LM_SQL = rf"""
WITH w AS (SELECT doc_id, {_CRC} % 10 = 0 AS held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS w FROM documents),
t AS (SELECT doc_id, held_out, unnest(w) AS word FROM w),
c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1),
n AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(n.n) AS train_tokens,
  round(sum(log10((coalesce(c.c, 0) + 0.1) / (n.n + 0.1 * (n.v + 1)))), 3) AS base_score
FROM t LEFT JOIN c USING (word), n GROUP BY doc_id"""


def _located(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """Rows (doc_id, kind, place in the list of kinds, start, end) of the matches that are long enough."""
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS place, list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in m[1 : i - 1]]), 0) AS s, length(m[i]) AS n FROM (
  SELECT doc_id, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v FROM d
), unnest(range(1, len(m) + 1)) AS r(i) WHERE length(v[i]) >= {least}"""


SECRET_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_located("assign", 1, secrets.ASSIGN, 2, 8)} UNION ALL {_located("access", 2, secrets.ACCESS, 0, 16)} UNION ALL {_located("hex", 3, "[0-9a-f]+", 0, 32)}),
s AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
  string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, place) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN s USING (doc_id)"""
