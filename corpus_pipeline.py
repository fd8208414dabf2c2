"""A training-data pipeline over ``documents``: five corpus operators, one after another.

Each stage gets what the one before it wrote.  All but the last return the
columns of ``documents``; the last returns the packed pieces.  No stage can be
written as a whole in SQL (the first rests on a trained model), so ``ORACLE_SQL``
is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sporelight.llm import decontaminate, linededup, ngramjoin, packing, quality
from sporelight.llm.store import written

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labelling reject go."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within two edits of an earlier line go; a document of which nothing is left goes too."""
    return linededup.dedup_documents(docs, with_size="n_chars").where("text IS NULL OR length(trim(BOTH ' \t\r\n' FROM text)) > 0")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles, the one of smallest id stays."""
    return ngramjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences for training, a row for each piece."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_jaccard), ("benchmark decontamination", decontamination), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
