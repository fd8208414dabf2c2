"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: the shuffle files of a query go when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset and Spark runs in one process (tests), a folder beside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-intermediate"
    return folder.rstrip("/")


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """What the query shuffles is deleted as soon as its result is written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: lineage ends in files that survive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/sporelight/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with _no_shuffle_left(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of written frames that nothing will read any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
