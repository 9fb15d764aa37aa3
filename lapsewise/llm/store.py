"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the warehouse: both can be reached from every executor."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, removed with all below it when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    place, fs = _file_system(spark, path)
    fs.deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, kept as a table: what follows starts from files that outlive executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    # Nothing reads the shuffles of this job again: their files go with its end, not when the driver next collects garbage.
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that no later step reads."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            place, fs = _file_system(table.sparkSession, file.rpartition("/")[0])
            fs.delete(place, True)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
