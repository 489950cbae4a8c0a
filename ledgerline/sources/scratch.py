"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, a folder of the warehouse, which all executors share too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _file_system(spark, path)
    return system.exists(found)


def clear(spark: SparkSession) -> None:
    """Remove what this application left in the shared folder; for the end of a job whose results are stored elsewhere."""
    system, found = _file_system(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    system.delete(found, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used, grouped by application so old runs are easy to remove."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``frame`` once and read it back, with its row count.

    Lineage ends at the files, so losing executors does not repeat the work
    that led here, and later passes read only the columns they need. The count
    comes from file footers.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    return table, table.count()
