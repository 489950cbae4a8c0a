"""Raw transactions at rest: Parquet, one directory per quarter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.RAW)


def read_raw(spark: SparkSession, root: str, quarters: Iterable[str] | None = None) -> DataFrame:
    """Landed rows in schema order; named quarters become a partition filter."""
    raw = spark.read.schema(schema.RAW).parquet(root).select(schema.RAW.fieldNames())
    return raw if quarters is None else raw.where(F.col("quarter").isin(*quarters))


def available_quarters(spark: SparkSession, root: str) -> DataFrame:
    """Landed quarters in order, from the names of files: none is opened."""
    quarter = F.regexp_extract("path", r"/quarter=([^/]*)/", 1)
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root).select(quarter.alias("quarter"))
    return names.where(F.col("quarter") != "").distinct().orderBy("quarter")


def pending(due: DataFrame, landed: DataFrame) -> DataFrame:
    """Quarters ``due`` (a column quarter) that have not ``landed``."""
    return due.select("quarter").distinct().join(landed.select("quarter"), "quarter", "left_anti")


def of_quarters(partitioned: DataFrame, quarters: DataFrame) -> DataFrame:
    """Rows of the quarters that a table names.

    ``partitioned`` is read by quarter; Spark finds the quarters at run time and
    lists no file of any other (dynamic partition pruning).
    """
    return partitioned.join(quarters.select("quarter"), "quarter", "left_semi")


def quarters_to_process(
    years: DataFrame, as_of: dt.date, quarters: Iterable[int] | None = None
) -> DataFrame:
    """Every quarter of ``years.year`` whose last month has begun by ``as_of``."""
    grid = years.select(F.col("year").cast("int").alias("year")).distinct()
    grid = grid.select("year", F.explode(F.array(*[F.lit(q) for q in range(1, 5)])).alias("quarter"))
    due = grid.where(F.make_date("year", F.col("quarter") * 3, F.lit(1)) <= F.lit(as_of))
    return due if quarters is None else due.where(F.col("quarter").isin(*quarters))
