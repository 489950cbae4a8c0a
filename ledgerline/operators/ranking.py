"""Ranks over whole tables, with no task that must hold a whole group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Value bins per decade. Bin limits are fixed, so a bin of money totals holds at
# most 0.23% of its magnitude in distinct cents, however many rows share them.
_BINS_PER_DECADE = 1000


def with_ranks(frame: DataFrame, ranks: Mapping[str, str], within: str | None = None) -> DataFrame:
    """Add ``rank() over (partition by within order by value desc)`` columns, at any size the same way.

    ``ranks`` maps new column -> value column; ``within`` names a column of few
    values (or none, for one global rank). A rank is 1 + the rows with a larger
    value. Rows collapse to (value, count) before any sort, so ties of any size are one
    row. Larger values in other bins are a prefix sum over the fixed set of
    bins; larger values in the same bin are a running count inside the bin. The
    join back meets one position per value, so a value shared by many rows is a
    skewed key on one side only, which adaptive execution splits.
    """
    columns = frame.columns
    group = F.col(within) if within else F.lit(0)
    keyed = frame.withColumn("_group", group)
    for name, value in ranks.items():
        positions = _positions(frame.select(group.alias("_group"), F.col(value).alias("_value")))
        positions = positions.withColumnRenamed("_rank", name)
        keyed = (
            keyed.alias("rows")
            .join(
                positions.alias("at"),
                F.col("rows._group").eqNullSafe(F.col("at._group")) & F.col(f"rows.{value}").eqNullSafe(F.col("at._value")),
            )
            .select("rows.*", f"at.{name}")
        )
    return keyed.select(*columns, *ranks)


def _bin(value: Column) -> Column:
    """Bin number, larger for larger values; monotone, so bins never interleave.

    Finite values lie within 1,310,000 of 0; infinities have bins beyond, NaN,
    which sorts above all numbers, one beyond those.
    """
    value = value.cast("double")
    size = F.floor(F.log10(F.abs(value)) * _BINS_PER_DECADE) + 1_000_000
    infinite = F.lit(float("inf"))
    return (
        F.when(F.isnan(value), F.lit(3_000_000))
        .when(value == infinite, F.lit(2_000_000))
        .when(value == -infinite, F.lit(-2_000_000))
        .when(value > 0, size)
        .when(value < 0, -size)
        .when(value == 0, F.lit(0))
    )


def _positions(values: DataFrame) -> DataFrame:
    counts = (
        values.withColumn("_bin", _bin(F.col("_value")))
        .groupBy("_group", "_bin", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    larger_bins = W.partitionBy("_group").orderBy(F.col("_bin").desc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    bins = (
        counts.groupBy("_group", "_bin")
        .agg(F.sum("_rows").alias("_rows"))
        .select("_group", "_bin", F.coalesce(F.sum("_rows").over(larger_bins), F.lit(0)).alias("_before"))
    )
    larger_here = (
        W.partitionBy("_group", "_bin")
        .orderBy(F.col("_value").desc_nulls_last())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    here = counts.select("_group", "_bin", "_value", F.coalesce(F.sum("_rows").over(larger_here), F.lit(0)).alias("_here"))
    return (
        here.alias("h")
        .join(
            bins.alias("b"),
            F.col("h._group").eqNullSafe(F.col("b._group")) & F.col("h._bin").eqNullSafe(F.col("b._bin")),
        )
        .select("h._group", "h._value", (F.col("b._before") + F.col("h._here") + 1).cast("bigint").alias("_rank"))
    )
