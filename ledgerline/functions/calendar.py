"""Time dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column


def month_key(day: Column | str) -> Column:
    """2024-03"""
    return F.date_format(_column(day), "yyyy-MM")


def quarter_key(day: Column | str) -> Column:
    """2024-Q1"""
    return F.date_format(_column(day), "yyyy-'Q'q")


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    """2024Q1, the landing-zone partition value."""
    return F.concat(_column(year).cast("string"), F.lit("Q"), _column(quarter).cast("string"))


def days_to_file(filed: Column | str, traded: Column | str) -> Column:
    return F.datediff(_column(filed), _column(traded)).cast("bigint")
