"""Classification of filing codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema
from .text import _column, strip_upper


def _lookup(key: Column, table: dict[str, str], otherwise: Column) -> Column:
    branches = iter(table.items())
    code, label = next(branches)
    chain = F.when(key == code, F.lit(label))
    for code, label in branches:
        chain = chain.when(key == code, F.lit(label))
    return chain.otherwise(otherwise)


def is_set(flag: Column | str) -> Column:
    """True only for the raw flag '1'; anything else, NULL included, is false."""
    return F.coalesce(_column(flag) == "1", F.lit(False))


def insider_role() -> Column:
    """Highest-priority role among the raw role flags."""
    chain = F
    for flag, role in schema.INSIDER_ROLES.items():
        chain = chain.when(F.col(flag) == "1", F.lit(role))
    return chain.otherwise(schema.OTHER)


def transaction_type(code: Column | str) -> Column:
    return type_of(strip_upper(code))


def type_of(code: Column | str) -> Column:
    """``transaction_type`` of a code that ``strip_upper`` has seen."""
    return _lookup(_column(code), schema.TRANSACTION_TYPES, F.lit(schema.OTHER))


def buy_sell_flag(code: Column | str) -> Column:
    return flag_of(strip_upper(code))


def flag_of(code: Column | str) -> Column:
    """``buy_sell_flag`` of a code that ``strip_upper`` has seen."""
    return _lookup(_column(code), schema.BUY_SELL_FLAGS, F.lit(schema.OTHER))


def ownership_type(code: Column | str) -> Column:
    """Direct or Indirect; an unknown code passes through as filed."""
    return _lookup(strip_upper(code), schema.OWNERSHIP_TYPES, _column(code))


def sentiment_label(buy_ratio: Column | str) -> Column:
    ratio = _column(buy_ratio)
    chain = F
    for floor, label in schema.SENTIMENT_LABELS:
        chain = chain.when(ratio >= floor, F.lit(label))
    return chain.otherwise(schema.SENTIMENT_FALLBACK)
