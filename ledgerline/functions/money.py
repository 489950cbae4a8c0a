"""Arithmetic on shares and dollars.

A sum of doubles depends on the order in which partial sums arrive, so a
retried task or a re-planned shuffle can change the last digits, and with them
ranks and ties. The sums here add whole units (cents, for money) as decimals,
which is exact in any order, and turn into a double once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .text import _column

CENTS = 100
# Unit prices: more digits than filings carry, few enough to stay exact.
PRICE_UNITS = 100_000_000


def transaction_value(shares: Column | str, price: Column | str) -> Column:
    """Dollars to the cent; NULL if either side is."""
    return F.round(_column(shares) * _column(price), 2)


def exact_sum(value: Column | str, units: int = CENTS, window: WindowSpec | None = None) -> Column:
    """Order-independent sum of whole units, up to 38 digits of them.

    Only if a value or the sum has more (``quality.inexact`` counts such
    values), or is not finite, are the values added as doubles.
    """

    def over(summed: Column) -> Column:
        return summed.over(window) if window is not None else summed

    value = _column(value)
    counted = whole_units(value, units)
    exact = over(F.try_sum(counted))
    complete = over(F.count(counted)) == over(F.count(value))
    held = complete & (exact.isNotNull() | (over(F.count(value)) == 0))
    return F.when(held, exact.cast("double") / float(units)).otherwise(over(F.sum(value)))


def whole_units(value: Column | str, units: int = CENTS) -> Column:
    """Units as an exact decimal; NULL if there are more than 38 digits of them."""
    return F.rint(_column(value) * float(units)).try_cast("decimal(38,0)")


def exact_avg(value: Column | str, units: int = CENTS) -> Column:
    return F.try_divide(exact_sum(value, units), F.count(value))


def when_flag(flag: str, value: Column | str) -> Column:
    """``value`` on rows with the flag, 0 elsewhere; a NULL value on a flagged row stays NULL."""
    return F.when(F.col("buy_sell_flag") == flag, _column(value)).otherwise(F.lit(0))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(_column(part), _column(whole))
