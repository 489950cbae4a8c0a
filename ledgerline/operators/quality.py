"""Data-quality checks: one aggregation pass per table, one result row per check."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.money import CENTS, PRICE_UNITS, whole_units
from .staging import SHARES

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """``values`` given: accepted values (NULL passes); otherwise not-null."""

    column: str
    severity: str = WARN
    values: tuple[str, ...] = ()

    @property
    def kind(self) -> str:
        return "accepted_values" if self.values else "not_null"

    def fails(self) -> Column:
        value = F.col(self.column)
        return ~value.isin(*self.values) if self.values else value.isNull()


# The checks of each table.
CHECKS = {
    "raw": (
        Check("accession_number", ERROR),
        Check("cik", ERROR),
        Check("ingested_at", ERROR),
        Check("quarter", ERROR),
        Check("transaction_code", ERROR, schema.TRANSACTION_CODES),
    ),
    "staging": (
        Check("accession_number"),
        Check("cik"),
        Check("insider_name"),
        Check("transaction_code"),
        Check("buy_sell_flag"),
        Check("insider_role"),
        Check("transaction_code", ERROR, schema.TRANSACTION_CODES),
        Check("buy_sell_flag", ERROR, (*schema.BUY_SELL_FLAGS.values(), schema.OTHER)),
        Check("insider_role", ERROR, (*schema.INSIDER_ROLES.values(), schema.OTHER)),
        Check("ownership_type", ERROR, (*schema.OWNERSHIP_TYPES.values(), *schema.OWNERSHIP_TYPES)),
    ),
    "intermediate": (Check("accession_number"),),
    "monthly_activity": (
        Check("buy_sell_flag"),
        Check("num_unique_insiders"),
        Check("buy_sell_flag", ERROR, schema.TRADED_FLAGS),
    ),
    "top_traders": (Check("insider_name"), Check("rank_by_value")),
    "company_sentiment": (
        Check("issuer_ticker"),
        Check("sentiment_label"),
        Check(
            "sentiment_label", ERROR, (*(label for _, label in schema.SENTIMENT_LABELS), schema.SENTIMENT_FALLBACK)
        ),
    ),
}

# Units that columns of transactions are added in.
EXACT = {"transaction_value_usd": CENTS, "price_per_share": PRICE_UNITS}

# Columns expected to be unique.
UNIQUE = {"company_sentiment": ("issuer_ticker",)}

# Columns that tell how fresh a table is.
FRESH = {"raw": "ingested_at"}

# Days since the last load.
WARN_AFTER_DAYS = 45
ERROR_AFTER_DAYS = 90


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(severity)


def _result(model: str, column: Column, kind: Column, severity: Column, failures: Column) -> list[Column]:
    return [
        F.lit(model).alias("model"),
        column.alias("column"),
        kind.alias("check"),
        severity.alias("severity"),
        failures.cast("bigint").alias("failures"),
        _status(failures, severity).alias("status"),
    ]


def audit(frame: DataFrame, model: str, checks: tuple[Check, ...]) -> DataFrame:
    """Count failing rows of every check in one pass."""
    counts = frame.agg(*[F.count_if(check.fails()).alias(f"c{i}") for i, check in enumerate(checks)])
    rows = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check.column).alias("column"),
                        F.lit(check.kind).alias("check"),
                        F.lit(check.severity).alias("severity"),
                        F.col(f"c{i}").alias("failures"),
                    )
                    for i, check in enumerate(checks)
                ]
            )
        )
    )
    return rows.select(*_result(model, *(F.col(name) for name in ("column", "check", "severity", "failures"))))


def unique(frame: DataFrame, model: str, column: str, severity: str = WARN) -> DataFrame:
    """Count values that occur more than once; NULL is not a value."""
    repeated = frame.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    failures = repeated.agg(F.count(F.lit(1)).alias("failures"))
    return failures.select(*_result(model, F.lit(column), F.lit("unique"), F.lit(severity), F.col("failures")))


def freshness(frame: DataFrame, model: str, as_of: dt.date, column: str = "ingested_at") -> DataFrame:
    """Days since the newest row, as pass, warn or error; an empty table is an error."""
    age = frame.agg(F.datediff(F.lit(as_of), F.max(F.col(column)).cast("date")).cast("bigint").alias("age_days"))
    status = (
        F.when(F.col("age_days") <= WARN_AFTER_DAYS, F.lit("pass"))
        .when(F.col("age_days") <= ERROR_AFTER_DAYS, F.lit(WARN))
        .otherwise(F.lit(ERROR))
    )
    return age.select(
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.lit("freshness").alias("check"),
        "age_days",
        status.alias("status"),
    )


def stale(frame: DataFrame, model: str, as_of: dt.date, column: str = "ingested_at") -> DataFrame:
    """``freshness`` as a row like those of the other checks."""
    status = F.col("status")
    severity = F.when(status == WARN, F.lit(WARN)).otherwise(F.lit(ERROR))
    failures = (status != "pass").cast("bigint")
    return freshness(frame, model, as_of, column).select(
        "model", "column", "check", severity.alias("severity"), failures.alias("failures"), "status"
    )


def rejected_numbers(raw: DataFrame) -> DataFrame:
    """Raw rows whose share count staging cannot hold and leaves NULL, with the reason."""
    shares = F.col("transaction_shares")
    reason = (
        F.when(F.isnan(shares), F.lit("not a number"))
        .when(F.abs(shares) == float("inf"), F.lit("infinite"))
        .when(shares.try_cast(SHARES).isNull(), F.lit("too large"))
    )
    found = raw.where(shares.isNotNull()).withColumn("reason", reason).where(F.col("reason").isNotNull())
    return found.select("accession_number", "cik", "transaction_date", "quarter", "reason")


def unheld(raw: DataFrame) -> DataFrame:
    """Count the rows of ``rejected_numbers``, as a check: their shares are in no total."""
    failures = rejected_numbers(raw).agg(F.count(F.lit(1)).alias("failures"))
    return failures.select(*_result("raw", F.lit("transaction_shares"), F.lit("held"), F.lit(ERROR), F.col("failures")))


def inexact(frame: DataFrame, model: str, units: Mapping[str, int]) -> DataFrame:
    """Count values of each column too large for whole units: their groups are added as doubles, in any order."""
    counts = frame.agg(
        *[F.count_if(F.col(column).isNotNull() & whole_units(column, size).isNull()).alias(column) for column, size in units.items()]
    )
    rows = counts.select(F.inline(F.array(*[F.struct(F.lit(column).alias("column"), F.col(column).alias("failures")) for column in units])))
    return rows.select(*_result(model, F.col("column"), F.lit("exact"), F.lit(WARN), F.col("failures")))


class QualityError(Exception):
    """Raised by ``require`` with the failing checks."""


def require(results: DataFrame) -> None:
    """Raise if any error-severity check failed; results hold one row per check."""
    failed = results.where(F.col("status") == ERROR).select("model", "column", "check").collect()
    if failed:
        raise QualityError(", ".join(sorted(f"{row['model']}.{row['column']} {row['check']}" for row in failed)))
