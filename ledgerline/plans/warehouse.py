"""Raw rows to the three published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import by_filing, insider_transactions
from ..operators.marts import MONTHLY_KEYS, company_sentiment, monthly_activity, top_traders
from ..operators.quality import CHECKS, EXACT, FRESH, UNIQUE, audit, inexact, stale, unheld, unique
from ..operators.staging import clean
from ..session import bounded_tasks
from ..sinks.tables import read_table, write_monthly, write_table


@dataclass(frozen=True)
class Marts:
    monthly: DataFrame
    traders: DataFrame
    sentiment: DataFrame

    def cache(self) -> Marts:
        """Keep the tables for repeated serving queries until ``release``."""
        for table in (self.monthly, self.traders, self.sentiment):
            table.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def release(self) -> None:
        for table in (self.monthly, self.traders, self.sentiment):
            table.unpersist()


def build(raw: DataFrame, root: str) -> Marts:
    """Write all three tables under ``root`` and return them as stored.

    The deduplicated transactions feed every table, so they are written once,
    under ``root`` too, instead of being derived three times.
    """
    with bounded_tasks(raw.sparkSession):
        rows = insider_transactions(clean(by_filing(raw)))
        write_table(rows, f"{root}/transactions")
        transactions = open_transactions(raw.sparkSession, root, like=rows)
        monthly = monthly_activity(transactions)
        write_monthly(monthly, f"{root}/monthly_activity")
        traders = top_traders(transactions)
        write_table(traders, f"{root}/top_traders")
        sentiment = company_sentiment(transactions)
        write_table(sentiment, f"{root}/company_sentiment")
    return open_marts(raw.sparkSession, root, like=Marts(monthly, traders, sentiment))


def open_transactions(spark: SparkSession, root: str, like: DataFrame | None = None) -> DataFrame:
    """The deduplicated transactions that ``build`` stored."""
    return read_table(spark, f"{root}/transactions", like)


def open_marts(spark: SparkSession, root: str, like: Marts | None = None) -> Marts:
    """The stored tables; partition columns come last in files and go back to their place."""
    monthly = read_table(spark, f"{root}/monthly_activity", like and like.monthly)
    return Marts(
        monthly.select(*MONTHLY_KEYS, *[name for name in monthly.columns if name not in MONTHLY_KEYS]),
        read_table(spark, f"{root}/top_traders", like and like.traders),
        read_table(spark, f"{root}/company_sentiment", like and like.sentiment),
    )


def audit_all(
    raw: DataFrame,
    staged: DataFrame,
    transactions: DataFrame,
    marts: Marts,
    kinds: Collection[str] | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Every declared check, or those of the named kinds, one pass per table.

    Checks are chosen before anything is planned, so tables without a chosen
    check are not read. Freshness is judged if ``as_of`` is given.
    """
    tables = {
        "raw": raw,
        "staging": staged,
        "intermediate": transactions,
        "monthly_activity": marts.monthly,
        "top_traders": marts.traders,
        "company_sentiment": marts.sentiment,
    }

    def wanted(kind: str) -> bool:
        return kinds is None or kind in kinds

    chosen = {model: tuple(check for check in checks if wanted(check.kind)) for model, checks in CHECKS.items()}
    results = [audit(tables[model], model, checks) for model, checks in chosen.items() if checks]
    if wanted("unique"):
        results += [unique(tables[model], model, column) for model, columns in UNIQUE.items() for column in columns]
    if wanted("held"):
        results.append(unheld(raw))
    if wanted("exact"):
        results.append(inexact(transactions, "intermediate", EXACT))
    if as_of is not None and wanted("freshness"):
        results += [stale(tables[model], model, as_of, column) for model, column in FRESH.items()]
    report = results[0]
    for result in results[1:]:
        report = report.unionByName(result)
    return report
