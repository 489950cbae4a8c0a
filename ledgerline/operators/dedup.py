"""One row per transaction, enriched with time dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema
from ..functions.calendar import days_to_file, month_key, quarter_key
from ..functions.codes import flag_of, type_of
from .staging import UNHELD, title_names

DEDUP_KEYS = ("accession_number", "transaction_date", "transaction_code", "transaction_shares")

# Amendment, then filing date, decide; these make the choice repeatable when both tie.
TIE_BREAK = (
    "cik", "price_per_share", "security_title", "shares_owned_after", "insider_name", "ownership_type",
    "issuer_ticker", "issuer_name", "issuer_cik", "officer_title", "insider_role", "quarter", "ingested_at",
)

# Columns of a deduplicated transaction, before its time dimensions.
ENRICHED = (
    "accession_number", "cik", "issuer_cik", "issuer_name", "issuer_ticker", "insider_name", "officer_title",
    "insider_role", "is_director", "is_officer", "is_ten_pct_owner", "transaction_date", "filing_date",
    "transaction_code", "transaction_type", "buy_sell_flag", "transaction_shares", "price_per_share",
    "transaction_value_usd", "shares_owned_after", "ownership_type", "security_title",
)

# Columns behind the time dimensions.
FILED = ("form_type", "quarter", "ingested_at")


def deduplicate(cleaned: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Keep one row per key: amendments first, then the latest filing.

    ``row_number() = 1`` lets Spark drop losers in every map task before the
    single shuffle, so even a group of copies holding a large share of the
    table arrives as one row per task. Pass issuer, owner, date and code as
    ``keys`` to let an amendment replace a filing with another accession. Share
    counts too large for their type are told apart as filed.
    """
    if "transaction_shares" in keys and UNHELD in cleaned.columns:
        keys = (*keys, UNHELD)
    order = [
        F.when(F.col("form_type") == schema.AMENDED_FORM, 1).otherwise(2),
        F.col("filing_date").desc_nulls_last(),
        *[F.col(name).asc_nulls_first() for name in TIE_BREAK],
    ]
    window = W.partitionBy(*keys).orderBy(*order)
    return cleaned.withColumn("_position", F.row_number().over(window)).where(F.col("_position") == 1).drop("_position")


def by_filing(raw: DataFrame) -> DataFrame:
    """Raw transactions dealt by accession number, for jobs that store what they deduplicate.

    ``deduplicate`` then needs no shuffle of its own, whatever keys hold the
    accession number. Rows travel as filed, before numbers and names are worked
    out, and those of a filing stay side by side in this shuffle, in the stored
    table and in the shuffles behind it. They pack so much better than rows
    dealt by all keys that moving every copy takes less. A filing has few rows,
    so no task gets many of one number.
    """
    return raw.where(F.col("transaction_code").isNotNull()).repartition("accession_number")


def enrich(transactions: DataFrame) -> DataFrame:
    day = F.col("transaction_date")
    return transactions.select(
        *ENRICHED,
        F.year(day).cast("bigint").alias("transaction_year"),
        F.month(day).cast("bigint").alias("transaction_month"),
        F.quarter(day).cast("bigint").alias("transaction_quarter"),
        month_key(day).alias("transaction_month_key"),
        quarter_key(day).alias("transaction_quarter_key"),
        days_to_file("filing_date", day).alias("days_to_file"),
        *FILED,
    )


def insider_transactions(cleaned: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Deduplicated, titled and enriched transactions from ``clean`` (or ``stage``) output.

    Only what a transaction keeps or is chosen by goes through the shuffle; what
    its code says is read from the code again behind it.
    """
    told = {"transaction_type": type_of("transaction_code"), "buy_sell_flag": flag_of("transaction_code")}
    told = {name: value for name, value in told.items() if name not in keys}
    moved = {*ENRICHED, *FILED, *TIE_BREAK, *keys, UNHELD} - set(told)
    kept = deduplicate(cleaned.select(*[name for name in cleaned.columns if name in moved]), keys)
    return enrich(title_names(kept.withColumns(told)))


# What an amendment has in common with the filing it replaces.
AMENDED_KEYS = ("issuer_cik", "insider_name", "transaction_date", "transaction_code")


def amendments(transactions: DataFrame, keys: Sequence[str] = AMENDED_KEYS) -> DataFrame:
    """Every transaction of a 4/A with the latest original transaction filed before it, or on its day, under the same keys.

    Originals and amendments are one stream in order of filing; the original
    last seen is carried on by a window, so nothing is compared pair by pair and
    a hot key is one sorted run that spills. NULL keys belong together. Of
    originals of one day the last by accession number, then by largest shares,
    counts. Without an original the columns named ``original_`` are NULL.
    """
    amended = F.col("form_type") == schema.AMENDED_FORM
    original = F.when(~amended, F.struct("accession_number", "filing_date", "transaction_shares", "transaction_value_usd"))
    order = (F.col("filing_date").asc_nulls_first(), F.when(amended, 1).otherwise(0), "accession_number", "transaction_shares", "transaction_value_usd")
    seen = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    linked = transactions.where(F.col("form_type").isNotNull()).withColumn("_original", F.last(original, ignorenulls=True).over(seen)).where(amended)
    return linked.select(
        "accession_number", *keys, "filing_date", "transaction_shares", "transaction_value_usd",
        F.col("_original.accession_number").alias("original_accession_number"),
        F.col("_original.filing_date").alias("original_filing_date"),
        F.col("_original.transaction_shares").alias("original_shares"),
        (F.col("transaction_value_usd") - F.col("_original.transaction_value_usd")).alias("value_change_usd"),
        F.datediff("filing_date", F.col("_original.filing_date")).cast("bigint").alias("days_to_amend"),
    )


def late_filings(transactions: DataFrame, days: int = 2) -> DataFrame:
    """Transactions filed later than the ``days``-day rule allows."""
    return transactions.where(F.col("days_to_file") > days)
