"""Raw rows to cleaned, classified transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import flag_of, insider_role, is_set, ownership_type, type_of
from ..functions.money import transaction_value
from ..functions.text import strip, strip_upper, title_case

# Shares as filed, where they do not fit the type of transaction_shares.
UNHELD = "unheld_shares"
SHARES = "decimal(38,9)"

# Raw columns that are trimmed, and those in upper case too.
_TRIMMED = ("cik", "issuer_cik", "issuer_name", "company_name", "reporting_owner_name", "officer_title")
_UPPER = ("issuer_ticker", "transaction_code", "security_title")

NAMES = ("issuer_name", "filer_company_name", "insider_name", "officer_title")


def stage(raw: DataFrame) -> DataFrame:
    """One row per transaction; header-only rows (no code) are dropped. Map-only."""
    return title_names(clean(raw)).drop(UNHELD)


def title_names(transactions: DataFrame) -> DataFrame:
    """Title-case whichever name columns are there."""
    return transactions.select(
        *[title_case(name).alias(name) if name in NAMES else F.col(name) for name in transactions.columns]
    )


def clean(raw: DataFrame) -> DataFrame:
    """``stage`` with names trimmed but still as filed.

    Title casing costs more than the rest of staging together, so jobs that
    drop duplicates leave it until those are gone. Shares that do not fit stay
    in UNHELD: ``deduplicate`` keeps such rows apart, ``quality.unheld`` counts them.
    """
    shares = F.col("transaction_shares").try_cast(SHARES)
    trimmed = raw.where(F.col("transaction_code").isNotNull()).withColumns(
        {name: strip(name) for name in _TRIMMED} | {name: strip_upper(name) for name in _UPPER}
    )
    return trimmed.select(
        "accession_number",
        "cik",
        "issuer_cik",
        "issuer_name",
        "issuer_ticker",
        F.col("company_name").alias("filer_company_name"),
        F.col("reporting_owner_name").alias("insider_name"),
        "officer_title",
        is_set("is_director").alias("is_director"),
        is_set("is_officer").alias("is_officer"),
        is_set("is_ten_pct_owner").alias("is_ten_pct_owner"),
        insider_role().alias("insider_role"),
        "transaction_date",
        "filing_date",
        "period_of_report",
        "transaction_code",
        type_of("transaction_code").alias("transaction_type"),
        shares.alias("transaction_shares"),
        "price_per_share",
        "shares_owned_after",
        transaction_value("transaction_shares", "price_per_share").alias("transaction_value_usd"),
        ownership_type("direct_or_indirect").alias("ownership_type"),
        "security_title",
        flag_of("transaction_code").alias("buy_sell_flag"),
        "form_type",
        "quarter",
        "ingested_at",
        F.when(shares.isNull(), F.col("transaction_shares")).alias(UNHELD),
    )
