"""The three published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.codes import sentiment_label
from ..functions.money import PRICE_UNITS, exact_sum, ratio, when_flag
from ..schema import TRADED_FLAGS
from ..sources.scratch import written
from .ranking import with_ranks
from .staging import SHARES

MONTHLY_KEYS = (
    "transaction_month_key", "transaction_year", "transaction_month", "issuer_ticker", "issuer_name", "buy_sell_flag",
)
TRADER_KEYS = ("insider_name", "issuer_ticker", "issuer_name", "insider_role", "officer_title", "buy_sell_flag")
COMPANY_KEYS = ("issuer_ticker", "issuer_name")

# Fewest buys and sells for a company to be rated.
ACTIVITY_THRESHOLD = 3


def _traded(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("buy_sell_flag").isin(*TRADED_FLAGS))


def net_over(window) -> Column:
    """Buys minus sells over a window of monthly rows."""
    buys = exact_sum(when_flag("Buy", "total_value_usd"), window=window)
    return buys - exact_sum(when_flag("Sell", "total_value_usd"), window=window)


def filing_months(transactions: DataFrame, *also: str) -> DataFrame:
    """State of the monthly table: month x company x flag x filing x insider, and ``also``.

    Hardly any rows are alike in all of these, so they are dealt by filing and
    insider as they are, which is less to move than sums: lines of a filing stay
    side by side. Sorted by company and month they are grouped faster, and the
    groups leave in that order, so that the rows of the next shuffle, which
    differ in little else than filing or insider, pack well.
    """
    return (
        _traded(transactions)
        .where(F.col("issuer_ticker").isNotNull())
        .repartition("accession_number", "insider_name")
        .sortWithinPartitions("issuer_ticker", "transaction_month_key", "buy_sell_flag")
        .groupBy(*MONTHLY_KEYS, "accession_number", "insider_name", *also)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.try_sum("transaction_shares").alias("shares"),
            exact_sum("transaction_value_usd").alias("value"),
            exact_sum("price_per_share", PRICE_UNITS).alias("price"),
            F.count("price_per_share").alias("priced"),
            F.max("transaction_value_usd").alias("largest"),
            F.max("ingested_at").alias("loaded"),
        )
    )


def merged_months(per_filing: DataFrame) -> DataFrame:
    """Month x company x flag, from any number of state rows for each."""
    return per_filing.groupBy(*MONTHLY_KEYS).agg(
        F.countDistinct("accession_number").alias("num_filings"),
        F.countDistinct("insider_name").alias("num_unique_insiders"),
        F.sum("rows").alias("num_transactions"),
        F.try_sum("shares").cast(SHARES).alias("total_shares"),
        exact_sum("value").alias("total_value_usd"),
        F.try_divide(exact_sum("price", PRICE_UNITS), F.sum("priced")).alias("avg_price_per_share"),
        F.max("largest").alias("max_single_transaction_usd"),
        F.max("loaded").alias("last_ingested_at"),
    )


def monthly_totals(transactions: DataFrame) -> DataFrame:
    """Month x company x flag.

    Aggregated per filing and insider first: the two distinct counts, which
    copy every row they see, then see few.
    """
    return merged_months(filing_months(transactions))


def with_net(totals: DataFrame) -> DataFrame:
    """Monthly rows with the net value of the company's month on each."""
    return totals.withColumn("net_sentiment_usd", net_over(W.partitionBy("issuer_ticker", "transaction_month_key")))


def monthly_activity(transactions: DataFrame) -> DataFrame:
    """Month x company x flag, with the net value of the company's month on each row."""
    return with_net(monthly_totals(transactions))


def by_trader(rows: DataFrame) -> DataFrame:
    """Rows dealt by what the trader table has a row for: whatever is added up by that, or by that and more, needs no other shuffle.

    An insider has few transactions in one role at one company, and most in
    other months, so adding up before the shuffle would leave nearly as many.
    """
    return rows.repartition(*TRADER_KEYS)


def trader_months(transactions: DataFrame, *also: str) -> DataFrame:
    """State of the trader table: insider x company x role x flag x month, and ``also``; valued transactions only."""
    return (
        by_trader(_traded(transactions).where(F.col("transaction_value_usd").isNotNull()))
        .groupBy(*TRADER_KEYS, "transaction_month_key", *also)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.try_sum("transaction_shares").alias("shares"),
            exact_sum("transaction_value_usd").alias("value"),
            F.max("transaction_value_usd").alias("largest"),
            F.min("transaction_date").alias("first"),
            F.max("transaction_date").alias("last"),
            F.max("ingested_at").alias("loaded"),
        )
    )


def merged_traders(per_month: DataFrame) -> DataFrame:
    """Insider x company x role x flag, from any number of state rows for each; see ``by_trader``."""
    return per_month.groupBy(*TRADER_KEYS).agg(
        F.sum("rows").alias("num_transactions"),
        F.countDistinct("transaction_month_key").alias("num_active_months"),
        F.try_sum("shares").cast(SHARES).alias("total_shares"),
        exact_sum("value").alias("total_value_usd"),
        F.try_divide(exact_sum("value"), F.sum("rows")).alias("avg_transaction_value_usd"),
        F.max("largest").alias("max_transaction_value_usd"),
        F.min("first").alias("first_transaction_date"),
        F.max("last").alias("last_transaction_date"),
        F.max("loaded").alias("last_ingested_at"),
    )


def trader_totals(transactions: DataFrame) -> DataFrame:
    """Insider x company x role x flag, valued transactions only."""
    return merged_traders(trader_months(transactions))


def ranked_traders(totals: DataFrame) -> DataFrame:
    return with_ranks(totals, {"rank_by_value": "total_value_usd"}, within="buy_sell_flag")


def top_traders(transactions: DataFrame) -> DataFrame:
    """Trader totals ranked by value among buyers and among sellers.

    Ranks look at the totals twice, so these are written first.
    """
    return ranked_traders(written(trader_totals(transactions), "trader-totals")[0])


def insider_companies(transactions: DataFrame, *also: str) -> DataFrame:
    """State of the company table: ticker x issuer name x insider, and ``also``."""
    return (
        _traded(transactions)
        .where(F.col("issuer_ticker").isNotNull())
        .groupBy(*COMPANY_KEYS, "insider_name", *also)
        .agg(
            *[
                total
                for flag in TRADED_FLAGS
                for total in (
                    F.count_if(F.col("buy_sell_flag") == flag).alias(f"{flag}_rows"),
                    F.try_sum(when_flag(flag, "transaction_shares")).alias(f"{flag}_shares"),
                    exact_sum(when_flag(flag, "transaction_value_usd")).alias(f"{flag}_value"),
                )
            ],
            F.min("transaction_date").alias("first"),
            F.max("transaction_date").alias("last"),
            F.max("ingested_at").alias("loaded"),
        )
    )


def merged_insiders(state: DataFrame) -> DataFrame:
    """One row per company and insider, from one for each quarter."""
    return state.groupBy(*COMPANY_KEYS, "insider_name").agg(
        *[
            total
            for flag in TRADED_FLAGS
            for total in (
                F.sum(f"{flag}_rows").alias(f"{flag}_rows"),
                F.try_sum(f"{flag}_shares").cast(SHARES).alias(f"{flag}_shares"),
                exact_sum(f"{flag}_value").alias(f"{flag}_value"),
            )
        ],
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("loaded").alias("loaded"),
    )


def merged_companies(per_insider: DataFrame) -> DataFrame:
    """Ticker x issuer name, from one row for each insider."""
    insider = F.col("insider_name")
    return per_insider.groupBy(*COMPANY_KEYS).agg(
        *[
            total
            for flag in TRADED_FLAGS
            for total in (
                F.sum(f"{flag}_rows").alias(f"num_{flag.lower()}_transactions"),
                F.try_sum(f"{flag}_shares").cast(SHARES).alias(f"total_{flag.lower()}_shares"),
                exact_sum(f"{flag}_value").alias(f"total_{flag.lower()}_value_usd"),
            )
        ],
        F.count(insider).alias("num_unique_insiders"),
        F.count(F.when(F.col("Buy_rows") > 0, insider)).alias("num_buyers"),
        F.count(F.when(F.col("Sell_rows") > 0, insider)).alias("num_sellers"),
        F.min("first").alias("earliest_transaction"),
        F.max("last").alias("latest_transaction"),
        F.max("loaded").alias("last_ingested_at"),
    )


def company_totals(transactions: DataFrame) -> DataFrame:
    """Ticker x issuer name, unrated and unfiltered.

    Aggregated per insider first: distinct insiders are then plain counts, so
    rows are not expanded once per distinct count, and a company with a large
    share of the table is spread over its insiders.
    """
    return merged_companies(insider_companies(transactions))


def company_sentiment(transactions: DataFrame) -> DataFrame:
    """Companies with enough activity: net position, buy ratio, label, ranks.

    Ranks look at the totals three times, so these are written first.
    """
    return rated_companies(written(company_totals(transactions), "company-totals")[0])


def rated_companies(totals: DataFrame) -> DataFrame:
    buys, sells = F.col("num_buy_transactions"), F.col("num_sell_transactions")
    rated = (
        totals
        .where(buys + sells >= ACTIVITY_THRESHOLD)
        .withColumn("net_value_usd", F.col("total_buy_value_usd") - F.col("total_sell_value_usd"))
        .withColumn("buy_ratio", ratio(buys, buys + sells))
        .withColumn("sentiment_label", sentiment_label("buy_ratio"))
    )
    return with_ranks(rated, {"sell_rank": "total_sell_value_usd", "buy_rank": "total_buy_value_usd"})
