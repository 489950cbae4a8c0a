"""Queries over the published tables. Callers collect at most a feed or a top ten."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_sum, ratio
from .marts import TRADER_KEYS

FEED_LIMIT = 50
SENTIMENT_LIMIT = 100
TOP = 10

_SENTIMENT_ORDER = ("issuer_ticker", "issuer_name")


def _summed(value: str) -> Column:
    """Sum in which a group without values counts as 0."""
    return F.coalesce(exact_sum(value), F.lit(0.0)).alias(value)


# ── feeds ────────────────────────────────────────────────────────────────


def monthly_feed(monthly: DataFrame) -> DataFrame:
    """Newest month first. The further keys let the sort split a large month."""
    return monthly.drop("last_ingested_at").orderBy(
        F.col("transaction_month_key").desc_nulls_last(), "issuer_ticker", "issuer_name", "buy_sell_flag"
    )


def trader_feed(traders: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    """Traders ranked up to ``limit`` among buyers and among sellers, ties included."""
    return (
        traders.where(F.col("rank_by_value") <= limit)
        .drop("last_ingested_at")
        .orderBy("buy_sell_flag", "rank_by_value", *TRADER_KEYS)
    )


def sentiment_feed(sentiment: DataFrame, limit: int = SENTIMENT_LIMIT) -> DataFrame:
    """Companies with the largest net position either way."""
    return sentiment.orderBy(F.abs("net_value_usd").desc_nulls_last(), *_SENTIMENT_ORDER).limit(limit)


def company_list(monthly: DataFrame) -> DataFrame:
    return (
        monthly.where(F.col("issuer_ticker").isNotNull())
        .select("issuer_ticker", "issuer_name")
        .distinct()
        .orderBy("issuer_ticker", "issuer_name")
    )


# ── monthly figures ──────────────────────────────────────────────────────


def filter_activity(
    monthly: DataFrame, tickers: Sequence[str] = (), flag: str = "All", months: Sequence[str] = ()
) -> DataFrame:
    """Chosen companies and months (none chosen means all) and one flag or All."""
    if months:
        monthly = monthly.where(F.col("transaction_month_key").isin(*months))
    if tickers:
        monthly = monthly.where(F.col("issuer_ticker").isin(*tickers))
    return monthly if flag == "All" else monthly.where(F.col("buy_sell_flag") == flag)


def kpi_summary(monthly: DataFrame) -> DataFrame:
    """One row of headline figures; unique insiders is the largest monthly count."""
    flag, value = F.col("buy_sell_flag"), F.col("total_value_usd")
    totals = monthly.agg(
        *[
            F.coalesce(exact_sum(F.when(flag == name, value)), F.lit(0.0)).alias(f"total_{name.lower()}_value")
            for name in ("Buy", "Sell")
        ],
        F.sum("num_transactions").alias("total_transactions"),
        F.max("num_unique_insiders").alias("max_unique_insiders"),
    )
    return totals.withColumn("net_sentiment", F.col("total_buy_value") - F.col("total_sell_value")).withColumn(
        "signal", F.when(F.col("net_sentiment") > 0, F.lit("Bullish")).otherwise(F.lit("Bearish"))
    )


def monthly_volume(monthly: DataFrame) -> DataFrame:
    return (
        monthly.where(F.col("transaction_month_key").isNotNull())
        .groupBy("transaction_month_key")
        .agg(_summed("total_value_usd"), F.sum("num_transactions").alias("num_transactions"))
        .orderBy("transaction_month_key")
    )


def buy_sell_split(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("buy_sell_flag").agg(_summed("total_value_usd"))


def net_by_month(monthly: DataFrame, distinct: bool = False) -> DataFrame:
    """Net value per month.

    The net of a company's month stands on both its Buy and its Sell row, and
    by default both count, as dashboards show it; ``distinct`` counts it once.
    """
    keyed = monthly.where(F.col("transaction_month_key").isNotNull())
    if distinct:
        keyed = keyed.select("transaction_month_key", "issuer_ticker", "net_sentiment_usd").distinct()
    return keyed.groupBy("transaction_month_key").agg(_summed("net_sentiment_usd")).orderBy("transaction_month_key")


def top_companies(monthly: DataFrame, n: int = TOP) -> DataFrame:
    return (
        monthly.groupBy("issuer_ticker")
        .agg(
            _summed("total_value_usd"),
            F.sum("num_transactions").alias("num_transactions"),
            _summed("net_sentiment_usd"),
        )
        .orderBy(F.col("total_value_usd").desc(), "issuer_ticker")
        .limit(n)
    )


# ── traders ──────────────────────────────────────────────────────────────


def top_by_flag(feed: DataFrame, flag: str, n: int = TOP) -> DataFrame:
    """Top buyers or sellers of a trader feed."""
    return (
        feed.where(F.col("buy_sell_flag") == flag)
        .orderBy(F.col("total_value_usd").desc_nulls_last(), *TRADER_KEYS)
        .limit(n)
    )


def role_distribution(traders: DataFrame) -> DataFrame:
    """Rows per role and flag, of all traders or of a feed."""
    return traders.groupBy("insider_role", "buy_sell_flag").agg(F.count(F.lit(1)).alias("count"))


def role_rollup(traders: DataFrame) -> DataFrame:
    """Role distribution with the subtotal per role and the grand total."""
    return traders.rollup("insider_role", "buy_sell_flag").agg(F.count(F.lit(1)).alias("count"))


def leaderboard(feed: DataFrame) -> DataFrame:
    return feed.select(
        "insider_name", "issuer_ticker", "insider_role", "buy_sell_flag", "total_value_usd", "num_transactions", "rank_by_value"
    )


def top_sellers(transactions: DataFrame, as_of: dt.date, days: int = 90, n: int = TOP) -> DataFrame:
    """Insiders who sold the most shares in the ``days`` up to ``as_of``."""
    day = F.col("transaction_date")
    return (
        transactions.where(F.col("buy_sell_flag") == "Sell")
        .where((day > F.lit(as_of - dt.timedelta(days=days))) & (day <= F.lit(as_of)))
        .groupBy("insider_name")
        .agg(
            F.try_sum("transaction_shares").alias("total_shares"),
            exact_sum("transaction_value_usd").alias("total_value_usd"),
            F.count(F.lit(1)).alias("num_transactions"),
        )
        .orderBy(F.col("total_shares").desc_nulls_last(), "insider_name")
        .limit(n)
    )


# ── companies ────────────────────────────────────────────────────────────


def most_bullish(sentiment: DataFrame, n: int = TOP) -> DataFrame:
    return sentiment.orderBy(F.col("net_value_usd").desc_nulls_last(), *_SENTIMENT_ORDER).limit(n)


def most_bearish(sentiment: DataFrame, n: int = TOP) -> DataFrame:
    return sentiment.orderBy(F.col("net_value_usd").asc_nulls_last(), *_SENTIMENT_ORDER).limit(n)


def label_counts(sentiment: DataFrame) -> DataFrame:
    return (
        sentiment.where(F.col("sentiment_label").isNotNull())
        .groupBy("sentiment_label")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "sentiment_label")
    )


def sell_buy_ratio(sentiment: DataFrame) -> DataFrame:
    """Sells per buy of every company, highest first; NULL without buys."""
    sells = F.col("num_sell_transactions")
    return sentiment.select(
        *_SENTIMENT_ORDER,
        "num_buy_transactions",
        "num_sell_transactions",
        ratio(sells, "num_buy_transactions").alias("sell_buy_ratio"),
    ).orderBy(F.col("sell_buy_ratio").desc_nulls_last(), *_SENTIMENT_ORDER)
