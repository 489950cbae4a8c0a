import datetime as dt

from helpers import raw_rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators import marts, serving
from ledgerline.operators.dedup import amendments, insider_transactions, late_filings
from ledgerline.operators.ranking import with_ranks
from ledgerline.operators.staging import clean, stage
from ledgerline.plans.warehouse import build, open_marts
from ledgerline.sources.trade_tables import table

SMALL = "/root/testdata/sf0.001"


def transactions(spark, *rows):
    return insider_transactions(clean(raw_rows(spark, *rows)))


def test_header_rows_drop_and_blank_code_stays(spark):
    staged = stage(raw_rows(spark, {"transaction_code": None}, {"transaction_code": ""})).collect()
    assert [(r.transaction_type, r.buy_sell_flag) for r in staged] == [("Other", "Other")]


def test_staging_values(spark):
    row = stage(raw_rows(spark, {"issuer_name": " o'neil-smith CO ", "issuer_ticker": " ab ", "price_per_share": None})).first()
    assert (row.issuer_name, row.issuer_ticker, row.insider_name) == ("O'neil-Smith Co", "AB", "Doe Jane")
    assert row.transaction_value_usd is None and row.insider_role == "Officer"


def test_dedup_prefers_amendment_then_date_then_lowest_cik(spark):
    same = {"accession_number": "x"}
    rows = transactions(
        spark,
        {**same, "form_type": "4", "filing_date": dt.date(2024, 5, 1)},
        {**same, "form_type": "4/A", "filing_date": dt.date(2024, 3, 5)},
        {**same, "transaction_code": "S", "filing_date": dt.date(2024, 3, 2)},
        {**same, "transaction_code": "S", "filing_date": dt.date(2024, 3, 9)},
        {**same, "transaction_code": "G", "cik": "9"},
        {**same, "transaction_code": "G", "cik": "3"},
        {**same, "transaction_code": "G", "cik": "5"},
    ).collect()
    chosen = {r.transaction_code: r for r in rows}
    assert len(rows) == 3
    assert chosen["P"].form_type == "4/A"
    assert chosen["S"].filing_date == dt.date(2024, 3, 9) and chosen["S"].days_to_file == 8
    assert chosen["G"].cik == "3"


def test_dedup_with_own_keys_collapses_amendments(spark):
    raw = raw_rows(spark, {"form_type": "4"}, {"form_type": "4/A"})
    keys = ("issuer_cik", "insider_name", "transaction_date", "transaction_code")
    assert insider_transactions(clean(raw)).count() == 2
    assert [r.form_type for r in insider_transactions(clean(raw), keys).collect()] == ["4/A"]


def test_late_filings(spark):
    rows = transactions(spark, {"filing_date": dt.date(2024, 3, 3)}, {"filing_date": dt.date(2024, 3, 4)})
    assert [r.days_to_file for r in late_filings(rows).collect()] == [3]


def test_threshold_and_labels(spark):
    def company(ticker, buys, sells):
        return [{"issuer_ticker": ticker, "transaction_code": c} for c in ["P"] * buys + ["S"] * sells]

    rows = company("two", 1, 1) + company("t", 2, 1) + company("b7", 7, 3) + company("b5", 5, 5) + company("b3", 3, 7)
    labels = {r.issuer_ticker: r.sentiment_label for r in marts.company_sentiment(transactions(spark, *rows)).collect()}
    assert labels == {
        "T": "Moderate Buy Signal", "B7": "Strong Buy Signal", "B5": "Moderate Buy Signal", "B3": "Moderate Sell Signal",
    }


def test_unpriced_buys_have_null_value_and_rank_last(spark):
    rows = [{"issuer_ticker": "n", "price_per_share": None}] * 3
    rows += [{"issuer_ticker": t} for t in ("a", "b") for _ in range(3)]
    got = {r.issuer_ticker: r for r in marts.company_sentiment(transactions(spark, *rows)).collect()}
    assert (got["N"].total_buy_value_usd, got["N"].total_sell_value_usd, got["N"].net_value_usd) == (None, 0.0, None)
    assert [got[t].buy_rank for t in ("A", "B", "N")] == [1, 1, 3]
    assert {got[t].sell_rank for t in ("A", "B", "N")} == {1}


def test_tickers_missing(spark):
    rows = transactions(spark, {"issuer_ticker": None}, {"issuer_ticker": None}, {"issuer_ticker": None})
    assert marts.monthly_activity(rows).count() == 0
    assert marts.company_sentiment(rows).count() == 0
    assert marts.top_traders(rows).first().num_transactions == 3


def test_net_counts_twice_unless_distinct(spark):
    monthly = marts.monthly_activity(transactions(spark, {}, {"transaction_code": "S", "transaction_shares": 4.0}))
    assert {r.net_sentiment_usd for r in monthly.collect()} == {15.0}
    assert serving.net_by_month(monthly).first().net_sentiment_usd == 30.0
    assert serving.net_by_month(monthly, distinct=True).first().net_sentiment_usd == 15.0
    assert serving.filter_activity(monthly, (), "All").count() == 2
    assert serving.filter_activity(monthly, ("ACM",), "Sell").count() == 1
    assert serving.filter_activity(monthly, ("OTHER",)).count() == 0


def windowed_ranks(frame, ranks, within):
    group = F.col(within) if within else F.lit(0)
    return frame.select(
        "*", *[F.rank().over(W.partitionBy(group).orderBy(F.col(v).desc_nulls_last())).cast("bigint").alias(name) for name, v in ranks.items()]
    )


def test_ranks_equal_window_ranks(spark):
    orders = table(spark, SMALL, "orders")
    price = F.col("o_totalprice")
    frame = orders.select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(5000.0))  # a third of all rows tie
        .when(F.col("o_orderkey") % 50 == 1, F.lit(None))
        .when(F.col("o_orderkey") % 50 == 2, F.lit(0.0))
        .when(F.col("o_orderkey") % 50 == 4, -price)
        .when(F.col("o_orderkey") % 50 == 5, F.lit(float("inf")))
        .when(F.col("o_orderkey") % 50 == 7, F.lit(float("-inf")))
        .when(F.col("o_orderkey") % 50 == 8, F.lit(float("nan")))
        .when(F.col("o_orderkey") % 50 == 10, F.lit(-0.0))
        .otherwise(price)
        .alias("v"),
        (price % 10).alias("w"),
    ).withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    for within in (None, "o_orderstatus"):
        ranks = {"rv": "v", "rw": "w"}
        expected = windowed_ranks(frame, ranks, within)
        got = with_ranks(frame, ranks, within)
        assert got.columns == expected.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))  # as text, NaN equals itself


def test_one_dedup_group_with_a_third_of_all_rows(spark):
    copies = spark.range(30000).select(F.when(F.col("id") < 10000, 0).otherwise(F.col("id")).alias("id"))
    base = raw_rows(spark, {}).drop("accession_number", "cik")
    raw = copies.join(base).select(
        F.concat(F.lit("x"), "id").alias("accession_number"), F.col("id").cast("string").alias("cik"), *base.columns
    )
    assert insider_transactions(clean(raw)).count() == 20001


def test_totals_agree_across_tables(spark, tmp_path):
    from ledgerline.sources.trade_tables import raw_transactions

    raw = raw_transactions(spark, SMALL)
    rows = insider_transactions(clean(raw)).persist()
    stored = build(raw, str(tmp_path / "marts")).cache()
    traded = rows.where(F.col("buy_sell_flag").isin("Buy", "Sell"))
    assert stored.monthly.agg(F.sum("num_transactions")).first()[0] == traded.where("issuer_ticker is not null").count()
    assert stored.traders.agg(F.sum("num_transactions")).first()[0] == traded.where("transaction_value_usd is not null").count()
    assert stored.traders.agg(F.min("rank_by_value")).first()[0] == 1
    assert rows.select("accession_number", "transaction_date", "transaction_code", "transaction_shares").distinct().count() == rows.count()
    again = open_marts(spark, str(tmp_path / "marts"))
    assert again.monthly.columns == stored.monthly.columns
    assert sorted(again.monthly.collect(), key=str) == sorted(stored.monthly.collect(), key=str)
    stored.release()
    rows.unpersist()


def test_absurd_share_counts_do_not_end_the_marts(spark):
    rows = transactions(spark, *[{"transaction_shares": 9e28, "reporting_owner_name": f"n{i}"} for i in range(12)])
    assert marts.monthly_activity(rows).first().total_shares is None
    assert marts.company_sentiment(rows).first().total_buy_shares is None
    assert marts.top_traders(rows).count() == 12


def test_amendments_find_the_last_original_before_them(spark):
    def day(n):
        return dt.date(2024, 3, n)

    rows = transactions(
        spark,
        {"accession_number": "o1", "filing_date": day(2), "transaction_shares": 10.0},
        {"accession_number": "o2", "filing_date": day(4), "transaction_shares": 20.0},
        {"accession_number": "o3", "filing_date": day(4), "transaction_shares": 30.0},
        {"accession_number": "o9", "filing_date": day(9), "transaction_shares": 90.0},
        {"accession_number": "early", "form_type": "4/A", "filing_date": day(1)},
        {"accession_number": "same", "form_type": "4/A", "filing_date": day(2)},
        {"accession_number": "later", "form_type": "4/A", "filing_date": day(6), "transaction_shares": 31.0},
        {"accession_number": "again", "form_type": "4/A", "filing_date": day(7)},
        {"accession_number": "other", "form_type": "4/A", "filing_date": day(7), "reporting_owner_name": "someone else"},
        {"accession_number": "nobody's", "form_type": "4/A", "filing_date": day(7), "issuer_cik": None},
        {"accession_number": "nobody's own", "filing_date": day(5), "issuer_cik": None},
    )
    found = {r.accession_number: r for r in amendments(rows).collect()}
    assert {a: r.original_accession_number for a, r in found.items()} == {
        "early": None, "same": "o1", "later": "o3", "again": "o3", "other": None, "nobody's": "nobody's own",
    }
    assert (found["later"].days_to_amend, found["later"].value_change_usd, found["early"].days_to_amend) == (2, 2.5, None)


def test_a_hot_key_of_amendments_is_one_pass(spark):
    base = raw_rows(spark, {}).drop("accession_number", "form_type")
    raw = spark.range(20_000).join(base).selectExpr(
        "concat('x', lpad(id, 6, '0')) as accession_number", "if(id % 2 = 1, '4/A', '4') as form_type", *base.columns
    )
    linked = amendments(insider_transactions(clean(raw)))
    assert linked.count() == 10_000 and linked.where("original_accession_number is null").count() == 0
