import datetime as dt

import pytest
from helpers import evaluated, plan_of
from pyspark.sql import functions as F

from ledgerline.functions import calendar, codes, markup, money, parse, text


def test_tag_value(spark):
    cases = {
        '<IssuerName x="1"> T &amp; Co </IssuerName>': "T &amp; Co",
        "<issuerName>\n  APPLE INC\t</issuerName>": "APPLE INC",
        "<issuerName><value> 5 </value><footnoteId/></issuerName>": "5",
        "<issuerName><VALUE a='b'>7</VALUE></issuerName>": "7",
        "<issuerName></issuerName>": None,
        "<issuerName>   </issuerName>": None,
        "<issuerName><value></value></issuerName>": "",
        "<issuerName><b>bold</b> name</issuerName>": "bold name",
        "<issuerName><b></b></issuerName>": None,
        "<issuerName>first</issuerName><issuerName>second</issuerName>": "first",
        "<issuerNameLong>prefix</issuerName>": "prefix",
        "<other>x</other>": None,
        "<issuerName>unclosed": None,
        "": None,
        None: None,
    }
    assert evaluated(spark, list(cases), lambda v: markup.tag_value(v, "issuerName")) == list(cases.values())


def test_long_and_broken_markup(spark):
    cases = {
        "<a>" + "<i>y" * 50_000 + "</A>": "<i>y" * 50_000, "<a>" * 20_000: "", "<" * 100_000 + "<ab c>x</a></a>": "x",
        "<a\n>x<a>y</a>": "x<a>y", "</a><a >x</a": "", "<a <b>x</a>": "x",
    }
    assert evaluated(spark, list(cases), lambda v: markup.tag_inner(v, "a")) == list(cases.values())
    assert evaluated(spark, ["<a>x<a>y</a></a><A>\n</a><a>z"], lambda v: markup.blocks(v, "a")) == [["x<a>y", "\n"]]


def test_tags_are_found_without_trying_every_character(spark):
    plan = plan_of(spark.range(1).selectExpr("string(id) as v").select(markup.tag_inner("v", "a"), markup.blocks("v", "a")))
    assert ".*?" not in plan


def test_blocks(spark):
    got = evaluated(spark, ["<b>1</b>x<B>\n2</B>", "<b a='1'>no</b>", "none"], lambda v: markup.blocks(v, "b"))
    assert got == [["1", "\n2"], [], []]


def test_parse_double(spark):
    cases = {
        "12345.67": 12345.67, "1000": 1000.0, "-500.5": -500.5, "1e5": 1e5, " 12 ": 12.0, "\t+.5\n": 0.5, "7.": 7.0,
        "1_000.5": 1000.5, "0": 0.0, "": None, "   ": None, "not-a-number": None, "1,000": None, "1.5d": None,
        "1.5f": None, "nan": None, "inf": None, "1e999": None, "1__0": None, "_1": None, "1 2": None, None: None,
    }
    assert evaluated(spark, list(cases), parse.parse_double) == list(cases.values())


def test_parse_date(spark):
    day = dt.date(2024, 3, 15)
    cases = {
        "2024-03-15": day, "03/15/2024": day, "20240315": day, "  2024-03-15  ": day, "\n03/15/2024\t": day,
        "2024-3-5": dt.date(2024, 3, 5), "3/5/2024": dt.date(2024, 3, 5), "2024315": day, "": None, "  ": None,
        "not-a-date": None, "2024-02-30": None, "2024-13-01": None, "2024-03-15T00:00:00": None,
        "2024-03-15-05:00": None, "24-03-15": None, "0000-01-01": None, "2024-03-15x": None, None: None,
    }
    assert evaluated(spark, list(cases), parse.parse_date) == list(cases.values())


def test_text(spark):
    assert evaluated(spark, ["\t a b \xa0\n", "", None], text.strip) == ["a b", "", None]
    assert evaluated(spark, [" ab "], text.strip_upper) == ["AB"]
    cases = {
        "o'BRIEN-SMITH jr./CO (A&B)": "O'brien-Smith Jr./Co (A&B)",
        "JPMORGAN CHASE & CO": "Jpmorgan Chase & Co",
        "a\tb\nc": "A\tB\nC",
        "x_y 1st": "X_Y 1st",
        "": "",
        None: None,
    }
    assert evaluated(spark, list(cases), text.title_case) == list(cases.values())
    assert evaluated(spark, list(cases), lambda v: text.title_case(text.title_case(v))) == list(cases.values())
    assert evaluated(spark, [bytearray(b"ok\xff")], text.decode_utf8, "binary") == ["ok�"]


def test_codes(spark):
    assert evaluated(spark, ["1", "0", "true", None], codes.is_set) == [True, False, False, False]
    assert evaluated(spark, [" p ", "S", "M", "G", "", "zz", None], codes.buy_sell_flag) == [
        "Buy", "Sell", "Exercise", "Gift", "Other", "Other", "Other",
    ]
    assert evaluated(spark, ["s", "P", "M", "G", "F", "A", "D", "x", "J"], codes.transaction_type) == [
        "Sale", "Purchase", "Option Exercise", "Gift", "Tax Withholding", "Grant/Award", "Sale Back to Issuer",
        "Option Exercise (Exempt)", "Other",
    ]
    assert evaluated(spark, [" i ", "D", " x ", None], codes.ownership_type) == ["Indirect", "Direct", " x ", None]
    assert evaluated(spark, [0.7, 0.5, 0.3, 0.29, None], codes.sentiment_label, "double") == [
        "Strong Buy Signal", "Moderate Buy Signal", "Moderate Sell Signal", "Strong Sell Signal", "Strong Sell Signal",
    ]
    flags = spark.createDataFrame([("1", "1", "1"), ("1", "0", "1"), ("0", "0", "1"), ("0", "0", None)],
                                  "is_director string, is_officer string, is_ten_pct_owner string")
    assert [r[0] for r in flags.select(codes.insider_role()).collect()] == ["Officer", "Director", "10% Owner", "Other"]


def test_calendar(spark):
    frame = spark.sql("select date'2024-03-31' d, date'2024-04-02' f")
    row = frame.select(
        calendar.month_key("d"), calendar.quarter_key("d"), calendar.days_to_file("f", "d"),
        calendar.quarter_label(F.year("f"), F.quarter("f")),
    ).first()
    assert tuple(row) == ("2024-03", "2024-Q1", 2, "2024Q2")


def test_exact_sum(spark):
    frame = spark.createDataFrame([(v,) for v in [0.1] * 10 + [0.2] * 5], "v double")
    assert frame.agg(money.exact_sum("v")).first()[0] == 2.0
    mixed = spark.createDataFrame([(1e30,), (0.25,), (None,)], "v double")
    assert mixed.agg(money.exact_sum("v")).first()[0] == pytest.approx(1e30)
    assert spark.createDataFrame([(None,)], "v double").agg(money.exact_sum("v"), money.exact_avg("v")).first() == (None, None)
    assert frame.agg(money.exact_avg("v")).first()[0] == 2.0 / 15


def test_ratio_by_zero(spark):
    assert spark.sql("select 1 a, 0 b").select(money.ratio("a", "b")).first()[0] is None


def test_sums_beyond_what_a_double_counts_exactly(spark):
    big = spark.createDataFrame([(2.0**53,), (1.0,), (-(2.0**53),), (1e25,), (-1e25,), (0.1,), (0.2,)], "v double").repartition(5)
    assert big.agg(money.exact_sum("v")).first()[0] == 1.3
    beyond = spark.createDataFrame([(9e35,)] * 200 + [(1.0,)], "v double")  # 1.8e40 cents have more than 38 digits
    assert beyond.agg(money.exact_sum("v")).first()[0] == pytest.approx(1.8e38)
    odd = spark.createDataFrame([(float("inf"),), (1.0,)], "v double")
    assert odd.agg(money.exact_sum("v")).first()[0] == float("inf")
