"""Every operator as a query over the trade tables of a folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema
from .functions import calendar, codes, markup, money, parse, text
from .operators import marts, quality, serving, shred
from .operators.dedup import amendments, insider_transactions, late_filings
from .operators.staging import clean, stage
from .plans import incremental
from .plans.cache import ResultCache, version_of
from .plans.ingest import ingest, ingest_tree
from .plans.publication import open_served, publish
from .plans.warehouse import Marts, audit_all, build, open_marts, open_transactions
from .session import bounded_tasks
from .sinks import tables
from .sources import documents, index, landing, tree
from .sources.scratch import exists, fresh_path
from .sources.trade_tables import filing_documents, index_lines, mirrored_documents, raw_transactions, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RUN_TS = dt.datetime(2002, 1, 1)
FRESH_AS_OF = dt.date(2001, 10, 1)
QUARTERS_AS_OF = dt.date(2001, 5, 15)
SELLERS_AS_OF = dt.date(2001, 6, 30)
EXPORT_DAY = dt.date(2002, 1, 1)
SELECTED_QUARTERS = ("1996Q1", "1999Q3")
SELECTED_MONTHS = ("1996-03", "1997-11")
SELECTED_TICKERS = ("N1", "N2", "N7")
FILINGS_PER_QUARTER = 100
BUCKETS = 8


def portable(frame: DataFrame) -> DataFrame:
    """Types every SQL engine reports alike: days and stamps as text, numbers as bigint or double."""

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.DecimalType | T.FloatType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.ByteType | T.ShortType | T.IntegerType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return frame.select(*[column(field) for field in frame.schema.fields])


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(spark, folder))

    QUERIES[function.__name__] = run
    return function


def tally(frame: DataFrame, *columns: Column) -> DataFrame:
    """Rows per distinct combination: all rows are evaluated, few are returned."""
    named = frame.select(*columns)
    return named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("rows"))


# ── shared inputs ────────────────────────────────────────────────────────

raw = raw_transactions


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return stage(raw(spark, folder))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return insider_transactions(clean(raw(spark, folder)))


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_activity(transactions(spark, folder))


def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return marts.company_sentiment(transactions(spark, folder))


# Tables that filings are derived from.
_SOURCES = ("lineitem", "orders", "customer", "nation")

_published: dict[tuple[str, str], tuple[str, Marts, DataFrame]] = {}
_versions: dict[tuple[str, str], str] = {}


def published(spark: SparkSession, folder: str) -> Marts:
    """The stored tables of a folder, read by every serving query: landed and built once per application and state of its files."""
    key = (spark.sparkContext.applicationId, folder)
    version = version_of(spark, [f"{folder}/{name}.parquet" for name in _SOURCES])
    if key in _published and _versions[key] == version:
        root, like, _ = _published[key]
        if exists(spark, root):  # else somebody cleared the shared folder
            return open_marts(spark, root, like)
    root = fresh_path(spark, "published")
    tables.write_raw(raw(spark, folder), f"{root}/raw")
    landed = landing.read_raw(spark, f"{root}/raw")
    stored = build(landed, root)
    _published[key] = (root, stored, insider_transactions(clean(landed)))
    _versions[key] = version
    return stored


def _root(spark: SparkSession, folder: str) -> str:
    published(spark, folder)
    return _published[spark.sparkContext.applicationId, folder][0]


def published_transactions(spark: SparkSession, folder: str) -> DataFrame:
    root = _root(spark, folder)
    return open_transactions(spark, root, _published[spark.sparkContext.applicationId, folder][2])


def trader_feed(spark: SparkSession, folder: str) -> DataFrame:
    return serving.trader_feed(published(spark, folder).traders)


def sentiment_feed(spark: SparkSession, folder: str) -> DataFrame:
    return serving.sentiment_feed(published(spark, folder).sentiment)


def landed_raw(spark: SparkSession, folder: str) -> str:
    root = fresh_path(spark, "raw")
    tables.write_raw(raw(spark, folder), root)
    return root


def landed_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index lines read from text files, one directory per quarter."""
    root = fresh_path(spark, "index")
    _write_index(spark, folder, root)
    return index.read_index_lines(spark, root)


def _write_index(spark: SparkSession, folder: str, root: str) -> None:
    with bounded_tasks(spark):
        index_lines(spark, folder).write.partitionBy("quarter").option("compression", "gzip").text(root)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return index.parse_index(landed_index(spark, folder))


def per_quarter(frame: DataFrame) -> DataFrame:
    return frame.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("accession_number").alias("filings"),
        F.try_sum(F.col("transaction_shares").cast("decimal(38,9)")).alias("shares"),
    )


# ── sources ──────────────────────────────────────────────────────────────


@query
def index_parse(spark, folder):
    return index.parse_index(index_lines(spark, folder))


@query
def index_files(spark, folder):
    """The same listings from index files."""
    return listings(spark, folder)


@query
def documents_scan(spark, folder):
    """Bytes with an invalid tail, decoded."""
    content = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))
    decoded = table(spark, folder, "documents").select("doc_id", text.decode_utf8(content).alias("text"))
    return decoded.select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query
def raw_scan(spark, folder):
    return landing.read_raw(spark, landed_raw(spark, folder))


@query
def available_quarters(spark, folder):
    return landing.available_quarters(spark, landed_raw(spark, folder))


@query
def load_selected_quarters(spark, folder):
    return per_quarter(landing.read_raw(spark, landed_raw(spark, folder), SELECTED_QUARTERS))


def _years(spark, folder):
    return table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"))


@query
def quarters_to_process(spark, folder):
    return landing.quarters_to_process(_years(spark, folder), QUARTERS_AS_OF)


@query
def quarters_restricted(spark, folder):
    return landing.quarters_to_process(_years(spark, folder), QUARTERS_AS_OF, (1, 2))


@query
def pending_quarters(spark, folder):
    """Listings of the quarters that are due and have not landed, read from index files of these quarters only."""
    lines_root, landed_root = fresh_path(spark, "index"), fresh_path(spark, "raw")
    _write_index(spark, folder, lines_root)
    tables.write_raw(raw(spark, folder).where(F.col("quarter") < "1997Q1"), landed_root)
    due = landing.quarters_to_process(_years(spark, folder), QUARTERS_AS_OF)
    due = due.select(calendar.quarter_label("year", "quarter").alias("quarter"))
    waiting = landing.pending(due, landing.available_quarters(spark, landed_root))
    return index.parse_index(landing.of_quarters(index.read_partitioned_lines(spark, lines_root), waiting))


@query
def index_join_documents(spark, folder):
    counted = filing_documents(spark, folder).select(
        "accession_number", F.size(markup.blocks("xml", "nonDerivativeTransaction")).alias("transactions")
    )
    joined = documents.with_documents(listings(spark, folder), counted)
    return joined.select("accession_number", "cik", "company_name", "form_type", "filing_date", "quarter", "transactions")


@query
def missing_documents(spark, folder):
    return documents.without_documents(listings(spark, folder), filing_documents(spark, folder))


def _doubtful_documents(spark, folder):
    """Documents of which some are blank and some unreadable."""
    pending = F.col("o_orderstatus") == "P"
    body = (
        F.when(pending & (F.col("o_orderpriority") == "2-HIGH"), F.lit(" \n\t "))
        .when(pending & (F.col("o_orderpriority") == "5-LOW"), F.lit(None))
        .otherwise(F.col("xml"))
    )
    return filing_documents(spark, folder).withColumn("xml", body)


@query
def quarantine(spark, folder):
    return documents.rejected_documents(_doubtful_documents(spark, folder))


@query
def ingest_report(spark, folder):
    return documents.arrivals(listings(spark, folder), _doubtful_documents(spark, folder))


def packed_documents(spark: SparkSession, folder: str) -> str:
    root = fresh_path(spark, "documents")
    tables.write_documents(mirrored_documents(spark, folder), root)
    return root


@query
def documents_read(spark, folder):
    """Packed documents of chosen quarters, copies included."""
    rows = documents.read_packed_documents(spark, packed_documents(spark, folder), SELECTED_QUARTERS)
    return rows.select("accession_number", "path", "quarter", F.size(markup.blocks("xml", "nonDerivativeTransaction")).alias("transactions"))


def _tree_path(accession):
    """Where an index says a document is: its owner's folder, by the last part of the accession number."""
    owner = F.substring_index(accession, "-", -1).cast("bigint").cast("string")
    return F.concat(F.lit("edgar/data/"), owner, F.lit("/"), accession, F.lit(".txt"))


def document_tree(spark: SparkSession, folder: str) -> str:
    """Document files as an archive keeps them, a folder per owner, in bundles: millions of small files would take a disk block each."""
    root = fresh_path(spark, "tree")
    tree.write_bundles(filing_documents(spark, folder).withColumn("path", _tree_path(F.col("accession_number"))), root)
    return root


@query
def documents_tree(spark, folder):
    """Listed documents read from their files."""
    rows = tree.read_listed(spark, document_tree(spark, folder), listings(spark, folder))
    return rows.select("accession_number", F.size(markup.blocks("xml", "nonDerivativeTransaction")).alias("transactions"), "problem")


@query
def ingest_files(spark, folder):
    """Index files and document files to landed quarters."""
    root = fresh_path(spark, "landing")
    ingest_tree(landed_index(spark, folder), document_tree(spark, folder), root, RUN_TS)
    return per_quarter(landing.read_raw(spark, root))


@query
def ingest_counts(spark, folder):
    """What became of every listing, counted by the run that landed them."""
    done = ingest(landed_index(spark, folder), _doubtful_documents(spark, folder), fresh_path(spark, "landing"), RUN_TS)
    return spark.createDataFrame([(name, getattr(done, name)) for name in shred.OUTCOMES], "outcome string, filings bigint")


@query
def ingest_pathless(spark, folder):
    """Packed documents that never had a path."""
    packed, root = fresh_path(spark, "documents"), fresh_path(spark, "landing")
    tables.write_documents(filing_documents(spark, folder), packed)
    ingest(landed_index(spark, folder), documents.read_packed_documents(spark, packed), root, RUN_TS)
    return per_quarter(landing.read_raw(spark, root))


@query
def max_filings(spark, folder):
    return index.first_filings(listings(spark, folder), FILINGS_PER_QUARTER)


@query
def union_quarters(spark, folder):
    """Raw rows appended listing by listing, counted per quarter."""
    rows = raw(spark, folder)
    by_issuer = F.col("cik").startswith("I")
    return per_quarter(rows.where(by_issuer).unionByName(rows.where(~by_issuer)))


# ── shredding ────────────────────────────────────────────────────────────


@query
def tag_value_pages(spark, folder):
    page = table(spark, folder, "pages")
    return page.select(
        "page_id",
        *[markup.tag_value("html", tag).alias(tag) for tag in ("title", "h1", "li", "article", "absent")],
    )


@query
def block_split(spark, folder):
    items = markup.blocks("html", "li")
    return table(spark, folder, "pages").select(
        "page_id", F.size(items).alias("items"), F.md5(F.array_join(items, "|")).alias("digest")
    )


@query
def shred_filings(spark, folder):
    return shred.shred_filings(listings(spark, folder), filing_documents(spark, folder), RUN_TS)


@query
def ingest_landing(spark, folder):
    """Index and documents to landed quarters, then read back."""
    root = fresh_path(spark, "landing")
    ingest(landed_index(spark, folder), filing_documents(spark, folder), root, RUN_TS)
    return per_quarter(landing.read_raw(spark, root))


@query
def ingest_restricted(spark, folder):
    """Chosen quarters of an archive with two copies of every document."""
    root = fresh_path(spark, "landing")
    packed = documents.read_packed_documents(spark, packed_documents(spark, folder))
    ingest(landed_index(spark, folder), packed, root, RUN_TS, quarters=SELECTED_QUARTERS)
    return per_quarter(landing.read_raw(spark, root))


# ── column functions ─────────────────────────────────────────────────────

_TEXT_COLUMNS = ("issuer_name", "issuer_ticker", "transaction_code", "direct_or_indirect", "security_title")


@query
def str_trim(spark, folder):
    return tally(raw(spark, folder), *[text.strip(name).alias(name) for name in _TEXT_COLUMNS])


@query
def str_upper(spark, folder):
    return tally(raw(spark, folder), *[text.strip_upper(name).alias(name) for name in _TEXT_COLUMNS])


@query
def title_case(spark, folder):
    names = [
        table(spark, folder, name).select(F.col(column).alias("name"))
        for name, column in (
            ("part", "p_name"), ("part", "p_type"), ("orders", "o_orderpriority"), ("pages", "url"),
            ("customer", "c_name"), ("events", "props"),
        )
    ]
    rows = names[0]
    for more in names[1:]:
        rows = rows.unionByName(more)
    return tally(rows, F.col("name"), text.title_case("name").alias("titled"))


@query
def flag_cast(spark, folder):
    flags = ("is_director", "is_officer", "is_ten_pct_owner")
    return tally(raw(spark, folder), *[codes.is_set(name).alias(name) for name in flags])


@query
def insider_role(spark, folder):
    return tally(raw(spark, folder), codes.insider_role().alias("insider_role"))


@query
def transaction_type(spark, folder):
    return tally(
        raw(spark, folder), F.col("transaction_code"), codes.transaction_type("transaction_code").alias("transaction_type")
    )


@query
def buy_sell_flag(spark, folder):
    return tally(
        raw(spark, folder), F.col("transaction_code"), codes.buy_sell_flag("transaction_code").alias("buy_sell_flag")
    )


@query
def ownership_type(spark, folder):
    return tally(raw(spark, folder), codes.ownership_type("direct_or_indirect").alias("ownership_type"))


def _dates_as_text(spark, folder):
    """Order dates in every layout a filing may use, and in some it may not."""
    day = F.col("o_orderdate").cast("date")
    form = F.col("o_orderkey") % 9
    layouts = {
        0: F.date_format(day, "yyyy-MM-dd"),
        1: F.date_format(day, "MM/dd/yyyy"),
        2: F.date_format(day, "yyyyMMdd"),
        3: F.concat(F.lit("  "), F.date_format(day, "yyyy-MM-dd"), F.lit(" ")),
        4: F.date_format(day, "yyyy-M-d"),
        5: F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
        6: F.date_format(day, "yyyy-02-30"),
        7: F.lit(""),
    }
    shown = F.lit("not-a-date")
    for number, layout in layouts.items():
        shown = F.when(form == number, layout).otherwise(shown)
    return table(spark, folder, "orders").select(shown.alias("shown"))


@query
def safe_date(spark, folder):
    return tally(_dates_as_text(spark, folder), F.col("shown"), parse.parse_date("shown").alias("day"))


def _numbers_as_text(spark, folder):
    """Line prices as plain, padded, scientific and malformed text."""
    price = F.col("l_extendedprice").cast("string")
    layouts = {
        1: price,
        2: F.concat(F.lit(" "), price, F.lit(" ")),
        3: F.concat(F.lit("-"), price),
        4: F.concat(price, F.lit("e2")),
        5: F.concat(price, F.lit("d")),
        6: F.concat(F.lit("1,"), price),
    }
    shown = F.lit("not-a-number")
    for number, layout in layouts.items():
        shown = F.when(F.col("l_linenumber") == number, layout).otherwise(shown)
    return table(spark, folder, "lineitem").select(shown.alias("shown"))


@query
def safe_double(spark, folder):
    return tally(_numbers_as_text(spark, folder), F.col("shown"), parse.parse_double("shown").alias("number"))


@query
def quarter_label(spark, folder):
    day = F.col("o_orderdate")
    return tally(table(spark, folder, "orders"), calendar.quarter_label(F.year(day), F.quarter(day)).alias("quarter"))


@query
def date_parts(spark, folder):
    return tally(
        transactions(spark, folder),
        F.col("transaction_year"),
        F.col("transaction_month"),
        F.col("transaction_quarter"),
    )


@query
def month_key(spark, folder):
    return tally(transactions(spark, folder), F.col("transaction_month_key"))


@query
def quarter_key(spark, folder):
    return tally(transactions(spark, folder), F.col("transaction_quarter_key"))


@query
def days_to_file(spark, folder):
    return tally(transactions(spark, folder), F.col("days_to_file"))


@query
def late_filers(spark, folder):
    """Late transactions per insider role."""
    rows = transactions(spark, folder)
    return late_filings(rows).groupBy("insider_role").agg(
        F.count(F.lit(1)).alias("late"),
        F.countDistinct("accession_number").alias("filings"),
        F.max("days_to_file").alias("latest_days"),
    )


@query
def shares_decimal(spark, folder):
    return tally(staged(spark, folder), F.col("transaction_shares"))


@query
def transaction_value(spark, folder):
    value = money.transaction_value("transaction_shares", "price_per_share")
    return raw(spark, folder).select(
        "accession_number", "cik", "transaction_date", "transaction_shares", value.alias("transaction_value_usd")
    )


# ── staging, deduplication, marts ────────────────────────────────────────


@query
def stg_transactions(spark, folder):
    return staged(spark, folder)


@query
def int_transactions(spark, folder):
    return transactions(spark, folder)


@query
def amended_transactions(spark, folder):
    """Transactions of amendments with the original they replace."""
    return amendments(transactions(spark, folder))


@query
def dedup_counts(spark, folder):
    return tally(transactions(spark, folder), F.col("form_type"), F.col("buy_sell_flag"))


@query
def monthly_activity(spark, folder):
    return monthly(spark, folder)


@query
def net_sentiment(spark, folder):
    return (
        monthly(spark, folder)
        .select("issuer_ticker", "transaction_month_key", "net_sentiment_usd")
        .distinct()
    )


@query
def top_traders(spark, folder):
    return marts.top_traders(transactions(spark, folder))


@query
def company_sentiment(spark, folder):
    return sentiment(spark, folder)


@query
def buyers_sellers(spark, folder):
    return marts.company_totals(transactions(spark, folder)).select(
        "issuer_ticker", "issuer_name", "num_unique_insiders", "num_buyers", "num_sellers"
    )


@query
def buy_ratio(spark, folder):
    buys, sells = F.col("num_buy_transactions"), F.col("num_sell_transactions")
    return marts.company_totals(transactions(spark, folder)).select(
        "issuer_ticker", "issuer_name", money.ratio(buys, buys + sells).alias("buy_ratio")
    )


@query
def sentiment_label(spark, folder):
    return sentiment(spark, folder).select("issuer_ticker", "issuer_name", "buy_ratio", "sentiment_label")


# ── serving ──────────────────────────────────────────────────────────────


@query
def monthly_ordered(spark, folder):
    return serving.monthly_feed(published(spark, folder).monthly)


@query
def top_traders_limited(spark, folder):
    return trader_feed(spark, folder)


@query
def sentiment_top100(spark, folder):
    return sentiment_feed(spark, folder)


@query
def company_list(spark, folder):
    return serving.company_list(published(spark, folder).monthly)


@query
def activity_filtered(spark, folder):
    return serving.filter_activity(published(spark, folder).monthly, SELECTED_TICKERS, "Sell")


@query
def ticker_lookup(spark, folder):
    """Transactions of one company from a table that skips row groups without it."""
    root = fresh_path(spark, "lookup")
    tables.write_for_lookups(published_transactions(spark, folder), root, ("issuer_ticker", "insider_name"))
    found = spark.read.parquet(root).where(F.col("issuer_ticker") == SELECTED_TICKERS[0])
    return found.groupBy("insider_name", "buy_sell_flag").agg(F.count(F.lit(1)).alias("rows"), money.exact_sum("transaction_value_usd").alias("total_value_usd"))


@query
def net_from_buckets(spark, folder):
    """Net value of every company's month, from a table bucketed by company."""
    totals = marts.monthly_totals(published_transactions(spark, folder))
    name = "monthly_" + uuid.uuid4().hex
    stored = tables.write_bucketed(totals, name, fresh_path(spark, "buckets"), ("issuer_ticker",), BUCKETS, ("issuer_ticker", "transaction_month_key"))
    return marts.with_net(stored).select("issuer_ticker", "transaction_month_key", "net_sentiment_usd").distinct()


@query
def activity_months(spark, folder):
    """Chosen months of the stored table; the others are not opened."""
    return serving.filter_activity(published(spark, folder).monthly, months=SELECTED_MONTHS)


@query
def kpi_summary(spark, folder):
    return serving.kpi_summary(published(spark, folder).monthly)


@query
def monthly_volume(spark, folder):
    return serving.monthly_volume(published(spark, folder).monthly)


@query
def buy_sell_split(spark, folder):
    return serving.buy_sell_split(published(spark, folder).monthly)


@query
def net_by_month(spark, folder):
    return serving.net_by_month(published(spark, folder).monthly)


@query
def net_by_month_once(spark, folder):
    return serving.net_by_month(published(spark, folder).monthly, distinct=True)


@query
def top_companies(spark, folder):
    return serving.top_companies(published(spark, folder).monthly)


@query
def top10_buyers(spark, folder):
    return serving.top_by_flag(trader_feed(spark, folder), "Buy")


@query
def top10_sellers(spark, folder):
    return serving.top_by_flag(trader_feed(spark, folder), "Sell")


@query
def role_distribution(spark, folder):
    return serving.role_distribution(published(spark, folder).traders)


@query
def role_rollup(spark, folder):
    return serving.role_rollup(published(spark, folder).traders)


@query
def leaderboard(spark, folder):
    return serving.leaderboard(trader_feed(spark, folder))


@query
def top10_bullish(spark, folder):
    return serving.most_bullish(published(spark, folder).sentiment)


@query
def top10_bearish(spark, folder):
    return serving.most_bearish(published(spark, folder).sentiment)


@query
def label_counts(spark, folder):
    return serving.label_counts(published(spark, folder).sentiment)


@query
def sell_buy_ratio(spark, folder):
    return serving.sell_buy_ratio(published(spark, folder).sentiment)


@query
def top_sellers_90d(spark, folder):
    return serving.top_sellers(published_transactions(spark, folder), SELLERS_AS_OF)


# ── data quality ─────────────────────────────────────────────────────────


def _audit(spark, folder, *kinds: str, as_of: dt.date | None = None) -> DataFrame:
    """Checks of the landed and published tables."""
    stored = published(spark, folder)
    landed = landing.read_raw(spark, f"{_root(spark, folder)}/raw")
    return audit_all(landed, stage(landed), published_transactions(spark, folder), stored, kinds or None, as_of)


@query
def dq_not_null(spark, folder):
    return _audit(spark, folder, "not_null")


@query
def dq_accepted_values(spark, folder):
    return _audit(spark, folder, "accepted_values")


@query
def audit_report(spark, folder):
    """All checks, freshness included."""
    return _audit(spark, folder, as_of=FRESH_AS_OF)


@query
def rejected_numbers(spark, folder):
    """Share counts made absurd, told apart by their last digit."""
    shares = F.col("transaction_shares")
    absurd = F.when(shares % 10 == 7, shares * 1e30).when(shares % 10 == 9, F.lit(float("inf"))).otherwise(shares)
    return quality.rejected_numbers(raw(spark, folder).withColumn("transaction_shares", absurd))


@query
def dq_unique(spark, folder):
    return quality.unique(sentiment(spark, folder), "company_sentiment", "issuer_ticker")


@query
def dq_freshness(spark, folder):
    return quality.freshness(raw(spark, folder), "raw", FRESH_AS_OF)


# ── sinks ────────────────────────────────────────────────────────────────


@query
def write_raw_roundtrip(spark, folder):
    return per_quarter(landing.read_raw(spark, landed_raw(spark, folder)))


@query
def append_then_overwrite(spark, folder):
    """Land everything, append the quarters from 1998 on again, overwrite those of 1995."""
    root = landed_raw(spark, folder)
    rows = raw(spark, folder)
    tables.write_raw(rows.where(F.col("quarter") >= "1998Q1"), root, mode="append")
    tables.write_raw(rows.where(F.col("quarter") < "1996Q1"), root)
    return per_quarter(landing.read_raw(spark, root))


@query
def observed_count(spark, folder):
    rows = tables.write_raw(raw(spark, folder), fresh_path(spark, "raw"))
    return spark.range(1).select(F.lit(rows).cast("bigint").alias("rows"))


@query
def write_monthly_mart(spark, folder):
    root = fresh_path(spark, "monthly")
    frame = monthly(spark, folder)
    tables.write_monthly(frame, root)
    return tables.read_table(spark, root, like=frame)


def _summary(stored: Marts) -> DataFrame:
    summaries = [
        frame.agg(F.count(F.lit(1)).alias("rows"), money.exact_sum(value).alias("total")).select(
            F.lit(name).alias("table"), "rows", "total"
        )
        for name, frame, value in (
            ("monthly_activity", stored.monthly, "total_value_usd"),
            ("top_traders", stored.traders, "total_value_usd"),
            ("company_sentiment", stored.sentiment, "net_value_usd"),
        )
    ]
    return summaries[0].unionByName(summaries[1]).unionByName(summaries[2])


@query
def write_marts(spark, folder):
    """All three tables built and stored, summarised."""
    return _summary(build(raw(spark, folder), fresh_path(spark, "marts")))


@query
def publish_gate(spark, folder):
    """What is served after rows with accepted codes were published and the same rows as filed were refused."""
    root, filed = fresh_path(spark, "publication"), raw(spark, folder)
    known = F.when(codes.ownership_type("direct_or_indirect").isin(*schema.OWNERSHIP_TYPES.values()), F.col("direct_or_indirect"))
    publish(filed.withColumns({"transaction_code": text.strip_upper("transaction_code"), "direct_or_indirect": known}), root)
    refused = ""
    try:
        publish(filed, root)
    except quality.QualityError as error:
        refused = str(error)
    return _summary(open_served(spark, root)).withColumn("refused", F.lit(refused))


_refreshed: dict[tuple[str, str, str], str] = {}


def _overwritten(spark: SparkSession, folder: str) -> Marts:
    """Marts of a landing zone of which chosen quarters were landed again, with twice the shares and without small orders."""
    key = (spark.sparkContext.applicationId, folder, version_of(spark, [f"{folder}/{name}.parquet" for name in _SOURCES]))
    if key in _refreshed and exists(spark, _refreshed[key]):
        return open_served(spark, _refreshed[key])
    landed, root = landed_raw(spark, folder), fresh_path(spark, "marts")
    kinds = ("not_null", "unique")
    _refreshed[key] = root
    incremental.start(spark, landed, root, kinds)
    again = raw(spark, folder).where(F.col("quarter").isin(*SELECTED_QUARTERS) & (F.col("transaction_shares") >= 5))
    tables.write_raw(again.withColumn("transaction_shares", F.col("transaction_shares") * 2), landed)
    return incremental.refresh(spark, landed, root, SELECTED_QUARTERS, kinds)


@query
def marts_after_overwrite(spark, folder):
    return _overwritten(spark, folder).monthly


@query
def traders_after_overwrite(spark, folder):
    return _overwritten(spark, folder).traders.drop("last_ingested_at")


@query
def companies_after_overwrite(spark, folder):
    return _overwritten(spark, folder).sentiment


_caches: dict[str, ResultCache] = {}


def result_cache(spark: SparkSession) -> ResultCache:
    return _caches.setdefault(spark.sparkContext.applicationId, ResultCache(spark))


@query
def cached_feed(spark, folder):
    """The sentiment feed, made once an hour at most unless its tables change."""
    sources = [f"{folder}/{name}.parquet" for name in _SOURCES]
    return result_cache(spark).get(f"sentiment-{folder}".replace("/", "-"), sources, lambda: serving.sentiment_feed(sentiment(spark, folder)))


def _exported(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as CSV and read back."""
    path = tables.write_csv(frame, fresh_path(spark, "export"), name, EXPORT_DAY)
    return spark.read.schema(frame.schema).option("header", True).csv(path)


@query
def csv_export(spark, folder):
    return _exported(spark, published(spark, folder).monthly.drop("last_ingested_at"), "monthly_insider_activity")


@query
def csv_export_traders(spark, folder):
    return _exported(spark, trader_feed(spark, folder), "top_insider_traders")


@query
def csv_export_sentiment(spark, folder):
    return _exported(spark, published(spark, folder).sentiment, "company_sentiment")


@query
def verify_output(spark, folder):
    found = tables.verify(spark, landed_raw(spark, folder))
    whole = F.col("missing") + F.col("changed") + F.col("extra") == 0
    return found.select("quarter", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"), whole.alias("as_written"))
