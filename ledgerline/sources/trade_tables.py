"""Filings derived from star-schema trade tables.

No filings come with the test tables, so orders become filings, their lines
transactions, customers insiders and nations issuers. Every filing is listed
twice, once under its issuer and once under its owner, as real indexes do.
Classification values vary with the columns of the row so that every branch of
the pipeline occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators.shred import FILING_TAGS, TRANSACTION_BLOCK, TRANSACTION_TAGS
from .index import LAYOUT

LISTINGS = ("issuer", "owner")

_ORDER_COLUMNS = (
    "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_custkey",
    "c_name", "c_nationkey", "c_mktsegment", "n_name",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer and nation.

    The nation table has a fixed 25 rows and is broadcast; how orders meet
    customers is left to Spark's size checks.
    """
    nation = F.broadcast(table(spark, folder, "nation"))
    customer = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(*_ORDER_COLUMNS)


def _spread(frame: DataFrame, like: DataFrame, key: str) -> DataFrame:
    """``frame`` on every core, dealt out by ``key``, if ``like``, which it was made from, has fewer splits than there are cores.

    Spark may send the larger side of a join of small files to the tasks of the
    smaller one, and then a single task goes on. Large inputs stay as they are.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if like.rdd.getNumPartitions() >= cores else frame.repartition(cores, key)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order; a price that no filing states does not go along."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "case when l_discount <> 0 then l_extendedprice end as l_extendedprice",
        "concat(l_returnflag, l_linestatus) as l_flags", "date(l_shipdate) as l_shipdate",
    )
    joined = lines.join(_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
    return _spread(joined, lines, "o_orderkey")  # what documents are grouped by


ACCESSION = (
    "concat_ws('-', lpad(string(o_orderkey), greatest(10, length(string(o_orderkey))), '0'),"
    " lpad(string(year(o_orderdate) % 100), 2, '0'), lpad(string(o_custkey), greatest(6, length(string(o_custkey))), '0'))"
)
QUARTER = "concat(year(o_orderdate), 'Q', quarter(o_orderdate))"

# What a document states once.
_FILING = {
    "period_of_report": "date(o_orderdate)",
    "issuer_cik": "concat('I', c_nationkey)",
    "issuer_name": "if(o_orderkey % 500 = 7, concat(' RARE CO-', o_orderkey), concat('  ', n_name, ' '))",
    "issuer_ticker": "case when o_orderkey % 500 = 7 then concat('r', o_orderkey, ' ')"
    " when c_nationkey <> 24 then concat(' n', c_nationkey) end",
    "reporting_owner_name": "c_name",
    "is_director": "if(c_mktsegment = 'FURNITURE', '1', '0')",
    "is_officer": "if(c_mktsegment = 'BUILDING', '1', '0')",
    "is_ten_pct_owner": "if(c_mktsegment = 'MACHINERY', '1', '0')",
    "officer_title": "case when c_mktsegment = 'BUILDING' then concat('chief ', lower(c_mktsegment)) end",
}

# What it states per transaction.
_TRANSACTION = {
    "transaction_date": "l_shipdate",
    "transaction_code": "case l_flags"
    " when 'RO' then if(c_nationkey % 5 = 2, 'S', 'p')"
    " when 'RF' then if(c_nationkey % 5 = 1, 'P', ' S ')"
    " when 'AF' then 'S' when 'AO' then 'P'"
    " when 'NO' then case l_linenumber when 1 then 'M' when 2 then 'G' when 3 then 'F' when 4 then 'X' else 'J' end end",
    "transaction_shares": "l_quantity",
    "price_per_share": "l_extendedprice / l_quantity",
    "shares_owned_after": "l_quantity * 10",
    "direct_or_indirect": "case l_linenumber % 3 when 0 then 'D' when 1 then ' i ' else 'x' end",
    "security_title": "' common stock '",
}

# What an index states about a filing under one of its listings.
_LISTING = {
    "cik": "if(listing = 'issuer', concat('I', c_nationkey), concat('O', o_custkey))",
    "company_name": "if(listing = 'issuer', n_name, c_name)",
    "form_type": "if(listing = 'issuer' and o_orderpriority = '1-URGENT', '4/A', '4')",
    "filing_date": "date(o_orderdate)",
}


def _listed(frame: DataFrame, listings: tuple[str, ...] = LISTINGS) -> DataFrame:
    return frame.withColumn("listing", F.explode(F.array(*[F.lit(name) for name in listings])))


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows as the landing zone holds them, one per listing and line."""
    fields = {
        "accession_number": ACCESSION,
        **_LISTING,
        **_FILING,
        **_TRANSACTION,
        "quarter": QUARTER,
        "ingested_at": "timestamp(date_add(date(o_orderdate), 1))",
    }
    return _listed(_lines(spark, folder)).selectExpr(*[f"{fields[name]} as {name}" for name in schema.RAW.fieldNames()])


def index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Index lines ``(value, quarter)``: both listings of every order, and one line to skip.

    The third line is of another form, too short, or without a document path.
    """
    fields = {
        **_LISTING,
        "form_type": "if(listing = 'skipped' and o_orderpriority not in ('2-HIGH', '3-MEDIUM'), '8-K',"
        f" {_LISTING['form_type']})",
    }
    path = (
        "if(listing = 'skipped' and o_orderpriority = '3-MEDIUM', 'archive/', 'edgar/data/'),"
        f" o_custkey, '/', {ACCESSION}, '.txt  '"
    )
    line = ", ".join(f"rpad(string({fields[name]}), {width}, ' ')" for name, (_, width) in LAYOUT.items())
    return (
        _listed(_orders(spark, folder), (*LISTINGS, "skipped"))
        .selectExpr(
            f"concat({line}, {path}) as line",
            "listing = 'skipped' and o_orderpriority = '2-HIGH' as short",
            f"{QUARTER} as quarter",
        )
        .selectExpr("if(short, substring(line, 1, 39), line) as value", "quarter")
    )


def _element(tag: str, value: str, nested: str = "false") -> str:
    """SQL for ``<tag>value</tag>``, with a nested value element where asked; '' for NULL."""
    wrapped = f"""concat('<value>', {value}, '</value><footnoteId id="F1"/>')"""
    return f"coalesce(concat('<{tag}>', if({nested}, {wrapped}, string({value})), '</{tag}>\n'), '')"


def filing_documents(spark: SparkSession, folder: str) -> DataFrame:
    """XML text of every order with lines; odd lines use the nested value form."""
    elements = ", ".join(_element(tag, _TRANSACTION[name], "l_linenumber % 2 = 1") for name, tag in TRANSACTION_TAGS.items())
    head = ", ".join(_element(tag, _FILING[name]) for name, tag in FILING_TAGS.items())
    per_filing = (
        _lines(spark, folder)
        .selectExpr(*_ORDER_COLUMNS, f"concat('<{TRANSACTION_BLOCK}>\n', {elements}, '</{TRANSACTION_BLOCK}>\n') as block")
        .groupBy(*_ORDER_COLUMNS)
        .agg(F.expr("array_join(array_sort(collect_list(block)), '')").alias("blocks"))
    )
    return per_filing.selectExpr(
        f"{ACCESSION} as accession_number",
        f"""concat('<?xml version="1.0"?>\n<ownershipDocument>\n', {head}, '<nonDerivativeTable>\n', blocks,
                   '</nonDerivativeTable>\n</ownershipDocument>\n') as xml""",
        "o_orderstatus",
        "o_orderpriority",
        f"{QUARTER} as quarter",
    )


def mirrored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents as an archive keeps them: a copy, with its path, under each listing."""
    path = F.concat(F.lit("edgar/data/"), F.col("listing"), F.lit("/"), F.col("accession_number"), F.lit(".txt"))
    return _listed(filing_documents(spark, folder)).withColumn("path", path)
