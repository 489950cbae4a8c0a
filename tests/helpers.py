"""Small inputs for unit tests."""

from __future__ import annotations

import datetime as dt

from ledgerline import schema

DEFAULTS = {
    "accession_number": "a-1", "cik": "100", "company_name": "acme", "form_type": "4",
    "filing_date": dt.date(2024, 3, 5), "period_of_report": dt.date(2024, 3, 1), "issuer_cik": "1",
    "issuer_name": "acme corp", "issuer_ticker": "acm", "reporting_owner_name": "doe jane", "is_director": "0",
    "is_officer": "1", "is_ten_pct_owner": "0", "officer_title": "ceo", "transaction_date": dt.date(2024, 3, 1),
    "transaction_code": "P", "transaction_shares": 10.0, "price_per_share": 2.5, "shares_owned_after": 100.0,
    "direct_or_indirect": "D", "security_title": "common", "quarter": "2024Q1", "ingested_at": dt.datetime(2024, 3, 6),
}


def raw_rows(spark, *rows: dict):
    """Raw table in which each row overrides the defaults; accessions are numbered unless given."""
    filled = [{**DEFAULTS, "accession_number": f"a-{i}", **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row[name] for name in schema.RAW.fieldNames()) for row in filled], schema.RAW)


def evaluated(spark, values, build, type_="string"):
    """Results of a one-column builder over ``values``, in order."""
    frame = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, v {type_}")
    return [row.r for row in frame.select("i", build("v").alias("r")).orderBy("i").collect()]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
