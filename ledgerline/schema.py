"""Raw filing schema and the code sets used by classification and checks."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, types and nullability of a raw transaction row.
RAW = T.StructType(
    [
        T.StructField("accession_number", T.StringType(), False),
        T.StructField("cik", T.StringType(), False),
        T.StructField("company_name", T.StringType()),
        T.StructField("form_type", T.StringType()),
        T.StructField("filing_date", T.DateType()),
        T.StructField("period_of_report", T.DateType()),
        T.StructField("issuer_cik", T.StringType()),
        T.StructField("issuer_name", T.StringType()),
        T.StructField("issuer_ticker", T.StringType()),
        T.StructField("reporting_owner_name", T.StringType()),
        T.StructField("is_director", T.StringType()),
        T.StructField("is_officer", T.StringType()),
        T.StructField("is_ten_pct_owner", T.StringType()),
        T.StructField("officer_title", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("transaction_code", T.StringType()),
        T.StructField("transaction_shares", T.DoubleType()),
        T.StructField("price_per_share", T.DoubleType()),
        T.StructField("shares_owned_after", T.DoubleType()),
        T.StructField("direct_or_indirect", T.StringType()),
        T.StructField("security_title", T.StringType()),
        T.StructField("quarter", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# Form types that carry insider transactions.
FORM_TYPES = ("4", "4/A")
AMENDED_FORM = "4/A"

# Transaction code -> readable type.
TRANSACTION_TYPES = {
    "S": "Sale",
    "P": "Purchase",
    "M": "Option Exercise",
    "G": "Gift",
    "F": "Tax Withholding",
    "A": "Grant/Award",
    "D": "Sale Back to Issuer",
    "X": "Option Exercise (Exempt)",
}

# Transaction code -> flag.
BUY_SELL_FLAGS = {"P": "Buy", "S": "Sell", "M": "Exercise", "G": "Gift"}

# Ownership code -> ownership type.
OWNERSHIP_TYPES = {"D": "Direct", "I": "Indirect"}

# Insider roles, highest priority first, with the raw flag that grants each.
INSIDER_ROLES = {"is_officer": "Officer", "is_director": "Director", "is_ten_pct_owner": "10% Owner"}

# Lowest buy ratio -> label; anything lower or unknown is the fallback.
SENTIMENT_LABELS = ((0.7, "Strong Buy Signal"), (0.5, "Moderate Buy Signal"), (0.3, "Moderate Sell Signal"))
SENTIMENT_FALLBACK = "Strong Sell Signal"

# Every transaction code a filing may carry.
TRANSACTION_CODES = (
    "S", "P", "M", "G", "F", "A", "C", "D", "E", "H", "I", "J", "K", "L", "O", "U", "W", "X", "Z",
)

OTHER = "Other"
TRADED_FLAGS = ("Buy", "Sell")
