"""The catalog in SQL, written for another engine, to check results against."""

from __future__ import annotations

# ── shared steps ─────────────────────────────────────────────────────────

_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def _title(value: str) -> str:
    words = f"regexp_extract_all(lower({value}), '[^{_BREAKS}]*[{_BREAKS}]?')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


_SPACES = "' ' || chr(9) || chr(10) || chr(13)"


def _trim(value: str) -> str:
    return f"trim({value}, {_SPACES})"


_CENTS = "CAST(round({0}, 2) AS DECIMAL(18,2))"


def _money(value: str) -> str:
    return f"CAST(sum({_CENTS.format(value)}) AS DOUBLE)"


def _net(over: str) -> str:
    def side(flag: str) -> str:
        amount = _CENTS.format(f"CASE WHEN buy_sell_flag = '{flag}' THEN total_value_usd ELSE 0 END")
        return f"CAST(sum({amount}) OVER ({over}) AS DOUBLE)"

    return f"{side('Buy')} - {side('Sell')}"


_ACCESSION = (
    "lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(10, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') || '-' || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')"
    " || '-' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')"
)
_QUARTER = "CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR)"

_STEPS = {
    "listed": f"""
        SELECT *, {_ACCESSION} AS accession_number, {_QUARTER} AS quarter,
               CASE WHEN listing = 'issuer' THEN 'I' || c_nationkey ELSE 'O' || o_custkey END AS cik,
               CASE WHEN listing = 'issuer' THEN n_name ELSE c_name END AS company_name,
               CASE WHEN listing = 'issuer' AND o_orderpriority = '1-URGENT' THEN '4/A' ELSE '4' END AS form_type,
               CAST(o_orderdate AS DATE) AS filing_date
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
             (VALUES ('issuer'), ('owner')) AS listings(listing)""",
    "raw": """
        SELECT accession_number, cik, company_name, form_type, filing_date,
               CAST(o_orderdate AS DATE) AS period_of_report,
               'I' || c_nationkey AS issuer_cik,
               CASE WHEN o_orderkey % 500 = 7 THEN ' RARE CO-' || o_orderkey ELSE '  ' || n_name || ' ' END AS issuer_name,
               CASE WHEN o_orderkey % 500 = 7 THEN 'r' || o_orderkey || ' '
                    WHEN c_nationkey = 24 THEN NULL ELSE ' n' || c_nationkey END AS issuer_ticker,
               c_name AS reporting_owner_name,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN '1' ELSE '0' END AS is_director,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '1' ELSE '0' END AS is_officer,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN '1' ELSE '0' END AS is_ten_pct_owner,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'chief ' || lower(c_mktsegment) END AS officer_title,
               CAST(l_shipdate AS DATE) AS transaction_date,
               CASE l_returnflag || l_linestatus
                    WHEN 'RO' THEN CASE WHEN c_nationkey % 5 = 2 THEN 'S' ELSE 'p' END
                    WHEN 'RF' THEN CASE WHEN c_nationkey % 5 = 1 THEN 'P' ELSE ' S ' END
                    WHEN 'AF' THEN 'S'
                    WHEN 'AO' THEN 'P'
                    WHEN 'NO' THEN CASE l_linenumber WHEN 1 THEN 'M' WHEN 2 THEN 'G' WHEN 3 THEN 'F' WHEN 4 THEN 'X' ELSE 'J' END
               END AS transaction_code,
               l_quantity AS transaction_shares,
               CASE WHEN l_discount <> 0 THEN l_extendedprice / l_quantity END AS price_per_share,
               l_quantity * 10 AS shares_owned_after,
               CASE l_linenumber % 3 WHEN 0 THEN 'D' WHEN 1 THEN ' i ' ELSE 'x' END AS direct_or_indirect,
               ' common stock ' AS security_title,
               quarter,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at
        FROM lineitem JOIN listed ON l_orderkey = o_orderkey""",
    "staged": f"""
        SELECT accession_number, {_trim('cik')} AS cik, {_trim('issuer_cik')} AS issuer_cik,
               {_title(_trim('issuer_name'))} AS issuer_name,
               upper({_trim('issuer_ticker')}) AS issuer_ticker,
               {_title(_trim('company_name'))} AS filer_company_name,
               {_title(_trim('reporting_owner_name'))} AS insider_name,
               {_title(_trim('officer_title'))} AS officer_title,
               coalesce(is_director = '1', false) AS is_director,
               coalesce(is_officer = '1', false) AS is_officer,
               coalesce(is_ten_pct_owner = '1', false) AS is_ten_pct_owner,
               CASE WHEN is_officer = '1' THEN 'Officer' WHEN is_director = '1' THEN 'Director'
                    WHEN is_ten_pct_owner = '1' THEN '10% Owner' ELSE 'Other' END AS insider_role,
               transaction_date, filing_date, period_of_report,
               upper({_trim('transaction_code')}) AS transaction_code,
               CASE upper({_trim('transaction_code')})
                    WHEN 'S' THEN 'Sale' WHEN 'P' THEN 'Purchase' WHEN 'M' THEN 'Option Exercise' WHEN 'G' THEN 'Gift'
                    WHEN 'F' THEN 'Tax Withholding' WHEN 'A' THEN 'Grant/Award' WHEN 'D' THEN 'Sale Back to Issuer'
                    WHEN 'X' THEN 'Option Exercise (Exempt)' ELSE 'Other' END AS transaction_type,
               CAST(transaction_shares AS DECIMAL(38,9)) AS transaction_shares,
               price_per_share, shares_owned_after,
               round(transaction_shares * price_per_share, 2) AS transaction_value_usd,
               CASE upper({_trim('direct_or_indirect')}) WHEN 'D' THEN 'Direct' WHEN 'I' THEN 'Indirect'
                    ELSE direct_or_indirect END AS ownership_type,
               upper({_trim('security_title')}) AS security_title,
               CASE upper({_trim('transaction_code')}) WHEN 'P' THEN 'Buy' WHEN 'S' THEN 'Sell' WHEN 'M' THEN 'Exercise'
                    WHEN 'G' THEN 'Gift' ELSE 'Other' END AS buy_sell_flag,
               form_type, quarter, ingested_at
        FROM raw WHERE transaction_code IS NOT NULL""",
    "tx": """
        SELECT accession_number, cik, issuer_cik, issuer_name, issuer_ticker, insider_name, officer_title, insider_role,
               is_director, is_officer, is_ten_pct_owner, transaction_date, filing_date, transaction_code, transaction_type,
               buy_sell_flag, transaction_shares, price_per_share, transaction_value_usd, shares_owned_after,
               ownership_type, security_title,
               year(transaction_date) AS transaction_year, month(transaction_date) AS transaction_month,
               quarter(transaction_date) AS transaction_quarter,
               strftime(transaction_date, '%Y-%m') AS transaction_month_key,
               strftime(transaction_date, '%Y') || '-Q' || quarter(transaction_date) AS transaction_quarter_key,
               date_diff('day', transaction_date, filing_date) AS days_to_file,
               form_type, quarter, ingested_at
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY accession_number, transaction_date, transaction_code, transaction_shares
                  ORDER BY CASE form_type WHEN '4/A' THEN 1 ELSE 2 END, filing_date DESC NULLS LAST, cik NULLS FIRST,
                           price_per_share NULLS FIRST, security_title NULLS FIRST, shares_owned_after NULLS FIRST,
                           insider_name NULLS FIRST, ownership_type NULLS FIRST, issuer_ticker NULLS FIRST,
                           issuer_name NULLS FIRST, issuer_cik NULLS FIRST, officer_title NULLS FIRST,
                           insider_role NULLS FIRST, quarter NULLS FIRST, ingested_at NULLS FIRST) AS position
              FROM staged)
        WHERE position = 1""",
    "monthly": f"""
        SELECT *, {_net('PARTITION BY issuer_ticker, transaction_month_key')} AS net_sentiment_usd
        FROM (SELECT transaction_month_key, transaction_year, transaction_month, issuer_ticker, issuer_name, buy_sell_flag,
                     count(DISTINCT accession_number) AS num_filings, count(DISTINCT insider_name) AS num_unique_insiders,
                     count(*) AS num_transactions, sum(transaction_shares) AS total_shares,
                     {_money('transaction_value_usd')} AS total_value_usd,
                     CAST(sum(CAST(price_per_share AS DECIMAL(18,8))) AS DOUBLE) / nullif(count(price_per_share), 0)
                         AS avg_price_per_share,
                     max(transaction_value_usd) AS max_single_transaction_usd, max(ingested_at) AS last_ingested_at
              FROM tx WHERE buy_sell_flag IN ('Buy', 'Sell') AND issuer_ticker IS NOT NULL
              GROUP BY ALL)""",
    "traders": f"""
        SELECT *, rank() OVER (PARTITION BY buy_sell_flag ORDER BY total_value_usd DESC NULLS LAST) AS rank_by_value
        FROM (SELECT insider_name, issuer_ticker, issuer_name, insider_role, officer_title, buy_sell_flag,
                     count(*) AS num_transactions, count(DISTINCT transaction_month_key) AS num_active_months,
                     sum(transaction_shares) AS total_shares, {_money('transaction_value_usd')} AS total_value_usd,
                     {_money('transaction_value_usd')} / count(*) AS avg_transaction_value_usd,
                     max(transaction_value_usd) AS max_transaction_value_usd,
                     min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
                     max(ingested_at) AS last_ingested_at
              FROM tx WHERE buy_sell_flag IN ('Buy', 'Sell') AND transaction_value_usd IS NOT NULL
              GROUP BY ALL)""",
    "companies": f"""
        SELECT issuer_ticker, issuer_name,
               count(*) FILTER (WHERE buy_sell_flag = 'Buy') AS num_buy_transactions,
               sum(CASE WHEN buy_sell_flag = 'Buy' THEN transaction_shares ELSE 0 END) AS total_buy_shares,
               {_money("CASE WHEN buy_sell_flag = 'Buy' THEN transaction_value_usd ELSE 0 END")} AS total_buy_value_usd,
               count(*) FILTER (WHERE buy_sell_flag = 'Sell') AS num_sell_transactions,
               sum(CASE WHEN buy_sell_flag = 'Sell' THEN transaction_shares ELSE 0 END) AS total_sell_shares,
               {_money("CASE WHEN buy_sell_flag = 'Sell' THEN transaction_value_usd ELSE 0 END")} AS total_sell_value_usd,
               count(DISTINCT insider_name) AS num_unique_insiders,
               count(DISTINCT CASE WHEN buy_sell_flag = 'Buy' THEN insider_name END) AS num_buyers,
               count(DISTINCT CASE WHEN buy_sell_flag = 'Sell' THEN insider_name END) AS num_sellers,
               min(transaction_date) AS earliest_transaction, max(transaction_date) AS latest_transaction,
               max(ingested_at) AS last_ingested_at
        FROM tx WHERE buy_sell_flag IN ('Buy', 'Sell') AND issuer_ticker IS NOT NULL
        GROUP BY issuer_ticker, issuer_name""",
    "sentiment": """
        SELECT *, CASE WHEN buy_ratio >= 0.7 THEN 'Strong Buy Signal' WHEN buy_ratio >= 0.5 THEN 'Moderate Buy Signal'
                       WHEN buy_ratio >= 0.3 THEN 'Moderate Sell Signal' ELSE 'Strong Sell Signal' END AS sentiment_label,
               rank() OVER (ORDER BY total_sell_value_usd DESC NULLS LAST) AS sell_rank,
               rank() OVER (ORDER BY total_buy_value_usd DESC NULLS LAST) AS buy_rank
        FROM (SELECT *, total_buy_value_usd - total_sell_value_usd AS net_value_usd,
                     CAST(num_buy_transactions AS DOUBLE) / nullif(num_buy_transactions + num_sell_transactions, 0) AS buy_ratio
              FROM companies WHERE num_buy_transactions + num_sell_transactions >= 3)""",
    "trader_feed": """
        SELECT * EXCLUDE (last_ingested_at) FROM traders WHERE rank_by_value <= 50""",
    "sentiment_feed": """
        SELECT * FROM sentiment
        ORDER BY abs(net_value_usd) DESC NULLS LAST, issuer_ticker NULLS FIRST, issuer_name NULLS FIRST LIMIT 100""",
    "index_rows": f"""
        SELECT cik, company_name, form_type, CAST(filing_date AS VARCHAR) AS filing_date,
               'edgar/data/' || o_custkey || '/' || accession_number || '.txt' AS filename, quarter, accession_number
        FROM listed""",
    "quarter_grid": """
        SELECT year, q.quarter FROM (SELECT DISTINCT year(o_orderdate) AS year FROM orders),
               (VALUES (1), (2), (3), (4)) AS q(quarter)
        WHERE make_date(year, q.quarter * 3, 1) <= DATE '2001-05-15'""",
}

_NEEDS = {
    "raw": ("listed",),
    "staged": ("raw",),
    "tx": ("staged",),
    "monthly": ("tx",),
    "traders": ("tx",),
    "companies": ("tx",),
    "sentiment": ("companies",),
    "trader_feed": ("traders",),
    "sentiment_feed": ("sentiment",),
    "index_rows": ("listed",),
}

# Days and stamps are compared as text, decimals as doubles, counts as bigint.
_TEXT = (
    "filing_date", "period_of_report", "transaction_date", "ingested_at", "last_ingested_at", "first_transaction_date",
    "last_transaction_date", "earliest_transaction", "latest_transaction", "day",
)
_DOUBLE = ("transaction_shares", "total_shares", "total_buy_shares", "total_sell_shares", "shares")


def _chain(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []
    for name in names:
        for step in (*_chain(_NEEDS.get(name, ())), name):
            if step not in order:
                order.append(step)
    return order


def _sql(body: str, *steps: str) -> str:
    """``body`` over the named steps."""
    chain = ", ".join(f"{name} AS ({_STEPS[name]})" for name in _chain(steps))
    return f"WITH {chain} {body}" if chain else body


def _out(columns: str, source: str, *steps: str) -> str:
    """SELECT with a cast on every column whose type engines report differently."""
    names = [name.strip() for name in columns.split(",")]
    cast = [
        f"CAST({name} AS VARCHAR) AS {name}" if name in _TEXT
        else f"CAST({name} AS DOUBLE) AS {name}" if name in _DOUBLE
        else name
        for name in names
    ]
    return _sql(f"SELECT {', '.join(cast)} FROM {source}", *steps)


def _tally(columns: str, source: str, *steps: str) -> str:
    return _sql(f"SELECT {columns}, count(*) AS rows FROM {source} GROUP BY ALL", *steps)


_RAW_COLUMNS = (
    "accession_number, cik, company_name, form_type, filing_date, period_of_report, issuer_cik, issuer_name, issuer_ticker,"
    " reporting_owner_name, is_director, is_officer, is_ten_pct_owner, officer_title, transaction_date, transaction_code,"
    " transaction_shares, price_per_share, shares_owned_after, direct_or_indirect, security_title, quarter, ingested_at"
)
_STAGED_COLUMNS = (
    "accession_number, cik, issuer_cik, issuer_name, issuer_ticker, filer_company_name, insider_name, officer_title,"
    " is_director, is_officer, is_ten_pct_owner, insider_role, transaction_date, filing_date, period_of_report,"
    " transaction_code, transaction_type, transaction_shares, price_per_share, shares_owned_after, transaction_value_usd,"
    " ownership_type, security_title, buy_sell_flag, form_type, quarter, ingested_at"
)
_TX_COLUMNS = (
    "accession_number, cik, issuer_cik, issuer_name, issuer_ticker, insider_name, officer_title, insider_role, is_director,"
    " is_officer, is_ten_pct_owner, transaction_date, filing_date, transaction_code, transaction_type, buy_sell_flag,"
    " transaction_shares, price_per_share, transaction_value_usd, shares_owned_after, ownership_type, security_title,"
    " transaction_year, transaction_month, transaction_quarter, transaction_month_key, transaction_quarter_key,"
    " days_to_file, form_type, quarter, ingested_at"
)
_MONTHLY_FEED_COLUMNS = (
    "transaction_month_key, transaction_year, transaction_month, issuer_ticker, issuer_name, buy_sell_flag, num_filings,"
    " num_unique_insiders, num_transactions, total_shares, total_value_usd, avg_price_per_share,"
    " max_single_transaction_usd, net_sentiment_usd"
)
_MONTHLY_COLUMNS = _MONTHLY_FEED_COLUMNS + ", last_ingested_at"
_TRADER_FEED_COLUMNS = (
    "insider_name, issuer_ticker, issuer_name, insider_role, officer_title, buy_sell_flag, num_transactions,"
    " num_active_months, total_shares, total_value_usd, avg_transaction_value_usd, max_transaction_value_usd,"
    " first_transaction_date, last_transaction_date, rank_by_value"
)
_SENTIMENT_COLUMNS = (
    "issuer_ticker, issuer_name, num_buy_transactions, total_buy_shares, total_buy_value_usd, num_sell_transactions,"
    " total_sell_shares, total_sell_value_usd, num_unique_insiders, num_buyers, num_sellers, earliest_transaction,"
    " latest_transaction, last_ingested_at, net_value_usd, buy_ratio, sentiment_label, sell_rank, buy_rank"
)
_INDEX_COLUMNS = "cik, company_name, form_type, filing_date, filename, quarter, accession_number"


def _per_quarter(source: str = "raw", factor: str = "1", *steps: str) -> str:
    return _sql(
        f"""SELECT quarter, CAST(count(*) * ({factor}) AS BIGINT) AS rows, count(DISTINCT accession_number) AS filings,
                   CAST(sum(transaction_shares) * ({factor}) AS DOUBLE) AS shares
            FROM {source} GROUP BY quarter""",
        *(steps or ("raw",)),
    )


# ── tag text in pages, by the same rules ─────────────────────────────────

_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"


def _tag(tag: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    value = "(?i)<value[^>]*>([^<]*)</value>"
    bare = _STRIP.format(f"regexp_replace({inner}, '<[^>]+>', '', 'g')")
    nested = _STRIP.format(f"regexp_extract({inner}, '{value}', 1)")
    return f"CASE WHEN regexp_matches({inner}, '{value}') THEN {nested} ELSE nullif({bare}, '') END AS {tag}"


_DATE_TEXT = """
    SELECT CASE o_orderkey % 9
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
        WHEN 4 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
        WHEN 6 THEN strftime(o_orderdate, '%Y-02-30') WHEN 7 THEN '' ELSE 'not-a-date' END AS shown
    FROM orders"""

_NUMBER_TEXT = """
    SELECT CASE l_linenumber
        WHEN 1 THEN CAST(l_extendedprice AS VARCHAR) WHEN 2 THEN ' ' || CAST(l_extendedprice AS VARCHAR) || ' '
        WHEN 3 THEN '-' || CAST(l_extendedprice AS VARCHAR) WHEN 4 THEN CAST(l_extendedprice AS VARCHAR) || 'e2'
        WHEN 5 THEN CAST(l_extendedprice AS VARCHAR) || 'd' WHEN 6 THEN '1,' || CAST(l_extendedprice AS VARCHAR)
        ELSE 'not-a-number' END AS shown
    FROM lineitem"""

_TEXTS = ("issuer_name", "issuer_ticker", "transaction_code", "direct_or_indirect", "security_title")

_CODES = (
    "'S', 'P', 'M', 'G', 'F', 'A', 'C', 'D', 'E', 'H', 'I', 'J', 'K', 'L', 'O', 'U', 'W', 'X', 'Z'"
)


def _checks(rows: list[tuple[str, str, str, str, str, str]], kind: str) -> str:
    parts = [
        f"""SELECT '{model}' AS model, '{column}' AS "column", '{kind}' AS "check", '{severity}' AS severity,
                   count(*) FILTER (WHERE {fails}) AS failures FROM {source}"""
        for model, source, column, severity, fails, _ in rows
    ]
    return f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({' UNION ALL '.join(parts)})"""


def _not_null(model: str, source: str, severity: str, *columns: str) -> list[tuple[str, str, str, str, str, str]]:
    return [(model, source, column, severity, f"{column} IS NULL", "") for column in columns]


def _accepted(model: str, source: str, column: str, values: str) -> tuple[str, str, str, str, str, str]:
    return (model, source, column, "error", f"{column} NOT IN ({values})", "")


_NOT_NULL = [
    *_not_null("raw", "raw", "error", "accession_number", "cik", "ingested_at", "quarter"),
    *_not_null(
        "staging", "staged", "warn",
        "accession_number", "cik", "insider_name", "transaction_code", "buy_sell_flag", "insider_role",
    ),
    *_not_null("intermediate", "tx", "warn", "accession_number"),
    *_not_null("monthly_activity", "monthly", "warn", "buy_sell_flag", "num_unique_insiders"),
    *_not_null("top_traders", "traders", "warn", "insider_name", "rank_by_value"),
    *_not_null("company_sentiment", "sentiment", "warn", "issuer_ticker", "sentiment_label"),
]
_ACCEPTED = [
    _accepted("raw", "raw", "transaction_code", _CODES),
    _accepted("staging", "staged", "transaction_code", _CODES),
    _accepted("staging", "staged", "buy_sell_flag", "'Buy', 'Sell', 'Exercise', 'Gift', 'Other'"),
    _accepted("staging", "staged", "insider_role", "'Officer', 'Director', '10% Owner', 'Other'"),
    _accepted("staging", "staged", "ownership_type", "'Direct', 'Indirect', 'D', 'I'"),
    _accepted("monthly_activity", "monthly", "buy_sell_flag", "'Buy', 'Sell'"),
    _accepted(
        "company_sentiment", "sentiment", "sentiment_label",
        "'Strong Buy Signal', 'Moderate Buy Signal', 'Moderate Sell Signal', 'Strong Sell Signal'",
    ),
]

_UNIQUE = """SELECT 'company_sentiment' AS model, 'issuer_ticker' AS "column", 'unique' AS "check", 'warn' AS severity,
                  count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status
           FROM (SELECT issuer_ticker FROM sentiment WHERE issuer_ticker IS NOT NULL
                 GROUP BY issuer_ticker HAVING count(*) > 1)"""
_STALE = """SELECT 'raw' AS model, 'ingested_at' AS "column", 'freshness' AS "check",
                   CASE WHEN age > 45 AND age <= 90 THEN 'warn' ELSE 'error' END AS severity,
                   CASE WHEN age > 45 THEN 1 ELSE 0 END AS failures,
                   CASE WHEN age <= 45 THEN 'pass' WHEN age <= 90 THEN 'warn' ELSE 'error' END AS status
            FROM (SELECT date_diff('day', CAST(max(ingested_at) AS DATE), DATE '2001-10-01') AS age FROM raw)"""
_HELD = """SELECT 'raw' AS model, 'transaction_shares' AS "column", 'held' AS "check", 'error' AS severity, 0 AS failures,
                  'pass' AS status
           UNION ALL SELECT 'intermediate', 'transaction_value_usd', 'exact', 'warn', 0, 'pass'
           UNION ALL SELECT 'intermediate', 'price_per_share', 'exact', 'warn', 0, 'pass'"""
_VOLUME = f"coalesce({_money('total_value_usd')}, 0) AS total_value_usd"
_NET = f"coalesce({_money('net_sentiment_usd')}, 0) AS net_sentiment_usd"
_COUNTED = "CAST(sum(num_transactions) AS BIGINT) AS num_transactions"
_TRADER_TIES = ", ".join(
    f"{name} NULLS FIRST"
    for name in ("insider_name", "issuer_ticker", "issuer_name", "insider_role", "officer_title", "buy_sell_flag")
)


def _top_by_flag(flag: str) -> str:
    return _out(
        _TRADER_FEED_COLUMNS,
        f"""(SELECT * FROM trader_feed WHERE buy_sell_flag = '{flag}'
             ORDER BY total_value_usd DESC NULLS LAST, {_TRADER_TIES} LIMIT 10)""",
        "trader_feed",
    )


def _extreme(order: str) -> str:
    return _out(
        _SENTIMENT_COLUMNS,
        f"""(SELECT * FROM sentiment
             ORDER BY net_value_usd {order} NULLS LAST, issuer_ticker NULLS FIRST, issuer_name NULLS FIRST LIMIT 10)""",
        "sentiment",
    )


def _after_overwrite(sql: str) -> str:
    """``sql`` over tables whose chosen quarters were landed again, with twice the shares and without small orders."""
    chosen = "quarter IN ('1996Q1', '1999Q3')"
    doubled = sql.replace("l_quantity AS transaction_shares", f"CASE WHEN {chosen} THEN 2 * l_quantity ELSE l_quantity END AS transaction_shares")
    return doubled.replace("FROM lineitem JOIN listed ON l_orderkey = o_orderkey", f"FROM lineitem JOIN listed ON l_orderkey = o_orderkey WHERE NOT ({chosen} AND l_quantity < 5)")


ORACLE = {
    # sources
    "index_parse": _out(_INDEX_COLUMNS, "index_rows", "index_rows"),
    "index_files": _out(_INDEX_COLUMNS, "index_rows", "index_rows"),
    "documents_scan": """SELECT doc_id, length(text || chr(65533)) AS chars, md5(text || chr(65533)) AS digest
                         FROM documents""",
    "raw_scan": _out(_RAW_COLUMNS, "raw", "raw"),
    "available_quarters": _sql("SELECT DISTINCT quarter FROM raw", "raw"),
    "load_selected_quarters": _per_quarter("(SELECT * FROM raw WHERE quarter IN ('1996Q1', '1999Q3'))"),
    "quarters_to_process": _sql("SELECT year, CAST(quarter AS BIGINT) AS quarter FROM quarter_grid", "quarter_grid"),
    "quarters_restricted": _sql(
        "SELECT year, CAST(quarter AS BIGINT) AS quarter FROM quarter_grid WHERE quarter IN (1, 2)", "quarter_grid"
    ),
    "index_join_documents": _sql(
        """SELECT accession_number, cik, company_name, form_type, CAST(filing_date AS VARCHAR) AS filing_date, quarter,
                  count(*) AS transactions
           FROM listed JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
        "listed",
    ),
    "missing_documents": _out(
        _INDEX_COLUMNS,
        f"""(SELECT r.* FROM index_rows r WHERE accession_number NOT IN (
               SELECT {_ACCESSION} FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)))""",
        "index_rows",
    ),
    "quarantine": f"""
        SELECT {_ACCESSION} AS accession_number,
               CASE o_orderpriority WHEN '5-LOW' THEN 'unreadable' ELSE 'blank' END AS reason
        FROM orders
        WHERE o_orderstatus = 'P' AND o_orderpriority IN ('2-HIGH', '5-LOW')
          AND o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_custkey IN (SELECT c_custkey FROM customer)""",
    "ingest_report": _sql(
        """SELECT quarter, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 'missing'
                                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'blank'
                                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'unreadable'
                                ELSE 'landed' END AS outcome, count(*) AS filings
           FROM listed GROUP BY ALL""",
        "listed",
    ),
    "documents_read": _sql(
        """SELECT accession_number, 'edgar/data/' || listing || '/' || accession_number || '.txt' AS path, quarter,
                  count(*) AS transactions
           FROM listed JOIN lineitem ON l_orderkey = o_orderkey WHERE quarter IN ('1996Q1', '1999Q3') GROUP BY ALL""",
        "listed",
    ),
    "ingest_restricted": _per_quarter("(SELECT * FROM raw WHERE quarter IN ('1996Q1', '1999Q3'))"),
    "max_filings": _out(
        _INDEX_COLUMNS,
        """(SELECT *, row_number() OVER (PARTITION BY quarter
                ORDER BY accession_number, cik, form_type, filename, company_name) AS position FROM index_rows)
           WHERE position <= 100""",
        "index_rows",
    ),
    "union_quarters": _per_quarter(),
    # shredding
    "tag_value_pages": f"""SELECT page_id, {', '.join(_tag(tag) for tag in ('title', 'h1', 'li', 'article', 'absent'))}
                           FROM pages""",
    "block_split": """
        SELECT page_id, len(items) AS items, md5(array_to_string(items, '|')) AS digest
        FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) AS items FROM pages)""",
    "shred_filings": _out(
        _RAW_COLUMNS,
        f"""(SELECT * REPLACE ({', '.join(f'trim({name}) AS {name}' for name in _TEXTS)},
                               TIMESTAMP '2002-01-01 00:00:00' AS ingested_at) FROM raw)""",
        "raw",
    ),
    "ingest_landing": _per_quarter(),
    # column functions
    "str_trim": _tally(", ".join(f"{_trim(name)} AS {name}" for name in _TEXTS), "raw", "raw"),
    "str_upper": _tally(", ".join(f"upper({_trim(name)}) AS {name}" for name in _TEXTS), "raw", "raw"),
    "title_case": _tally(
        f"name, {_title('name')} AS titled",
        """(SELECT p_name AS name FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT o_orderpriority FROM orders
            UNION ALL SELECT url FROM pages UNION ALL SELECT c_name FROM customer UNION ALL SELECT props FROM events)""",
    ),
    "flag_cast": _tally(
        ", ".join(f"coalesce({name} = '1', false) AS {name}" for name in ("is_director", "is_officer", "is_ten_pct_owner")),
        "raw", "raw",
    ),
    "insider_role": _tally(
        """CASE WHEN is_officer = '1' THEN 'Officer' WHEN is_director = '1' THEN 'Director'
                WHEN is_ten_pct_owner = '1' THEN '10% Owner' ELSE 'Other' END AS insider_role""",
        "raw", "raw",
    ),
    "transaction_type": _tally(
        """transaction_code, CASE upper(trim(transaction_code)) WHEN 'S' THEN 'Sale' WHEN 'P' THEN 'Purchase'
               WHEN 'M' THEN 'Option Exercise' WHEN 'G' THEN 'Gift' WHEN 'F' THEN 'Tax Withholding'
               WHEN 'A' THEN 'Grant/Award' WHEN 'D' THEN 'Sale Back to Issuer' WHEN 'X' THEN 'Option Exercise (Exempt)'
               ELSE 'Other' END AS transaction_type""",
        "raw", "raw",
    ),
    "buy_sell_flag": _tally(
        """transaction_code, CASE upper(trim(transaction_code)) WHEN 'P' THEN 'Buy' WHEN 'S' THEN 'Sell'
               WHEN 'M' THEN 'Exercise' WHEN 'G' THEN 'Gift' ELSE 'Other' END AS buy_sell_flag""",
        "raw", "raw",
    ),
    "ownership_type": _tally(
        """CASE upper(trim(direct_or_indirect)) WHEN 'D' THEN 'Direct' WHEN 'I' THEN 'Indirect'
                ELSE direct_or_indirect END AS ownership_type""",
        "raw", "raw",
    ),
    "safe_date": f"""
        SELECT shown, CAST(CAST(try_strptime(trim(shown), ['%Y-%m-%d', '%m/%d/%Y', '%Y%m%d']) AS DATE) AS VARCHAR) AS day,
               count(*) AS rows
        FROM ({_DATE_TEXT}) GROUP BY ALL""",
    "safe_double": _tally(
        """shown, CASE WHEN regexp_full_match(trim(shown), '[+-]?[0-9]+\\.?[0-9]*(e[0-9]+)?')
                       THEN TRY_CAST(trim(shown) AS DOUBLE) END AS number""",
        f"({_NUMBER_TEXT})",
    ),
    "quarter_label": _tally(f"{_QUARTER} AS quarter", "orders"),
    "date_parts": _tally("transaction_year, transaction_month, transaction_quarter", "tx", "tx"),
    "month_key": _tally("transaction_month_key", "tx", "tx"),
    "quarter_key": _tally("transaction_quarter_key", "tx", "tx"),
    "days_to_file": _tally("days_to_file", "tx", "tx"),
    "late_filers": _sql(
        """SELECT insider_role, count(*) AS late, count(DISTINCT accession_number) AS filings,
                  max(days_to_file) AS latest_days
           FROM tx WHERE days_to_file > 2 GROUP BY insider_role""",
        "tx",
    ),
    "shares_decimal": _tally("CAST(transaction_shares AS DOUBLE) AS transaction_shares", "staged", "staged"),
    "transaction_value": _out(
        "accession_number, cik, transaction_date, transaction_shares, transaction_value_usd",
        "(SELECT *, round(transaction_shares * price_per_share, 2) AS transaction_value_usd FROM raw)",
        "raw",
    ),
    # staging, deduplication, marts
    "stg_transactions": _out(_STAGED_COLUMNS, "staged", "staged"),
    "int_transactions": _out(_TX_COLUMNS, "tx", "tx"),
    "dedup_counts": _tally("form_type, buy_sell_flag", "tx", "tx"),
    "monthly_activity": _out(_MONTHLY_COLUMNS, "monthly", "monthly"),
    "net_sentiment": _sql("SELECT DISTINCT issuer_ticker, transaction_month_key, net_sentiment_usd FROM monthly", "monthly"),
    "top_traders": _out(_TRADER_FEED_COLUMNS + ", last_ingested_at", "traders", "traders"),
    "company_sentiment": _out(_SENTIMENT_COLUMNS, "sentiment", "sentiment"),
    "buyers_sellers": _sql(
        "SELECT issuer_ticker, issuer_name, num_unique_insiders, num_buyers, num_sellers FROM companies", "companies"
    ),
    "buy_ratio": _sql(
        """SELECT issuer_ticker, issuer_name,
                  CAST(num_buy_transactions AS DOUBLE) / nullif(num_buy_transactions + num_sell_transactions, 0) AS buy_ratio
           FROM companies""",
        "companies",
    ),
    "sentiment_label": _sql("SELECT issuer_ticker, issuer_name, buy_ratio, sentiment_label FROM sentiment", "sentiment"),
    # serving
    "monthly_ordered": _out(_MONTHLY_FEED_COLUMNS, "monthly", "monthly"),
    "top_traders_limited": _out(_TRADER_FEED_COLUMNS, "trader_feed", "trader_feed"),
    "sentiment_top100": _out(_SENTIMENT_COLUMNS, "sentiment_feed", "sentiment_feed"),
    "company_list": _sql("SELECT DISTINCT issuer_ticker, issuer_name FROM monthly", "monthly"),
    "activity_filtered": _out(
        _MONTHLY_COLUMNS,
        "(SELECT * FROM monthly WHERE issuer_ticker IN ('N1', 'N2', 'N7') AND buy_sell_flag = 'Sell')",
        "monthly",
    ),
    "activity_months": _out(
        _MONTHLY_COLUMNS, "monthly WHERE transaction_month_key IN ('1996-03', '1997-11')", "monthly"
    ),
    "kpi_summary": _sql(
        f"""SELECT *, total_buy_value - total_sell_value AS net_sentiment,
                   CASE WHEN total_buy_value - total_sell_value > 0 THEN 'Bullish' ELSE 'Bearish' END AS signal
            FROM (SELECT {_money("CASE WHEN buy_sell_flag = 'Buy' THEN total_value_usd END")} AS total_buy_value,
                         {_money("CASE WHEN buy_sell_flag = 'Sell' THEN total_value_usd END")} AS total_sell_value,
                         CAST(sum(num_transactions) AS BIGINT) AS total_transactions,
                         max(num_unique_insiders) AS max_unique_insiders FROM monthly)""",
        "monthly",
    ),
    "monthly_volume": _sql(
        f"SELECT transaction_month_key, {_VOLUME}, {_COUNTED} FROM monthly GROUP BY transaction_month_key", "monthly"
    ),
    "buy_sell_split": _sql(f"SELECT buy_sell_flag, {_VOLUME} FROM monthly GROUP BY buy_sell_flag", "monthly"),
    "net_by_month": _sql(
        f"SELECT transaction_month_key, {_NET} FROM monthly GROUP BY transaction_month_key", "monthly"
    ),
    "net_by_month_once": _sql(
        f"""SELECT transaction_month_key, {_NET}
            FROM (SELECT DISTINCT transaction_month_key, issuer_ticker, net_sentiment_usd FROM monthly)
            GROUP BY transaction_month_key""",
        "monthly",
    ),
    "top_companies": _sql(
        f"""SELECT issuer_ticker, {_VOLUME}, {_COUNTED}, {_NET} FROM monthly GROUP BY issuer_ticker
            ORDER BY 2 DESC, issuer_ticker LIMIT 10""",
        "monthly",
    ),
    "top10_buyers": _top_by_flag("Buy"),
    "top10_sellers": _top_by_flag("Sell"),
    "role_distribution": _sql(
        'SELECT insider_role, buy_sell_flag, count(*) AS "count" FROM traders GROUP BY ALL', "traders"
    ),
    "role_rollup": _sql(
        'SELECT insider_role, buy_sell_flag, count(*) AS "count" FROM traders GROUP BY ROLLUP (insider_role, buy_sell_flag)',
        "traders",
    ),
    "leaderboard": _sql(
        """SELECT insider_name, issuer_ticker, insider_role, buy_sell_flag, total_value_usd, num_transactions, rank_by_value
           FROM trader_feed""",
        "trader_feed",
    ),
    "top10_bullish": _extreme("DESC"),
    "top10_bearish": _extreme("ASC"),
    "label_counts": _sql(
        'SELECT sentiment_label, count(*) AS "count" FROM sentiment GROUP BY sentiment_label', "sentiment"
    ),
    "sell_buy_ratio": _sql(
        """SELECT issuer_ticker, issuer_name, num_buy_transactions, num_sell_transactions,
                  CAST(num_sell_transactions AS DOUBLE) / nullif(num_buy_transactions, 0) AS sell_buy_ratio FROM sentiment""",
        "sentiment",
    ),
    "top_sellers_90d": _sql(
        f"""SELECT insider_name, CAST(sum(transaction_shares) AS DOUBLE) AS total_shares,
                   {_money('transaction_value_usd')} AS total_value_usd, count(*) AS num_transactions
            FROM tx
            WHERE buy_sell_flag = 'Sell' AND transaction_date > DATE '2001-06-30' - INTERVAL 90 DAY
              AND transaction_date <= DATE '2001-06-30'
            GROUP BY insider_name ORDER BY sum(transaction_shares) DESC, insider_name LIMIT 10""",
        "tx",
    ),
    # data quality
    "dq_not_null": _sql(_checks(_NOT_NULL, "not_null"), "raw", "staged", "tx", "monthly", "traders", "sentiment"),
    "dq_accepted_values": _sql(_checks(_ACCEPTED, "accepted_values"), "raw", "staged", "monthly", "sentiment"),
    "dq_unique": _sql(_UNIQUE, "sentiment"),
    "audit_report": _sql(
        " UNION ALL ".join((_checks(_NOT_NULL, "not_null"), _checks(_ACCEPTED, "accepted_values"), _UNIQUE, _STALE, _HELD)),
        "raw", "staged", "tx", "monthly", "traders", "sentiment",
    ),
    "dq_freshness": _sql(
        """SELECT 'raw' AS model, 'ingested_at' AS "column", 'freshness' AS "check", age_days,
                  CASE WHEN age_days <= 45 THEN 'pass' WHEN age_days <= 90 THEN 'warn' ELSE 'error' END AS status
           FROM (SELECT date_diff('day', CAST(max(ingested_at) AS DATE), DATE '2001-10-01') AS age_days FROM raw)""",
        "raw",
    ),
    "rejected_numbers": _out(
        "accession_number, cik, transaction_date, quarter, reason",
        """(SELECT *, CASE transaction_shares % 10 WHEN 9 THEN 'infinite' ELSE 'too large' END AS reason
            FROM raw WHERE transaction_shares % 10 IN (7, 9))""",
        "raw",
    ),
    # sinks
    "write_raw_roundtrip": _per_quarter(),
    "append_then_overwrite": _per_quarter("raw", "CASE WHEN quarter >= '1998Q1' THEN 2 ELSE 1 END"),
    "observed_count": _sql("SELECT count(*) AS rows FROM raw", "raw"),
    "write_monthly_mart": _out(_MONTHLY_COLUMNS, "monthly", "monthly"),
    "write_marts": _sql(
        f"""SELECT 'monthly_activity' AS "table", count(*) AS rows, {_money('total_value_usd')} AS total FROM monthly
            UNION ALL SELECT 'top_traders', count(*), {_money('total_value_usd')} FROM traders
            UNION ALL SELECT 'company_sentiment', count(*), {_money('net_value_usd')} FROM sentiment""",
        "monthly", "traders", "sentiment",
    ),
    "csv_export": _out(_MONTHLY_FEED_COLUMNS, "monthly", "monthly"),
    "csv_export_traders": _out(_TRADER_FEED_COLUMNS, "trader_feed", "trader_feed"),
    "csv_export_sentiment": _out(_SENTIMENT_COLUMNS, "sentiment", "sentiment"),
    "verify_output": _sql("SELECT DISTINCT quarter, true AS has_files, true AS as_written FROM raw", "raw"),
    "documents_tree": _sql(
        """SELECT accession_number, count(*) AS transactions, CAST(NULL AS VARCHAR) AS problem
           FROM (SELECT DISTINCT accession_number, o_orderkey FROM listed) JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
        "listed",
    ),
    "ingest_files": _per_quarter(),
    "ingest_counts": _sql(
        """SELECT CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN 'missing'
                       WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'blank'
                       WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'unreadable'
                       ELSE 'landed' END AS outcome, count(*) AS filings
           FROM listed GROUP BY ALL""",
        "listed",
    ),
    "ingest_pathless": _per_quarter(),
    "publish_gate": _sql(
        f"""SELECT *, 'raw.transaction_code accepted_values, staging.ownership_type accepted_values' AS refused FROM (
            SELECT 'monthly_activity' AS "table", count(*) AS rows, {_money('total_value_usd')} AS total FROM monthly
            UNION ALL SELECT 'top_traders', count(*), {_money('total_value_usd')} FROM traders
            UNION ALL SELECT 'company_sentiment', count(*), {_money('net_value_usd')} FROM sentiment)""",
        "monthly", "traders", "sentiment",
    ),
    "marts_after_overwrite": _after_overwrite(_out(_MONTHLY_COLUMNS, "monthly", "monthly")),
    "traders_after_overwrite": _after_overwrite(_out(_TRADER_FEED_COLUMNS, "traders", "traders")),
    "companies_after_overwrite": _after_overwrite(_out(_SENTIMENT_COLUMNS, "sentiment", "sentiment")),
    "amended_transactions": _sql(
        """SELECT accession_number, issuer_cik, insider_name, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_code,
                  CAST(filing_date AS VARCHAR) AS filing_date, CAST(transaction_shares AS DOUBLE) AS transaction_shares, transaction_value_usd,
                  o.accession_number AS original_accession_number, CAST(o.filing_date AS VARCHAR) AS original_filing_date,
                  CAST(o.transaction_shares AS DOUBLE) AS original_shares,
                  transaction_value_usd - o.transaction_value_usd AS value_change_usd, date_diff('day', o.filing_date, filing_date) AS days_to_amend
           FROM (SELECT a.*, (SELECT struct_pack(filing_date := b.filing_date, accession_number := b.accession_number,
                                                 transaction_shares := b.transaction_shares, transaction_value_usd := b.transaction_value_usd)
                              FROM tx b WHERE b.form_type <> '4/A' AND b.filing_date <= a.filing_date
                                AND b.issuer_cik IS NOT DISTINCT FROM a.issuer_cik AND b.insider_name IS NOT DISTINCT FROM a.insider_name
                                AND b.transaction_date IS NOT DISTINCT FROM a.transaction_date AND b.transaction_code IS NOT DISTINCT FROM a.transaction_code
                              ORDER BY b.filing_date DESC, b.accession_number DESC, b.transaction_shares DESC, b.transaction_value_usd DESC LIMIT 1) AS o
                 FROM tx a WHERE a.form_type = '4/A')""",
        "tx",
    ),
    "pending_quarters": _out(
        _INDEX_COLUMNS,
        """(SELECT * FROM index_rows WHERE quarter >= '1997Q1' AND quarter IN (
               SELECT year || 'Q' || quarter FROM quarter_grid))""",
        "index_rows", "quarter_grid",
    ),
    "ticker_lookup": _sql(
        f"""SELECT insider_name, buy_sell_flag, count(*) AS rows, {_money('transaction_value_usd')} AS total_value_usd
            FROM tx WHERE issuer_ticker = 'N1' GROUP BY ALL""",
        "tx",
    ),
    "net_from_buckets": _sql("SELECT DISTINCT issuer_ticker, transaction_month_key, net_sentiment_usd FROM monthly", "monthly"),
    "cached_feed": _out(_SENTIMENT_COLUMNS, "(SELECT * FROM sentiment ORDER BY abs(net_value_usd) DESC, issuer_ticker, issuer_name LIMIT 100)", "sentiment"),
}
