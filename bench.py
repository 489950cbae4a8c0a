"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query
runs to its last row into a sink that keeps nothing, after one warm-up query;
plan building is included. BENCH_RUNS above 1 reports the best run.
"""

from __future__ import annotations

import json
import os
import time

from ledgerline.catalog import QUERIES, published
from ledgerline.session import build_session

HEADLINE = (
    "raw_scan", "index_files", "shred_filings", "ingest_landing", "tag_value_pages", "stg_transactions",
    "int_transactions", "monthly_activity", "top_traders", "company_sentiment", "top_traders_limited",
    "sentiment_top100", "kpi_summary", "monthly_volume", "top_companies", "role_distribution", "top_sellers_90d",
    "sell_buy_ratio", "late_filers", "dq_not_null", "write_raw_roundtrip", "write_marts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "ledgerline-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["company_sentiment"](spark, folder).write.format("noop").mode("overwrite").save()
    start = time.perf_counter()
    published(spark, folder)  # landed and built once; serving queries and checks read what is stored
    seconds = {"publish": round(time.perf_counter() - start, 3)}
    for name in HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
