"""The physical plans the jobs rely on."""

import datetime as dt
import re

from helpers import plan_of, raw_rows
from pyspark.sql import functions as F

from ledgerline import catalog, schema
from ledgerline.operators import marts, serving
from ledgerline.operators.dedup import by_filing, insider_transactions
from ledgerline.operators.shred import shred_filings, shred_listings
from ledgerline.operators.staging import clean, stage
from ledgerline.session import OPEN_FILES, SPLIT, bounded_tasks
from ledgerline.sinks import tables
from ledgerline.plans import incremental
from ledgerline.plans import ingest as ingest_plan
from ledgerline.plans.ingest import ingest
from ledgerline.plans.warehouse import build, open_marts
from ledgerline.sources import documents, index, landing, tree
from ledgerline.sources.trade_tables import filing_documents


def landed(spark, tmp_path):
    root = str(tmp_path / "raw")
    tables.write_raw(raw_rows(spark, {}, {"quarter": "2024Q2"}), root)
    return landing.read_raw(spark, root)


def test_dedup_drops_copies_before_its_only_shuffle(spark, tmp_path):
    plan = plan_of(insider_transactions(clean(landed(spark, tmp_path))))
    assert plan.count("Exchange") == 1
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_stored_transactions_are_dealt_by_filing_once(spark, tmp_path):
    rows = insider_transactions(clean(by_filing(landed(spark, tmp_path))))
    plan = plan_of(rows)
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan
    assert re.search(r"Exchange hashpartitioning\(accession_number#\d+, \d+\)", plan)
    moved = plan[plan.index("Exchange"):]
    assert "company_name" not in moved and "cast(transaction_shares" not in moved and "IsNotNull(transaction_code)" in moved


def test_dealt_by_filing_the_same_rows_are_kept(spark, tmp_path):
    copies = [{"accession_number": f"a{i % 3}", "cik": str(i), "transaction_code": code} for i in range(12) for code in ("P", " s", None)]
    raw = raw_rows(spark, *copies, {"accession_number": "a0", "form_type": "4/A"}, {"accession_number": "a1", "transaction_shares": 1e31})
    plain, dealt = (insider_transactions(clean(rows)).collect() for rows in (raw, by_filing(raw)))
    assert sorted(map(str, dealt)) == sorted(map(str, plain)) and len(dealt) == 7
    build(raw, str(tmp_path / "marts"))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "marts/transactions")).select(dealt[0].__fields__).collect())) == sorted(map(str, plain))


def test_trader_totals_are_dealt_once(spark, tmp_path):
    root = str(tmp_path / "transactions")
    tables.write_table(insider_transactions(clean(landed(spark, tmp_path))), root)
    assert plan_of(marts.trader_totals(spark.read.parquet(root))).count("Exchange") == 1
    state = marts.trader_months(spark.read.parquet(root), "quarter")
    tables.write_table(state, str(tmp_path / "state"))
    merge = next(part.merged for part in incremental.STATES if part.name == "trader_months")
    assert plan_of(merge(spark.read.parquet(str(tmp_path / "state")))).count("Exchange") == 1


def test_what_a_code_says_is_not_shuffled_while_copies_are_dropped(spark, tmp_path):
    rows = insider_transactions(clean(landed(spark, tmp_path)))
    plan = plan_of(rows)
    before = plan[plan.index("Exchange"):]
    assert "transaction_code" in before and "transaction_type" not in before and "buy_sell_flag" not in before
    assert [(row.transaction_type, row.buy_sell_flag) for row in rows.collect()] == [("Purchase", "Buy")] * 2


def test_codes_are_trimmed_once_and_looked_up_in_a_step_of_their_own(spark, tmp_path):
    cleaned = clean(landed(spark, tmp_path)).select("transaction_code", "transaction_type", "buy_sell_flag")
    assert plan_of(cleaned).count("trim(trim(transaction_code") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    raw = landed(spark, tmp_path)
    plan = plan_of(stage(raw.where(F.col("quarter") == "2024Q1")).select("issuer_ticker", "buy_sell_flag"))
    assert "PartitionFilters: [isnotnull(quarter" in plan and "IsNotNull(transaction_code)" in plan
    assert "ReadSchema: struct<issuer_ticker:string,transaction_code:string>" in plan
    assert "Exchange" not in plan


def test_company_totals_do_not_expand_rows(spark, tmp_path):
    plan = plan_of(marts.company_totals(insider_transactions(clean(landed(spark, tmp_path)))))
    assert "Expand" not in plan and "officer_title" not in plan.split("ReadSchema")[0].split("HashAggregate")[1]


def test_document_text_is_not_shuffled(spark, tmp_path):
    lines = spark.createDataFrame([("x", "2024Q1")], "value string, quarter string")
    path = str(tmp_path / "docs")
    spark.createDataFrame([("a", "<x/>")], "accession_number string, xml string").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(shred_filings(index.parse_index(lines), spark.read.parquet(path)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    documents_side = plan[plan.rindex("Exchange"):]
    assert "regexp_extract_all" in documents_side and "Generate" in documents_side
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_top_lists_do_not_sort_everything(spark, tmp_path):
    monthly = marts.monthly_activity(insider_transactions(clean(landed(spark, tmp_path))))
    assert "TakeOrderedAndProject" in plan_of(serving.top_companies(monthly))


def test_monthly_rows_are_aggregated_before_they_are_expanded(spark, tmp_path):
    plan = plan_of(marts.monthly_activity(insider_transactions(clean(landed(spark, tmp_path)))))
    below = plan[plan.index("Expand"):]
    assert "HashAggregate(keys=[transaction_month_key" in below or "SortAggregate(key=[transaction_month_key" in below


def test_first_filings_sort_no_whole_quarter(spark, tmp_path):
    path = str(tmp_path / "index")
    spark.createDataFrame([("x", "2024Q1")], "value string, quarter string").write.parquet(path)
    lines = spark.read.parquet(path)
    for n in (10, 1001):
        plan = plan_of(index.first_filings(index.parse_index(lines), n))
        assert "row_number() windowspecdefinition(quarter" in plan and "_part" in plan.split("row_number() windowspecdefinition(quarter")[1][:40]


def packed(spark, tmp_path):
    root = str(tmp_path / "packed")
    rows = [(f"a{i}", f"<x>{i}</x>", f"edgar/{copy}/a{i}.txt", f"2024Q{i}") for i in (1, 2) for copy in (1, 2)]
    tables.write_documents(spark.createDataFrame(rows, documents.PACKED), root)
    return root


def test_packed_documents_are_pruned_by_quarter(spark, tmp_path):
    root = packed(spark, tmp_path)
    some = documents.read_packed_documents(spark, root, ["2024Q1"])
    assert "PartitionFilters: [isnotnull(quarter" in plan_of(some) and "PushedFilters: []" in plan_of(some)
    assert {file.split("quarter=")[1][:6] for file in some.inputFiles()} >= {"2024Q1"} and some.count() == 2


def test_restricted_ingest_never_opens_other_quarters(spark, tmp_path):
    root = packed(spark, tmp_path)
    for file in (tmp_path / "packed" / "quarter=2024Q2").glob("*.parquet"):
        file.write_bytes(b"not a table")
    for crc in (tmp_path / "packed" / "quarter=2024Q2").glob(".*.crc"):
        crc.write_bytes(b"")
    line = f"{'Co':62}{'4':12}{'7':12}{'2024-01-02':12}edgar/1/a1.txt"
    lines = spark.createDataFrame([(line, "2024Q1"), (line.replace("a1", "a2"), "2024Q2")], "value string, quarter string")
    assert ingest(lines, documents.read_packed_documents(spark, root), str(tmp_path / "raw"), quarters=["2024Q1"]).rows == 1


def test_filters_reach_the_stored_tables(spark, tmp_path):
    root = str(tmp_path / "marts")
    build(landed(spark, tmp_path), root)
    stored = open_marts(spark, root)
    plan = plan_of(serving.filter_activity(stored.monthly, ["ACM"], "Buy", ["2024-03"]))
    assert "PartitionFilters: [isnotnull(transaction_month_key" in plan and "EqualTo(issuer_ticker,ACM)" in plan
    assert "LessThanOrEqual(rank_by_value,50)" in plan_of(serving.trader_feed(stored.traders))


def scanned_rows(frame) -> int:
    """Rows that the scan of a finished query without exchanges gave on."""
    frame._jdf.collectToPython()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    plain, lookup = str(tmp_path / "plain"), str(tmp_path / "lookup")
    rows = spark.range(60_000).selectExpr(
        "concat('t', id % 300) as issuer_ticker", "sha2(string(id), 256) as insider_name", "repeat(string(id), 5) as filling"
    )
    spark._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    try:
        tables.write_for_lookups(rows, lookup, ("issuer_ticker", "insider_name"))
        tables.write_table(rows, plain)
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    for root, least, most in ((plain, 50_000, 60_000), (lookup, 200, 12_000)):
        found = spark.read.parquet(root).where("issuer_ticker = 't7'")
        assert least <= scanned_rows(found) <= most and found.count() == 200
    # within the range of every row group, but in no Bloom filter
    nobody = F.col("insider_name") == F.sha2(F.lit("nobody"), 256)
    absent = spark.read.parquet(lookup).where(nobody)
    assert scanned_rows(absent) < 20_000 and absent.count() == 0
    assert scanned_rows(spark.read.parquet(plain).where(nobody)) > 50_000


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    totals = marts.monthly_totals(insider_transactions(clean(landed(spark, tmp_path))))
    stored = tables.write_bucketed(totals, "bucketed_months", str(tmp_path / "buckets"), ("issuer_ticker",), 3, ("issuer_ticker", "transaction_month_key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        net = plan_of(marts.with_net(stored))
        joined = plan_of(stored.alias("a").join(stored.alias("b"), "issuer_ticker"))
        plain = plan_of(marts.with_net(totals))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in net and "Window" in net and "Exchange" not in joined and "Exchange" in plain
    assert sorted(map(str, marts.with_net(stored).select(sorted(stored.columns)).collect())) == sorted(map(str, marts.with_net(totals).select(sorted(stored.columns)).collect()))
    spark.sql("drop table bucketed_months")


def test_pending_quarters_are_pruned_at_run_time(spark, tmp_path):
    lines, raw = str(tmp_path / "lines"), str(tmp_path / "raw")
    line = f"{'Co':62}{'4':12}{'7':12}{'2024-01-02':12}edgar/1/a1.txt"
    spark.createDataFrame([(line, q) for q in ("2023Q3", "2023Q4", "2024Q1", "2024Q2")], "value string, quarter string").write.partitionBy("quarter").text(lines)
    tables.write_raw(raw_rows(spark, {"quarter": "2023Q3"}, {"quarter": "2024Q2"}), raw)
    due = spark.createDataFrame([(q,) for q in ("2023Q3", "2024Q1", "2024Q4")], "quarter string").where("quarter < '2024Q4'")
    waiting = landing.pending(due, landing.available_quarters(spark, raw))
    rows = landing.of_quarters(index.read_partitioned_lines(spark, lines), waiting)
    assert "dynamicpruning" in plan_of(rows).lower()
    assert [r.quarter for r in index.parse_index(rows).collect()] == ["2024Q1"]


def test_refresh_filters_partitions(spark, tmp_path):
    landed(spark, tmp_path)
    some = landing.read_raw(spark, str(tmp_path / "raw"), ["2024Q2"])
    assert "PartitionFilters: [isnotnull(quarter" in plan_of(some) and some.count() == 1


def test_ranks_read_totals_that_were_made_once(spark):
    rows = insider_transactions(clean(spark.createDataFrame([], schema.RAW)))
    for ranked, label in ((marts.top_traders(rows), "trader-totals"), (marts.company_sentiment(rows), "company-totals")):
        plan = ranked._jdf.queryExecution().optimizedPlan().toString()
        assert "transaction_code" not in plan and ranked.count() == 0
        assert any(label in name for name in ranked.inputFiles())


def test_states_of_the_monthly_table_are_made_behind_a_shuffle_of_plain_rows(spark, tmp_path):
    root = str(tmp_path / "transactions")
    tables.write_table(insider_transactions(clean(landed(spark, tmp_path))), root)
    stored = spark.read.parquet(root)
    plan = plan_of(marts.filing_months(stored))
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    assert marts.filing_months(stored).count() == 2


def test_states_of_the_monthly_table_leave_in_the_order_of_company_and_month(spark):
    raw = raw_rows(spark, *[{"issuer_ticker": f"t{i * 7 % 10}", "transaction_date": dt.date(2024, 1 + i * 5 % 12, 1)} for i in range(200)])
    states = marts.filing_months(insider_transactions(clean(raw))).withColumn("task", F.spark_partition_id()).collect()
    for task in {row.task for row in states}:
        seen = [(row.issuer_ticker, row.transaction_month_key) for row in states if row.task == task]
        assert seen == sorted(seen)
    assert len(states) == 200


def test_rows_are_landed_where_they_are(spark, tmp_path):
    rows = raw_rows(spark, *[{"accession_number": f"a{i % 10}", "cik": str(i), "quarter": f"2024Q{1 + i % 2}"} for i in range(40)])
    assert tables.write_raw(rows.repartition(4, "accession_number"), str(tmp_path / "raw")) == 40
    named = landing.read_raw(spark, str(tmp_path / "raw")).select("accession_number", "quarter", F.input_file_name().alias("file"))
    files = named.groupBy("accession_number", "quarter").agg(F.countDistinct("file").alias("files"))
    assert {row.files for row in files.collect()} == {1}
    assert len(list((tmp_path / "raw" / "quarter=2024Q1").glob("*.parquet"))) > 1


def test_tables_are_made_by_bounded_tasks_and_settings_come_back(spark, tmp_path):
    splits, writers = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    before = [spark.conf.get(key, None) for key in (splits, writers)]
    with bounded_tasks(spark):
        seen = [int(spark.conf.get(key)) for key in (splits, writers)]
    assert seen == [SPLIT, OPEN_FILES] and [spark.conf.get(key, None) for key in (splits, writers)] == before
    spark.conf.set(splits, "1m")
    try:
        with bounded_tasks(spark):
            assert int(spark.conf.get(splits)) == 2**20
        assert spark.conf.get(splits) == "1m"
    finally:
        spark.conf.unset(splits) if before[0] is None else spark.conf.set(splits, before[0])


def test_landed_quarters_are_whole_and_packed(spark, tmp_path):
    quarters = [f"{year}Q{quarter}" for year in range(2018, 2024) for quarter in range(1, 5)]
    rows = raw_rows(spark, *[{"quarter": quarter} for quarter in quarters * 20])
    tables.write_raw(rows, str(tmp_path / "many"))
    assert sorted(row.quarter for row in landing.read_raw(spark, str(tmp_path / "many")).collect()) == sorted(quarters * 20)
    assert all("zstd" in path.name for path in (tmp_path / "many").glob("quarter=*/*.parquet"))


def test_document_texts_are_stored_where_they_are(spark, tmp_path):
    rows = [(f"a{i}", f"<x>{i}</x>", f"2024Q{1 + i % 2}") for i in range(40)]
    frame = spark.createDataFrame(rows, "accession_number string, xml string, quarter string").repartition(4, "accession_number")
    tables.write_documents(frame, str(tmp_path / "packed"))
    files = list((tmp_path / "packed" / "quarter=2024Q1").glob("*.parquet"))
    assert len(files) > 1 and all("zstd" in file.name for file in files)
    assert sorted((r.accession_number, r.xml, r.quarter) for r in documents.read_packed_documents(spark, str(tmp_path / "packed")).collect()) == sorted(rows)


def test_index_lines_are_stored_where_they_are(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(str(i), "2024Q1") for i in range(40)], "value string, quarter string").repartition(4, "value")
    monkeypatch.setattr(catalog, "index_lines", lambda *_: lines)
    catalog._write_index(spark, "", str(tmp_path / "index"))
    assert len(list((tmp_path / "index" / "quarter=2024Q1").glob("*.gz"))) > 1
    assert sorted(row.value for row in index.read_index_lines(spark, str(tmp_path / "index")).collect()) == sorted(map(str, range(40)))


def test_documents_of_a_tree_are_parsed_where_they_are_read(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/tree"
    tree.write_bundles(spark.createDataFrame([("edgar/1/a1.txt", "<x/>")], "path string, xml string"), root)
    lines = spark.createDataFrame([(f"{'Co':62}{'4':12}{'7':12}{'2024-01-02':12}edgar/1/a1.txt", "2024Q1")], "value string, quarter string")
    seen = []
    monkeypatch.setattr(ingest_plan, "_land", lambda listed, found, *_: seen.append(shred_listings(listed, found)))
    ingest_plan.ingest_tree(lines, root, str(tmp_path / "raw"))
    assert "WindowGroupLimit" not in plan_of(seen[0]) and "row_number" not in plan_of(seen[0])
    assert [row.accession_number for row in seen[0].collect()] == ["a1"]


def test_lines_spread_over_cores_need_no_second_shuffle_to_become_documents(spark):
    plan = plan_of(filing_documents(spark, "/root/testdata/sf0.001"))
    last, first = plan.split("ObjectHashAggregate")[1:3]
    assert "Exchange" not in last and "Exchange hashpartitioning(o_orderkey" in first
