import datetime as dt

import pytest
from helpers import raw_rows

from ledgerline.operators import quality
from ledgerline.operators.dedup import insider_transactions
from ledgerline.operators.quality import CHECKS, Check, QualityError, audit, freshness, require, unique
from ledgerline.operators.staging import UNHELD, clean, stage


def test_audit_counts_and_severity(spark):
    raw = raw_rows(spark, {"transaction_code": "P"}, {"transaction_code": "p"}, {"transaction_code": None}, {"quarter": None})
    report = audit(raw, "raw", CHECKS["raw"])
    rows = {(r.column, r.check): (r.failures, r.status) for r in report.collect()}
    assert rows["accession_number", "not_null"] == (0, "pass")
    assert rows["quarter", "not_null"] == (1, "error")
    assert rows["transaction_code", "accepted_values"] == (1, "error")
    with pytest.raises(QualityError, match="raw.quarter not_null"):
        require(report)
    require(audit(raw, "raw", (Check("quarter"),)))


def test_number_of_checks():
    assert sum(len(checks) for checks in CHECKS.values()) + 1 == 25


def test_unique(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "t string")
    assert unique(frame, "m", "t").first().failures == 1
    assert unique(frame.where("t = 'b'"), "m", "t").first().status == "pass"


@pytest.mark.parametrize("days, status", [(45, "pass"), (46, "warn"), (90, "warn"), (91, "error")])
def test_freshness(spark, days, status):
    loaded = dt.datetime(2024, 1, 1, 12)
    raw = raw_rows(spark, {"ingested_at": loaded})
    assert freshness(raw, "raw", loaded.date() + dt.timedelta(days=days)).first().status == status


def test_freshness_of_nothing(spark):
    assert freshness(raw_rows(spark, {}).limit(0), "raw", dt.date(2024, 1, 1)).first().status == "error"


def test_rejected_numbers_name_their_reason(spark):
    shares = [1.0, None, 9e28, 1e30, float("inf"), float("-inf"), float("nan")]
    rows = raw_rows(spark, *[{"accession_number": str(i), "transaction_shares": v} for i, v in enumerate(shares)])
    found = {r.accession_number: r.reason for r in quality.rejected_numbers(rows).collect()}
    assert found == {"3": "too large", "4": "infinite", "5": "infinite", "6": "not a number"}


def test_stale_tables_are_reported_like_other_checks(spark):
    rows = raw_rows(spark, {})
    for days, failures, status in ((1, 0, "pass"), (60, 1, "warn"), (200, 1, "error")):
        row = quality.stale(rows, "raw", dt.date(2024, 3, 6) + dt.timedelta(days)).first()
        assert (row.failures, row.status) == (failures, status)
    assert quality.stale(rows.limit(0), "raw", dt.date(2024, 3, 6)).first().status == "error"


def test_shares_that_do_not_fit_are_counted_and_stay_apart(spark):
    same = {"accession_number": "a"}
    rows = raw_rows(spark, *[{**same, "transaction_shares": v} for v in (1e40, 2e40, 1e40, 5.0, 5.0, None)])
    assert (quality.unheld(rows).first().failures, quality.unheld(rows).first().status) == (3, "error")
    kept = insider_transactions(clean(rows))
    assert kept.count() == 4 and UNHELD not in kept.columns and UNHELD not in stage(rows).columns


def test_values_too_large_for_exact_sums_are_counted(spark):
    rows = insider_transactions(clean(raw_rows(spark, {"transaction_shares": 1e28, "price_per_share": 1e20}, {}, {"price_per_share": None})))
    found = {r.column: (r.failures, r.status) for r in quality.inexact(rows, "intermediate", quality.EXACT).collect()}
    assert found == {"transaction_value_usd": (1, "warn"), "price_per_share": (0, "pass")}
