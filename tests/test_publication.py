import datetime as dt

import pytest
from helpers import raw_rows
from pyspark.sql import functions as F

from ledgerline.operators.quality import QualityError
from ledgerline.plans import publication
from ledgerline.plans.warehouse import build


def test_a_failing_check_leaves_the_old_tables_served(spark, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(LookupError):
        publication.open_served(spark, root)
    publication.publish(raw_rows(spark, {}, {"issuer_ticker": "b"}), root)
    reader = publication.open_served(spark, root).monthly
    first = publication.served(spark, root)
    assert first[0] == 1 and reader.count() == 2

    with pytest.raises(QualityError, match="raw.transaction_code accepted_values"):
        publication.publish(raw_rows(spark, {}, {"transaction_code": "?"}), root)
    assert publication.served(spark, root) == first

    publication.publish(raw_rows(spark, {}), root)
    assert publication.served(spark, root)[0] == 2
    # whoever reads the old version goes on reading it
    assert reader.count() == 2 and publication.open_served(spark, root).monthly.count() == 1

    assert publication.switch(spark, root, first[1]) == 3
    assert publication.open_served(spark, root).monthly.count() == 2
    assert [r.number for r in publication.history(spark, root).collect()] == [1, 2, 3]


def test_readers_see_the_old_version_while_a_new_one_is_built(spark, tmp_path):
    root, seen = str(tmp_path / "marts"), []

    def watched(raw, path):
        stored = build(raw, path)
        seen.append(publication.served(spark, root)[0])
        return stored

    for _ in range(2):
        publication.publish(raw_rows(spark, {}), root, builder=watched)
    assert seen == [0, 1]


def test_a_report_is_kept_with_each_version(spark, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(QualityError):
        publication.publish(raw_rows(spark, {}), root, as_of=dt.date(2030, 1, 1))
    assert publication.history(spark, root).count() == 0
    path = next((tmp_path / "marts" / "versions").iterdir())
    failed = publication.audit_of(spark, str(path)).where(F.col("status") == "error").collect()
    assert [r.check for r in failed] == ["freshness"]


def test_shares_that_do_not_fit_are_not_published(spark, tmp_path):
    with pytest.raises(QualityError, match="raw.transaction_shares held"):
        publication.publish(raw_rows(spark, {"transaction_shares": 1e40}), str(tmp_path / "marts"))


def test_raw_rows_are_made_once_for_a_build_and_its_checks(spark, tmp_path, monkeypatch):
    seen, judge = [], publication.audit_all
    monkeypatch.setattr(publication, "audit_all", lambda raw, *others: seen.append(raw) or judge(raw, *others))
    publication.publish(raw_rows(spark, {}, {}), str(tmp_path))
    files = seen[0].inputFiles()
    assert files and all("/raw-" in file for file in files) and seen[0].count() == 2
