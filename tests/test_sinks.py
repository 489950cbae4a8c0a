import datetime as dt

from helpers import raw_rows

from ledgerline.sinks import tables
from ledgerline.sources import landing, scratch


def counts(spark, root):
    return {r.quarter: r["count"] for r in landing.read_raw(spark, root).groupBy("quarter").count().collect()}


def test_overwrite_touches_only_its_quarters(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert tables.write_raw(raw_rows(spark, {}, {}, {"quarter": "2024Q2"}), root) == 3
    tables.write_raw(raw_rows(spark, {}), root)
    assert counts(spark, root) == {"2024Q1": 1, "2024Q2": 1}
    tables.write_raw(raw_rows(spark, {}), root, mode="append")
    assert counts(spark, root) == {"2024Q1": 2, "2024Q2": 1}
    assert landing.read_raw(spark, root, ["2024Q2"]).count() == 1
    files = {r.quarter: r for r in tables.output_files(spark, root, by="quarter").collect()}
    assert files["2024Q1"].files == 2 and files["2024Q2"].files == 1 and files["2024Q1"].megabytes > 0


def test_manifest_finds_lost_changed_and_foreign_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    tables.write_raw(raw_rows(spark, {}, {"quarter": "2024Q2"}, {"quarter": "2024Q3"}), root)

    def found():
        return {r.quarter: (r.files, r.missing, r.changed, r.extra) for r in tables.verify(spark, root).collect()}

    assert found() == {q: (1, 0, 0, 0) for q in ("2024Q1", "2024Q2", "2024Q3")}
    file = {q: next((tmp_path / "raw" / f"quarter={q}").glob("*.parquet")) for q in found()}
    file["2024Q1"].rename(file["2024Q3"].parent / "foreign.parquet")
    file["2024Q2"].write_bytes(b"short")
    assert found() == {"2024Q1": (0, 1, 0, 0), "2024Q2": (1, 0, 1, 0), "2024Q3": (2, 0, 0, 1)}


def test_quarters_are_listed_without_opening_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    tables.write_raw(raw_rows(spark, {}, {"quarter": "2023Q4"}), root)
    for file in (tmp_path / "raw").rglob("*.parquet"):
        file.write_bytes(b"no table")
    assert [r.quarter for r in landing.available_quarters(spark, root).collect()] == ["2023Q4", "2024Q1"]


def test_an_empty_landing_counts_nothing(spark, tmp_path):
    rows = raw_rows(spark, {}).join(spark.range(3).where("id > 5").selectExpr("string(id) as cik"), "cik").select(*raw_rows(spark, {}).columns)
    assert tables.write_raw(rows, str(tmp_path / "raw")) == 0


def test_csv(spark, tmp_path):
    frame = spark.createDataFrame([("a,\"b\"", 1.5), (None, 2.0)], "name string, value double")
    path = tables.write_csv(frame, str(tmp_path), "top_traders", dt.date(2024, 3, 9))
    assert path.endswith("top_traders_20240309")
    back = spark.read.option("header", True).option("escape", "\\").schema(frame.schema).csv(path)
    assert sorted(back.collect(), key=str) == sorted(frame.collect(), key=str)


def test_scratch_uses_the_configured_folder(spark):
    folder = scratch.shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert folder and (configured is None or folder == configured.rstrip("/"))
    frame, rows = scratch.written(spark.range(7), "numbers")
    assert rows == 7 and frame.count() == 7
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")
