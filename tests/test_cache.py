import shutil

from pyspark.sql import functions as F

from ledgerline.catalog import QUERIES
from ledgerline.plans.cache import ResultCache, version_of

SMALL = "/root/testdata/sf0.001"


def test_results_live_until_time_change_or_refresh(spark, tmp_path):
    source, now = str(tmp_path / "source"), [1000.0]
    spark.range(5).write.parquet(source)
    cache = ResultCache(spark, seconds=60, clock=lambda: now[0])

    def get():
        return cache.get("sum", [source], lambda: spark.read.parquet(source).agg(F.sum("id").alias("total"))).first().total

    assert (get(), get(), cache.made) == (10, 10, 1)
    now[0] += 59
    assert (get(), cache.made) == (10, 1)
    now[0] += 1
    assert (get(), cache.made) == (10, 2)
    spark.range(7).write.mode("overwrite").parquet(source)
    assert (get(), cache.made) == (21, 3)
    cache.refresh("sum")
    assert (get(), cache.made) == (21, 4)
    cache.refresh()
    assert (get(), cache.made) == (21, 5)
    shutil.rmtree(cache.entries["sum"].path.removeprefix("file:"))  # the shared folder was cleared
    assert (get(), cache.made) == (21, 6)


def test_versions_follow_names_sizes_and_times(spark, tmp_path):
    file = tmp_path / "a"
    file.write_text("x")
    first = version_of(spark, [str(file)])
    assert version_of(spark, [str(file)]) == first
    file.write_text("xy")
    second = version_of(spark, [str(file)])
    (tmp_path / "b").write_text("xy")
    assert len({first, second, version_of(spark, [str(tmp_path)])}) == 3


def test_stored_tables_follow_changed_input(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
        (tmp_path / f"{name}.parquet").chmod(0o644)

    def counted():
        return QUERIES["kpi_summary"](spark, str(tmp_path)).first().total_transactions

    before = counted()
    spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_linenumber % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "half"))
    shutil.copy(next((tmp_path / "half").glob("*.parquet")), tmp_path / "lineitem.parquet")
    after = counted()
    assert 0 < after < before and counted() == after
