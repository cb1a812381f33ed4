"""The window plan shuffles once: its range partitions are written in buckets."""

from pyspark.sql import functions as F

from modeleval.operators.prefix import local_sums_table, prefix_sums
from tests.test_round4 import LONG, plan_of


def rows_of(spark):
    return spark.createDataFrame([("ab"[i % 2], float(i * 7 % 5), i, i % 3 % 2, 10 + i, 10 + i if i % 3 == 1 else 0) for i in range(300)], LONG)


def test_window_sums_read_buckets_without_a_shuffle(spark):
    table = local_sums_table(rows_of(spark), ["row_id"], 6, ["a", "b"], local="window")
    plan = plan_of(table)
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    # One range partition is one file, and the name used for the buckets is gone.
    files = table.select("_pid", F.input_file_name().alias("f")).distinct().groupBy("_pid").count()
    assert files.filter("count > 1").count() == 0
    assert not [t for t in spark.catalog.listTables("spark_catalog.default") if t.name.startswith("ranged")]


def test_window_and_range_sums_agree(spark):
    found = [prefix_sums(rows_of(spark), ["row_id"], method=m, partitions=6, series_names=["a", "b"]).drop("_pid") for m in ("window", "range")]
    assert found[0].count() == 300 and found[0].exceptAll(found[1]).count() == 0 and found[1].exceptAll(found[0]).count() == 0
