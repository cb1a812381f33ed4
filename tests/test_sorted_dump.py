"""The sorted dump of range-partitioned rows shuffles no row again."""

import pytest
from pyspark.sql import functions as F

from modeleval.operators.performance import perf_rows
from modeleval.operators.prefix import running_sums
from modeleval.sources import sinks
from tests.test_round6 import plan, rows_of


def places(spark, path):
    rows = spark.read.parquet(path).select("series", "current_record", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    return {s: [r.current_record for r in sorted(rows.filter(F.col("series") == s).collect(), key=lambda r: (r.f, r.i))] for s in ("a", "b")}


def test_sorted_dump_by_ranges_has_no_shuffle(spark, tmp_path, monkeypatch):
    found = running_sums(rows_of(spark), ["row_id"], partitions=12, series_names=["a", "b"])
    ranked = perf_rows(found, ["row_id"], 10).select("series", "score", "row_id", "current_record", "_pid")
    assert "Exchange" not in plan(ranked)
    monkeypatch.setattr(type(ranked), "repartitionByRange", lambda *a: pytest.fail("the rows are shuffled again"))
    before = {n: spark.conf.get(n) for n in sinks._SPLITS}
    path = sinks.save_sorted(ranked, str(tmp_path / "dump"), ranges="_pid")
    assert {n: spark.conf.get(n) for n in sinks._SPLITS} == before
    assert places(spark, path) == {s: list(range(1, 301)) for s in ("a", "b")}


def test_sorted_dump_of_ranges_in_many_tasks(spark, tmp_path):
    """Where a range is in several tasks, its rows are ranged by rank as without ``ranges``."""
    found = running_sums(rows_of(spark), ["row_id"], partitions=3, series_names=["a", "b"])
    ranked = perf_rows(found, ["row_id"], 10).select("series", "score", "row_id", "current_record", "_pid").repartition(4)
    path = sinks.save_sorted(ranked, str(tmp_path / "dump"), partitions=5, ranges="_pid")
    assert places(spark, path) == {s: list(range(1, 301)) for s in ("a", "b")}
    assert "_pid" not in spark.read.parquet(path).columns
