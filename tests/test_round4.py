"""Edge rows without a sort of all rows, perf files without a sort by series, a narrower range shuffle."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from modeleval.operators.performance import performance, perf_view
from modeleval.operators.prefix import prefix_sums
from modeleval.operators.series import edge_rows
from modeleval.plans import catalog as K
from modeleval.plans.evaluate import score
from modeleval.sources import sinks

LONG = "series string, score double, row_id int, tag int, weight long, weight_tag long"


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def perf(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2).cast("long").alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"),
        (F.col("id") % 97 + 1).cast("double").alias("l_extendedprice"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") % 11 / 100).alias("l_discount"), (F.col("id") % 9 / 100).alias("l_tax"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"))
    return performance(score(rows, K.LI), K.LI.with_(prefix_partitions=6))


@pytest.mark.parametrize("top", [True, False])
def test_edge_rows_take_one_range_partition_of_a_series(perf, top):
    keys = list(K.LI.row_key)
    cols = ["score", *keys, "current_record"]
    found = edge_rows(perf, keys, cols, top)
    plain = edge_rows(perf.drop("_pid"), keys, cols, top)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect())) and found.count() == 5
    assert "LeftSemi" in plan_of(found) and "LeftSemi" not in plan_of(plain)


def test_perf_files_need_no_sort_by_series(perf, spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, get = spark.conf.get(name), [], type(perf.write).parquet
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(perf.write), "parquet", lambda w, path, *a, **k: (seen.append(int(spark.conf.get(name))), get(w, path, *a, **k))[1])
        sinks.save_perf(perf_view(perf, K.LI.row_key), str(tmp_path / "perf"))
    assert seen[0] >= 5 and spark.conf.get(name) == before
    view = perf_view(perf, K.LI.row_key)
    back = spark.read.parquet(str(tmp_path / "perf")).select(*view.columns)
    assert back.count() == 15_000 and back.exceptAll(view).count() == 0


def test_range_shuffle_holds_no_place(spark):
    """Positive weights that are not those of the tag come through as they are."""
    rows = [("a", float(i % 3), i, i % 2, 10 + i, 10 + i if i % 4 == 1 else i % 5) for i in range(40)]
    long = spark.createDataFrame(rows, LONG)
    found = prefix_sums(long, ["row_id"], partitions=3, series_names=["a"]).orderBy("cum_records").collect()
    total = 0
    for r, want in zip(found, sorted(rows, key=lambda x: (x[1], x[2]))):
        assert (r.row_id, r.weight_tag, int(r.cum_weight_tag)) == (want[2], want[5], total)
        total += want[5]


def test_range_exchange_has_one_weight(spark, monkeypatch):
    from modeleval.operators import prefix

    seen = []
    monkeypatch.setattr(prefix, "materialize", lambda df, *a: seen.append(plan_of(df, "extended")) or df)
    prefix.local_sums_table(spark.createDataFrame([("a", 1.0, 1, 1, 5, 5)], LONG), ["row_id"], 2, ["a"])
    shuffle = next(x for x in seen[0].split("== Optimized Logical Plan ==")[1].splitlines() if "RepartitionByExpression" in x)
    below = seen[0].split("== Optimized Logical Plan ==")[1].split(shuffle)[1].splitlines()[1]
    assert "_place" not in below
