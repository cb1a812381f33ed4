"""Disk of the running sums: a narrow shuffle, its files removed, narrow tables, enough partitions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from modeleval.operators import prefix
from modeleval.operators.performance import performance
from modeleval.operators.prefix import Packed, local_sums_table, prefix_sums
from modeleval.plans import catalog as K
from modeleval.plans import queries
from modeleval.plans.evaluate import score
from modeleval.session import scratch_owner, shuffles_removed
from tests.conftest import SF_SMALL

KEYED = "series string, score double, price double, row_id long, tag int, weight long, weight_tag long"


def keyed_rows(spark, odd=False):
    """Rows whose weight is trunc(price * 1000); with ``odd`` some are not, and some have no price."""
    rows = []
    for i in range(300):
        price, weight = i % 37 / 4, int(i % 37 / 4 * 1000)
        if odd and i % 5 == 0:
            price, weight = [None, float("nan"), 1e300, price][i // 5 % 4], i % 3 * 2**40
        rows.append(("ab"[i % 2], float(i * 7 % 5), price, i, i % 3 % 2, weight, weight if i % 3 == 1 else 0))
    return spark.createDataFrame(rows, KEYED).repartition(3)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_packed_rows_come_back_as_they_were(spark):
    far, near = 2**63 - 1, 2**31 - 1
    schema = "a long, b int, c short, d byte, e long, name string, x double, f long not null"
    rows = [(far, near, 2**15 - 1, 127, -1, "k", 0.5, 1), (-far - 1, -near - 1, -2**15, -128, 2**32, None, None, -2**32),
            (None, None, None, None, None, "n", float("inf"), far), (0, -1, 0, -1, None, "", -0.0, 0), (2**31, 0, None, 5, -2**31, "z", 1.0, -far - 1)]
    df = spark.createDataFrame(rows, schema)
    packed = Packed(df, ["e"])
    back = packed.rows.select(*[c.alias(n) for n, c in packed.columns.items()])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    # Eleven halves, one set of NULL bits, and the two columns that are no whole numbers.
    assert packed.rows.columns[0] == "_nulls" and len(packed.rows.columns) == 8


def test_packed_rows_with_more_nullable_columns_than_bits(spark):
    df = spark.createDataFrame([tuple(range(70)), (None,) * 70], ",".join(f"c{i} int" for i in range(70)))
    packed = Packed(df)
    back = packed.rows.select(*[c.alias(n) for n, c in packed.columns.items()])
    assert back.exceptAll(df).count() == 0 and len(packed.rows.columns) < 45


@pytest.mark.parametrize("local", ["arrow", "window"])
def test_written_sums_leave_no_shuffle_files(spark, local):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = keyed_rows(spark).localCheckpoint()
    before, conf = shuffle_files(spark), spark.conf.get(name, None)
    table = local_sums_table(rows, ["price", "row_id"], 6, ["a", "b"], local=local)
    ends = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < ends:
        time.sleep(0.2)
    assert not left and spark.conf.get(name, None) == conf
    assert table.count() == 300


def test_the_setting_comes_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(name, "false")
    try:
        with pytest.raises(KeyError), shuffles_removed(spark):
            assert spark.conf.get(name) == "true"
            raise KeyError
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("local", ["arrow", "window"])
def test_a_weight_from_the_row_key_is_not_written(spark, local):
    with scratch_owner() as paths:
        table = local_sums_table(keyed_rows(spark), ["price", "row_id"], 6, ["a", "b"], local, ("price", 1000))
    files = spark.read.parquet(paths[0])
    assert not {"weight", "weight_tag"} & set(files.columns)
    assert files.filter("_odd <> 0 OR _differs <> 0").count() == 0
    assert table.filter("weight = 0").count() < 20 and table.filter("weight_tag > 0").count() > 50


@pytest.mark.parametrize("method", ["range", "window"])
@pytest.mark.parametrize("odd", [False, True])
def test_sums_are_the_same_with_weights_from_the_row_key(spark, method, odd):
    rows = keyed_rows(spark, odd).localCheckpoint()
    plain, given = (prefix_sums(rows, ["price", "row_id"], method, 6, series_names=["a", "b"], weight_from=w).drop("_pid")
                    for w in (None, ("price", 1000)))
    assert given.columns == plain.columns and given.count() == 300
    assert given.exceptAll(plain).count() == 0 and plain.exceptAll(given).count() == 0
    if not odd:
        for name in ("a", "b"):
            found = sorted((r for r in given.collect() if r.series == name), key=lambda r: (r.score, r.price, r.row_id))
            assert [int(r.cum_weight) for r in found] == [sum(x.weight for x in found[:i]) for i in range(len(found))]


def test_only_whole_neighbours_are_written_for_curves(spark):
    with scratch_owner() as paths:
        performance(score(K.lineitem(spark, SF_SMALL), K.LI), K.LI)
    types = dict(spark.read.parquet(paths[0]).dtypes)
    assert types["prev_score"] == types["next_score"] == "int"
    assert not {"weight", "weight_tag"} & set(types)


def test_partitions_follow_the_bytes_of_the_files(spark, tmp_path, monkeypatch):
    spark.range(20000).select("id", F.rand(1).alias("score")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert prefix._range_partitions(rows, None, 5) == least and prefix._range_partitions(rows, 3, 5) == 3
    monkeypatch.setattr(prefix, "TARGET_PARTITION_BYTES", 10_000)
    size = sum(os.path.getsize(tmp_path / "t" / f) for f in os.listdir(tmp_path / "t") if f.endswith(".parquet"))
    assert size * 5 / 10_000 <= prefix._range_partitions(rows, None, 5) <= size * 5 / 10_000 + 1
    # A join's estimate is the product of both sides; the files' sum holds. Rows from no files have no known size.
    assert prefix._range_partitions(rows.join(rows.select("id"), "id"), None, 5) <= 2 * size * 5 / 10_000 + 1
    made = spark.sparkContext.parallelize([(1, 0.5)] * 10).toDF(["id", "score"]).select("id")
    assert prefix._range_partitions(made, None, 5) == least


def test_saved_perf_keeps_no_running_sums(spark):
    with scratch_owner() as paths:
        saved = queries.q_save_perf(spark, SF_SMALL)
    kept = [os.path.basename(p).rsplit("-", 1)[0] for p in paths if os.path.exists(p)]
    assert kept == ["perf"] and saved.count() > 0
