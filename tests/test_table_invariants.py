"""Invariants on the real lineitem table (sf0.001) under the range plan."""

import pytest
from pyspark.sql import functions as F

from modeleval.operators import curves as C
from modeleval.operators.performance import performance, perf_view
from modeleval.plans import catalog as K
from modeleval.plans.evaluate import score
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def perf(spark):
    spec = K.LI.with_(prefix_partitions=5)
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    return performance(score(df, spec), spec)


def test_counts_add_up(perf):
    v = perf_view(perf, list(K.LI_KEY))
    bad = v.filter((F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")) != 4038).count()
    assert bad == 0
    per_series = {r["series"]: r["n"] for r in v.groupBy("series").agg(F.count("*").alias("n")).collect()}
    assert per_series == {s: 4038 for s in ("model0", "model1", "model2", "avg", "l_tax")}


def test_rates_monotone_and_start_at_one(perf, spark):
    v = perf_view(perf, list(K.LI_KEY))
    first = v.filter("current_record = 1").collect()
    assert all(r["recall"] == r["fpr"] == r["action_rate"] == 1.0 for r in first)
    assert all(r["weight_recall"] == r["weight_fpr"] == r["weight_action_rate"] == 1.0 for r in first)
    # rank order equals (score, key) order and rates never rise along it
    rows = v.select("series", "current_record", "recall", "fpr", "weight_recall").collect()
    by = {}
    for r in rows:
        by.setdefault(r["series"], []).append(r)
    for series, rs in by.items():
        rs.sort(key=lambda r: r["current_record"])
        assert [r["current_record"] for r in rs] == list(range(1, len(rs) + 1))
        for a, b in zip(rs, rs[1:]):
            assert b["recall"] <= a["recall"] and b["fpr"] <= a["fpr"]
            assert b["weight_recall"] <= a["weight_recall"]


def test_points_bounded(perf):
    pts = C.curves(perf, K.LI.buckets, list(K.LI_KEY))
    counts = pts.groupBy("series", "curve").count().collect()
    assert len(counts) == 5 * 6
    assert all(1 <= r["count"] <= K.LI.buckets + 1 for r in counts)
