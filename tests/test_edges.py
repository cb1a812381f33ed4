"""Edge sets: one-class data, ties, zero weights, missing scores, empty input, B = 1."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from modeleval.operators import curves as C
from modeleval.operators.labels import run_counters
from modeleval.operators.performance import performance, perf_view
from modeleval.operators.scoring import ExprScorer
from modeleval.operators.series import series_sources, series_unpivot
from modeleval.plans.evaluate import evaluate, score
from modeleval.spec import EvalSpec

SCHEMA = "row_id INT, score DOUBLE, tag STRING, weight DOUBLE"


def spec(**kw):
    base = dict(target="tag", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",),
                scorers=(ExprScorer("score"),), weight_col="weight", buckets=4)
    base.update(kw)
    return EvalSpec(**base)


def perf_of(spark, rows, **kw):
    s = spec(**kw)
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["row_id"]: r for r in perf_view(performance(score(df, s), s), ["row_id"]).collect()}


@pytest.mark.parametrize("method", ["window", "range"])
def test_all_positive(spark, method):
    got = perf_of(spark, [(i, float(i), "R", 1.0) for i in range(5)], prefix_method=method)
    assert all(math.isnan(r["fpr"]) and math.isnan(r["weight_fpr"]) for r in got.values())
    assert all(r["precision"] == 1.0 for r in got.values())


@pytest.mark.parametrize("method", ["window", "range"])
def test_all_negative(spark, method):
    got = perf_of(spark, [(i, float(i), "N", 1.0) for i in range(5)], prefix_method=method)
    assert all(math.isnan(r["recall"]) for r in got.values())
    assert all(r["precision"] == 0.0 for r in got.values())


def test_all_tied_follow_key_order(spark):
    rows = [(i, 5.0, "R" if i % 2 else "N", 1.0) for i in range(9)]
    got = perf_of(spark, rows, prefix_method="range", prefix_partitions=4)
    assert [got[i]["current_record"] for i in range(9)] == list(range(1, 10))


def test_zero_weights(spark):
    got = perf_of(spark, [(1, 1.0, "R", 0.0), (2, 2.0, "N", 0.0)])
    r = got[1]
    assert math.isnan(r["weight_action_rate"]) and math.isnan(r["weight_recall"])
    assert r["weight_precision"] == 1.0


def test_no_weight_column_matches_unit(spark):
    got = perf_of(spark, [(i, float(i % 3), "R" if i % 2 else "N", 7.0) for i in range(8)],
                  weight_col=None)
    for r in got.values():
        assert r["weight_recall"] == r["recall"] or (math.isnan(r["weight_recall"]) and math.isnan(r["recall"]))
        assert r["weight_action_rate"] == r["action_rate"]
        assert r["weight_tp"] == 1000 * r["tp"]


def test_missing_score(spark):
    rows = [(1, None, "R", 1.0), (2, 2.0, "N", 1.0), (3, 3.0, "R", 1.0)]
    with pytest.raises(Exception, match="No score value"):
        perf_of(spark, rows)
    got = perf_of(spark, rows, on_missing_score="drop")
    assert set(got) == {2, 3}


def test_nan_score_sorts_last(spark):
    got = perf_of(spark, [(1, float("nan"), "R", 1.0), (2, 2.0, "N", 1.0), (3, 3.0, "R", 1.0)],
                  prefix_method="range", prefix_partitions=2)
    assert got[1]["current_record"] == 3


def test_unparsable_weight_fails(spark):
    df = spark.createDataFrame([(1, 1.0, "R", "abc")], "row_id INT, score DOUBLE, tag STRING, weight STRING")
    with pytest.raises(Exception):
        run_counters(score(df, spec())).collect()


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = evaluate(df, spec())
    assert out["counters"].collect()[0]["records"] == 0
    assert out["perf"].count() == 0 and out["points"].count() == 0


def test_partition_without_rows(spark):
    rows = [(i, 1.0 if i < 5 else 100.0, "R" if i % 3 else "N", 1.0) for i in range(10)]
    got = perf_of(spark, rows, prefix_method="range", prefix_partitions=12)
    ref = perf_of(spark, rows, prefix_method="window")
    assert got == ref


def test_one_bucket(spark):
    s = spec(buckets=1)
    df = spark.createDataFrame([(i, float(i), "R" if i % 2 else "N", 1.0) for i in range(6)], SCHEMA)
    points = C.curves(performance(score(df, s), s), 1, ["row_id"])
    # with B = 1 only the top row and the rows where a rate reaches 1.0 remain
    assert points.filter(F.col("curve") == "gain").count() == 2


def test_series_names_and_avg_rule():
    one = spec()
    three = spec(scorers=("score", "score * 2", "score + 1"), score_meta_cols=("m",))
    assert [n for n, _ in series_sources(one)] == ["model0"]
    assert [n for n, _ in series_sources(three)] == ["model0", "model1", "model2", "avg", "m"]
    with pytest.raises(ValueError, match="clash"):
        series_sources(spec(score_meta_cols=("weight",)))


def test_three_models_stats(spark):
    s = spec(scorers=("score", "score * 2", "score + 1"), score_meta_cols=("m",))
    df = spark.createDataFrame([(1, 4.0, "R", 2.0, 0.5), (2, 1.0, "N", 3.0, 0.7)], SCHEMA + ", m DOUBLE")
    r = {x["row_id"]: x for x in score(df, s).collect()}
    assert (r[1]["score_max"], r[1]["score_min"], r[1]["score_median"]) == (8.0, 4.0, 5.0)
    assert r[1]["score_avg"] == pytest.approx(17 / 3)
    long = series_unpivot(score(df, s), s)
    assert sorted({x["series"] for x in long.collect()}) == ["avg", "m", "model0", "model1", "model2"]


def test_non_numeric_meta_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, "R", 1.0, "x"), (2, 2.0, "N", 1.0, "2.5")],
                               "row_id INT, score DOUBLE, tag STRING, weight DOUBLE, m STRING")
    s = spec(score_meta_cols=("m",))
    got = {r["row_id"]: r["meta_m"] for r in score(df, s).collect()}
    assert got == {1: None, 2: 2.5}


def test_thin_perf(spark):
    s = spec()
    df = spark.createDataFrame([(i, float(i // 2), "R" if i % 3 else "N", 1.0) for i in range(40)], SCHEMA)
    perf = performance(score(df, s), s)
    assert C.thin_perf(perf, 4, ["row_id"], thin=False).count() == 40
    thin = C.thin_perf(perf, 4, ["row_id"], thin=True).count()
    assert 0 < thin < 40


def test_bad_spec():
    with pytest.raises(ValueError):
        spec(pos_tags=("R",), neg_tags=("R",))
    with pytest.raises(ValueError):
        spec(prefix_method="global")


def test_median_with_missing_scores(spark):
    s = spec(scorers=("score", "nullif(score, 4.0)", "score + 1"))
    df = spark.createDataFrame([(1, 4.0, "R", 2.0), (2, 1.0, "N", 3.0)], SCHEMA)
    r = {x["row_id"]: x for x in score(df, s).collect()}
    assert r[1]["score_median"] == 4.5 and r[1]["score_avg"] == 4.5
    assert r[1]["score_max"] == 5.0 and r[1]["score_min"] == 4.0
    assert r[2]["score_median"] == 1.0


def test_series_id_round_trip_and_unknown_name(spark):
    from modeleval.operators.prefix import decode_series, encode_series
    df = spark.createDataFrame([("avg",), ("model0",)], "series STRING")
    names = ["model0", "avg"]
    back = encode_series(df, names).select(decode_series(F.col("series"), names).alias("s"))
    assert sorted(r["s"] for r in back.collect()) == ["avg", "model0"]
    with pytest.raises(Exception):
        encode_series(spark.createDataFrame([("other",)], "series STRING"), names).collect()
