"""The hand-worked six-row set (plus one unlabelled row) with every value known."""

import math

import pytest
from pyspark.sql import functions as F

from modeleval.operators import curves as C
from modeleval.operators.labels import run_counters
from modeleval.operators.performance import performance, perf_view
from modeleval.operators.scoring import ExprScorer
from modeleval.plans.evaluate import evaluate, score
from modeleval.spec import EvalSpec

ROWS = [(1, 100.0, "N", 1.0), (2, 250.4, "N", 2.0), (3, 250.9, "R", 1.5), (4, 600.0, "N", 0.5),
        (5, 600.0, "R", 3.0), (6, 900.0, "R", 2.0), (7, 700.0, "A", 9.0)]

# row_id: rank, tp, tn, fn, fp, wtp, wtn, wfn, wfp, ar, war, recall, wrecall, prec, wprec, fpr, wfpr
EXPECTED = {
    1: (1, 3, 0, 0, 3, 6500, 0, 0, 3500, 1, 1, 1, 1, 0.5, 0.65, 1, 1),
    2: (2, 3, 1, 0, 2, 6500, 1000, 0, 2500, 0.8333, 0.9, 1, 1, 0.6, 0.7222, 0.6667, 0.7143),
    3: (3, 3, 2, 0, 1, 6500, 3000, 0, 500, 0.6667, 0.7, 1, 1, 0.75, 0.9286, 0.3333, 0.1429),
    4: (4, 2, 2, 1, 1, 5000, 3000, 1500, 500, 0.5, 0.55, 0.6667, 0.7692, 0.6667, 0.9091, 0.3333, 0.1429),
    5: (5, 2, 3, 1, 0, 5000, 3500, 1500, 0, 0.3333, 0.5, 0.6667, 0.7692, 1, 1, 0, 0),
    6: (6, 1, 3, 2, 0, 2000, 3500, 4500, 0, 0.1667, 0.2, 0.3333, 0.3077, 1, 1, 0, 0),
}
COLS = ("current_record", "tp", "tn", "fn", "fp", "weight_tp", "weight_tn", "weight_fn", "weight_fp",
        "action_rate", "weight_action_rate", "recall", "weight_recall", "precision",
        "weight_precision", "fpr", "weight_fpr")

SPEC = EvalSpec(target="tag", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",),
                scorers=(ExprScorer("score"),), weight_col="weight", buckets=4)


@pytest.fixture(scope="module")
def hand(spark):
    return spark.createDataFrame(ROWS, "row_id INT, score DOUBLE, tag STRING, weight DOUBLE")


def test_counters(hand):
    c = run_counters(score(hand, SPEC)).collect()[0].asDict()
    assert c == {"records": 7, "pos": 3, "neg": 3, "weighted_pos": 6500.0, "weighted_neg": 3500.0}


@pytest.mark.parametrize("method,parts", [("window", None), ("range", 1), ("range", 3), ("range", 8)])
def test_perf_rows(hand, method, parts):
    spec = SPEC.with_(prefix_method=method, prefix_partitions=parts)
    perf = perf_view(performance(score(hand, spec), spec), ["row_id"])
    got = {r["row_id"]: r for r in perf.collect()}
    assert set(got) == set(EXPECTED)
    assert {r["series"] for r in got.values()} == {"model0"}
    for rid, exp in EXPECTED.items():
        for col, e in zip(COLS, exp):
            assert got[rid][col] == pytest.approx(e, abs=5e-5), (rid, col)


def _keys(points, curve):
    rows = points.filter(F.col("curve") == curve).orderBy("seq").collect()
    return [r["row_id"] for r in rows]


@pytest.mark.parametrize("method", ["window", "range"])
def test_curve_points(hand, method):
    spec = SPEC.with_(prefix_method=method, prefix_partitions=3)
    perf = performance(score(hand, spec), spec)
    points = C.all_points(perf, spec.buckets, ["row_id"]).cache()
    assert _keys(points, "weight_gain") == [6, 5, 2, 1]
    assert _keys(points, "gain") == [6, 5, 4, 2, 1]
    assert _keys(points, "weight_recall") == [6, 5, 3]
    assert _keys(points, "recall") == [6, 5, 3]
    assert _keys(points, "weight_roc") == [6, 2, 1]
    assert _keys(points, "roc") == [6, 4, 2, 1]
    assert _keys(points, "score") == [1, 2, 4, 6, 6]


def test_evaluate_outputs(hand, spark):
    from modeleval.session import scratch_path
    target = scratch_path(spark, "eval-out")
    out = evaluate(hand, SPEC, output=target)
    assert out["counters"].collect()[0].asDict() == {
        "records": 7, "pos": 3, "neg": 3, "weighted_pos": 6500.0, "weighted_neg": 3500.0}
    assert spark.read.parquet(f"{target}/perf").count() == 6
    csv = spark.read.option("header", True).csv(f"{target}/curves")
    assert csv.filter("curve = 'gain'").count() == 5
    assert out["scores"].count() == 6
    assert out["perf"].count() == 6
    g = out["gain_panels"].filter("panel = 0").orderBy("seq").collect()
    assert [round(r["y"], 2) for r in g] == [30.77, 76.92, 100.0, 100.0]
    assert [r["score"] for r in g] == [900.0, 600.0, 250.4, 100.0]
    hist = {r["score_bin"]: r["records"] for r in out["score_histogram"].collect()}
    assert hist == {100: 1, 250: 2, 600: 2, 900: 1}
    pr = out["pr_roc_panels"]
    assert pr.filter("panel = 7").count() == 4
    assert pr.filter("tip4 IS NULL").count() == 0


def test_invariants(hand):
    perf = perf_view(performance(score(hand, SPEC), SPEC), ["row_id"]).collect()
    for r in perf:
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == 6
        assert r["weight_tp"] + r["weight_fp"] + r["weight_tn"] + r["weight_fn"] == 10000
    rows = sorted(perf, key=lambda r: (r["score"], r["row_id"]))
    assert rows[0]["recall"] == rows[0]["fpr"] == rows[0]["action_rate"] == 1.0
    for a, b in zip(rows, rows[1:]):
        assert b["recall"] <= a["recall"] and b["fpr"] <= a["fpr"] and b["action_rate"] <= a["action_rate"]
    assert not any(math.isnan(r["precision"]) for r in perf)
