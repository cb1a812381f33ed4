"""Random sets with heavy ties: Spark perf rows and curve points against the
plain-Python rules, for both prefix plans and several partition counts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from modeleval.operators import curves as C
from modeleval.operators.performance import performance, perf_view
from modeleval.operators.scoring import ExprScorer
from modeleval.plans.evaluate import score
from modeleval.spec import EvalSpec
from tests.reference_model import fold_points, fold_score_points, perf_rows

METRICS = {"weight_gain": "weight_action_rate", "gain": "action_rate", "weight_recall": "weight_recall",
           "recall": "recall", "weight_roc": "weight_fpr", "roc": "fpr"}


def _data(seed, n=300):
    rnd = random.Random(seed)
    hot = rnd.choice([10.0, 500.0])
    rows = []
    for i in range(n):
        # a third of the rows share one score
        s = hot if rnd.random() < 0.34 else round(rnd.uniform(-5, 1200), rnd.choice([0, 1, 3]))
        tag = rnd.choice(["R", "N", "N", "A", " R ", None])
        w = rnd.choice([None, 0.0, round(rnd.uniform(0, 50), 2)]) if seed % 2 else round(rnd.uniform(0, 9), 3)
        rows.append((i, s, tag, w if w is not None else 1.0))
    return rows


@pytest.mark.parametrize("seed,method,parts", [(1, "range", 5), (2, "range", 2), (3, "window", None),
                                               (4, "range", 16), (5, "range", 1)])
def test_against_rules(spark, seed, method, parts):
    rows = _data(seed)
    df = spark.createDataFrame(rows, "row_id INT, score DOUBLE, tag STRING, weight DOUBLE")
    buckets = 7
    spec = EvalSpec(target="tag", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",),
                    scorers=(ExprScorer("score"),), weight_col="weight", buckets=buckets,
                    prefix_method=method, prefix_partitions=parts)
    perf = performance(score(df, spec), spec)
    got = {r["row_id"]: r.asDict() for r in perf_view(perf, ["row_id"]).collect()}
    exp = perf_rows([(r[0], r[1], r[2], r[3]) for r in rows], {"R"}, {"N"})
    assert len(got) == len(exp)
    for e in exp:
        g = got[e["key"]]
        for k, v in e.items():
            if k == "key":
                continue
            if isinstance(v, float) and math.isnan(v):
                assert math.isnan(g[k]), (e["key"], k)
            else:
                assert g[k] == v, (e["key"], k, g[k], v)
    points = C.all_points(perf, buckets, ["row_id"]).cache()
    for curve, metric in METRICS.items():
        ours = [r["row_id"] for r in points.filter(F.col("curve") == curve).orderBy("seq").collect()]
        assert ours == fold_points(exp, metric, buckets), curve
    ours = [r["row_id"] for r in points.filter(F.col("curve") == "score").orderBy("seq").collect()]
    assert ours == fold_score_points(exp)


def test_plans_equal_global_window(spark):
    from modeleval.operators.prefix import prefix_sums
    from tests.reference_plans import prefix_global_window
    from modeleval.operators.series import series_unpivot
    rows = _data(11, n=400)
    df = spark.createDataFrame(rows, "row_id INT, score DOUBLE, tag STRING, weight DOUBLE")
    spec = EvalSpec(target="tag", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",),
                    scorers=(ExprScorer("score"), ExprScorer("score * -1")), weight_col="weight")
    long = series_unpivot(score(df, spec), spec).cache()
    cols = ["series", "row_id", "cum_records", "cum_tag", "cum_weight", "cum_weight_tag",
            "prev_score", "next_score", "total_records", "total_pos", "total_weight"]
    ref = sorted(tuple(r) for r in prefix_global_window(long, ["row_id"]).select(*cols).collect())
    names = ["model0", "model1", "avg"]
    for method, parts in [("range", 7), ("window", 7), ("window", 1)]:
        got = prefix_sums(long, ["row_id"], method=method, partitions=parts, series_names=names)
        assert sorted(tuple(r) for r in got.select(*cols).collect()) == ref, (method, parts)
