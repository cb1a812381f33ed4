"""Exact sums in limbs, total order, row errors, headers by place, one Python step, one pass, owned scratch."""

import os
import random
import uuid

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modeleval.functions import wide
from modeleval.operators import curves as C
from modeleval.operators.performance import RATE_COLS, performance, performance_from_long
from modeleval.operators.prefix import place_of, prefix_sums
from modeleval.operators.purify import purify, purify_lines
from modeleval.operators.scoring import ExprScorer, PandasScorer, score_models
from modeleval.plans.evaluate import evaluate, score
from modeleval.session import release, scratch_owner, scratch_path
from modeleval.sources.text import scan_text, skip_header, split_fields
from modeleval.spec import EvalSpec

SPEC = EvalSpec(target="t", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",), scorers=("s",), weight_col="w",
                weight_scale=1, buckets=7)
SOME = st.integers(0, 2**120) | st.integers(0, 2**64) | st.integers(2**52, 2**54) | st.sampled_from(
    [2**k + d for k in (53, 54, 61, 62, 63, 64, 70, 100, 115, 116) for d in (-1, 0, 1)] + [(2**54 + 1) << k | 1 for k in (8, 9, 20, 60)])


def value(pair):
    return [(int(h) << wide.BITS) + int(low) for h, low in zip(*pair)]


# ------------------------------------------------------------------ limbs
@settings(max_examples=300, deadline=None)
@given(st.lists(SOME, min_size=1, max_size=20))
def test_doubles_are_the_nearest(values):
    assert wide.to_double(wide.wide(values)).tolist() == [float(v) for v in values]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(SOME, SOME), min_size=1, max_size=10))
def test_sums_and_differences(pairs):
    a, b = [max(p) for p in pairs], [min(p) for p in pairs]
    assert value(wide.add(wide.wide(a), wide.wide(b))) == [x + y for x, y in zip(a, b)]
    assert value(wide.subtract(wide.wide(a), wide.wide(b))) == [x - y for x, y in zip(a, b)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1) | st.integers(0, 1000), min_size=1, max_size=60))
def test_running_sums(values):
    assert value(wide.running(np.array(values, np.int64))) == [sum(values[:i]) for i in range(len(values))]


def test_limbs_of_columns(spark):
    values = [0, 1, 2**62 - 1, 2**62, 2**63, 10**25 + 7, 10**36]
    df = spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast("decimal(38,0)").alias("v"))
    high, low = wide.limbs(F.col("v"))
    rows = df.select("v", high.alias("h"), low.alias("l")).select("*", wide.joined(F.col("h"), F.col("l")).alias("back")).collect()
    assert [(r.h << wide.BITS) + r.l for r in rows] == values == [int(r.back) for r in rows]


# ------------------------------------------------------------------ running sums and rates
def plain_perf(rows):
    """(key, tag, weight) in order -> rates and counts with Python integers."""
    n, p = len(rows), sum(t for _, t, _ in rows)
    w, wp = sum(x for *_, x in rows), sum(x * t for _, t, x in rows)
    cr = ct = cw = cwt = 0
    out = {}

    def ratio(a, b, empty=float("nan")):
        return float(a) / float(b) if b else empty

    for key, t, x in rows:
        out[key] = (p - ct, cr - ct, ct, n - p - cr + ct, float(wp - cwt), float(cw - cwt), float(cwt), float(w - wp - cw + cwt),
                    ratio(n - cr, n), ratio(w - cw, w), ratio(p - ct, p), ratio(wp - cwt, wp), ratio(p - ct, n - cr, 1.0), ratio(wp - cwt, w - cw, 1.0),
                    ratio(n - p - cr + ct, n - p), ratio(w - wp - cw + cwt, w - wp))
        cr, ct, cw, cwt = cr + 1, ct + t, cw + x, cwt + x * t
    return out


@pytest.mark.parametrize("scale", [1, 2**40, 2**55])
@pytest.mark.parametrize("method, broadcast", [("range", 1_000_000), ("range", 0), ("window", 1_000_000)])
def test_rates_are_exact_at_any_weight(spark, scale, method, broadcast):
    rng = random.Random(scale)
    rows = [(i, i % 3 % 2, rng.randrange(200) * scale + rng.randrange(3)) for i in range(90)]
    long = spark.createDataFrame([("model0", float(i // 4), i, t, w, w * t) for i, t, w in rows],
                                 "series string, score double, row_id int, tag int, weight long, weight_tag long").repartition(3)
    spec = SPEC.with_(prefix_partitions=5, max_broadcast_rows=broadcast)
    perf = performance_from_long(long, spec, method=method)
    names = ("tp", "tn", "fn", "fp", "weight_tp", "weight_tn", "weight_fn", "weight_fp", *RATE_COLS)
    found = {r.row_id: tuple(r[c] for c in names) for r in perf.collect()}
    assert repr(found) == repr({k: plain_perf(rows)[k] for k in found}) and len(found) == 90
    # The thinning and every curve agree with the same rows under another bucket count's path.
    for buckets in (7, 5):
        own = performance_from_long(long, spec.with_(buckets=buckets), method=method)
        for metric in ("weight_recall", "precision"):
            a = C.point_thin(own, metric, buckets, ["row_id"]).orderBy("seq").collect()
            assert a == C.point_thin(perf, metric, buckets, ["row_id"]).orderBy("seq").collect()
        assert sorted(C.thin_perf(own, buckets, ["row_id"]).collect()) == sorted(C.thin_perf(perf, buckets, ["row_id"]).collect())


def test_repeated_keys_have_a_total_order(spark):
    rng = random.Random(9)
    rows = [("m", float(rng.randrange(4)), rng.randrange(3), rng.randrange(2), rng.randrange(3)) for _ in range(200)]
    rows = [(s, x, k, t, w, w * t) for s, x, k, t, w in rows]
    schema = "series string, score double, row_id int, tag int, weight long, weight_tag long"
    want, cum, cumt = [], 0, 0
    for s, x, k, t, w, wt in sorted(rows):
        want.append((x, k, t, w, cum, cumt))
        cum, cumt = cum + w, cumt + wt
    for seed, parts in ((1, 3), (2, 7)):
        random.Random(seed).shuffle(rows)
        for method in ("range", "window"):
            sums = prefix_sums(spark.createDataFrame(rows, schema).repartition(4), ["row_id"], method=method, partitions=parts, series_names=["m"])
            found = sums.orderBy("cum_records").collect()
            assert [(r.score, r.row_id, r.tag, r.weight, int(r.cum_weight), int(r.cum_weight_tag)) for r in found] == want


def test_places_rise_with_series_and_score(spark):
    scores = [None, float("-inf"), -1e300, -8.4e6, -1.0, -1e-9, -0.0, 0.0, 1e-7, 2e-6, 999.5, 8.4e6, 1e18, float("inf"), float("nan")]
    df = spark.createDataFrame([(s, x, i) for s in (0, 1, 5) for i, x in enumerate(scores)], "series int, score double, i int")
    places = [r[0] for r in df.orderBy("series", "score", "i").select(place_of(F.col("series"), F.col("score"))).collect()]
    assert places == sorted(places) and len(set(places)) == 3 * 8


# ------------------------------------------------------------------ filter errors
def test_every_row_error_drops_the_row(spark):
    df = spark.createDataFrame([("9223372036854775807", "1"), ("1", "0"), ("x", "2"), ("5", "5"), (None, "1"), ("8", "3")], "a string, b string")
    cases = {"cast(a as bigint) + 1 < 0": [], "int(a) + 2147483647 < 0": [], "int(a) % int(b) = 0": ["5"], "bigint(a) / int(b) > 1": ["8", "9223372036854775807"],
             "int(a) > 1 AND int(a) < 9": ["5", "8"], "a = 'x' OR int(a) = 5": ["5", "x"], "a > string(1 / 0)": [], "element_at(array(1, 2), int(a)) = 1": ["1"]}
    before = dict(spark.sparkContext.getConf().getAll()) | {"ansi": spark.conf.get("spark.sql.ansi.enabled")}
    for whole in ("true", "false"):
        spark.conf.set("spark.sql.codegen.wholeStage", whole)
        try:
            for condition, want in cases.items():
                assert sorted(r.a for r in purify(df, condition, on_row_error="drop").collect()) == want, condition
        finally:
            spark.conf.unset("spark.sql.codegen.wholeStage")
    assert before == dict(spark.sparkContext.getConf().getAll()) | {"ansi": spark.conf.get("spark.sql.ansi.enabled")}
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        purify(df.filter("b = '1'"), "cast(a as bigint) + 1 < 0").collect()


def test_errors_before_the_filter_still_end_the_job(spark):
    lines = spark.createDataFrame([("1|2",), ("3",)], "value string").repartition(2)
    with pytest.raises(Exception, match="fewer than 2 fields"):
        purify(split_fields(lines, ["a", "b"], "|"), "int(a) > 0", on_row_error="drop").collect()
    kept = purify_lines(lines, ["a", "b"], "|", "int(a) > 0 AND b IS NULL", has_header=False, on_short_row="null", on_row_error="drop")
    assert [r.value for r in kept.collect()] == ["3"]


# ------------------------------------------------------------------ headers
def test_only_the_first_line_of_each_file_goes(spark, tmp_path):
    want = []
    for i in range(6):
        head = ["a|b", "other|names", "", "a|b", "1|2", "a|b"][i]
        body = [f"{i}|{k}" for k in range(400 if i < 3 else 2)] + ["a|b", head] * (i != 5)
        (tmp_path / f"f{i}.txt").write_text("\n".join([head, *body]) + "\n")
        want += body
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "only.txt").write_text("a|b\n")
    for size in ("128m", "1000", "300"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            lines = scan_text(spark, str(tmp_path))
            assert sorted(r.value for r in skip_header(lines).collect()) == sorted(want)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    with pytest.raises(ValueError, match="scan of text files"):
        skip_header(spark.createDataFrame([("a",)], "value string"))


# ------------------------------------------------------------------ scorers
def test_all_python_models_are_one_step_and_load_once(spark, tmp_path):
    def load():
        (tmp_path / f"loaded-{uuid.uuid4().hex}").touch()
        return 2.0

    ours = [PandasScorer(("x",), lambda m, f: f["x"] * m, load), PandasScorer(("y", "x"), lambda m, f: f["y"] - f["x"] + m, load),
            PandasScorer(("y",), lambda m, f: pd.Series([float(len(f))] * len(f)), load)]
    df = spark.range(50, numPartitions=1).select(F.col("id").alias("x"), (F.col("id") * 3).alias("y"), F.lit("keep").alias("_python"))
    out = score_models(df, [*ours, ExprScorer("x + y")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    rows = sorted(out.collect(), key=lambda r: r.x)
    assert [(r.model0, r.model1, r.model2, r.model3) for r in rows] == [(2.0 * i, 2.0 * i + 2, 50.0, 4.0 * i) for i in range(50)]
    assert rows[0]["_python"] == "keep" and len(os.listdir(tmp_path)) == 3


def test_python_models_see_only_the_rows_that_count(spark):
    def picky(model, frame):
        assert (frame["s"] < 100).all()
        return frame["s"] + 1

    df = spark.createDataFrame([(i, float(i if i % 3 else 500), "RNA"[i % 3 and 1 + i % 2], 1) for i in range(30)], "row_id int, s double, t string, w long")
    df = df.withColumn("t", F.when(F.col("s") == 500, "A").otherwise(F.col("t")))
    out = evaluate(df, SPEC.with_(scorers=(PandasScorer(("s",), picky), "100 / (500 - s)")), reports=False)
    assert sorted(r.model0 for r in out["scores"].collect()) == [i + 1.0 for i in range(30) if i % 3 and i % 2 == 0]


# ------------------------------------------------------------------ one pass, owned scratch
def test_counters_come_from_the_written_scores(spark):
    source = scratch_path(spark, "input")
    rows = [(i, float(i), "RNA"[i % 3], i) for i in range(60)]
    spark.createDataFrame(rows, "row_id int, s double, t string, w long").write.parquet(source)
    with evaluate(spark.read.parquet(source), SPEC) as out:
        for name, df in out.items():
            assert source not in " ".join(df.inputFiles()), name
        counters = out["counters"].first()
        assert counters.asDict() == {"records": 60, "pos": 20, "neg": 20, "weighted_pos": float(sum(range(0, 60, 3))), "weighted_neg": float(sum(range(1, 60, 3)))}
        plan = out["scores"]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(labelled" in plan and source not in plan
        assert out["scores"].count() == 40 and "labelled" not in out["scores"].columns


def test_evaluations_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, 1.0, "A", 5), (2, 2.0, None, 5)], "row_id int, s double, t string, w long")
    for rows, n in ((df, 2), (df.limit(0), 0)):
        with evaluate(rows, SPEC) as out:
            assert out["counters"].first().asDict() == {"records": n, "pos": 0, "neg": 0, "weighted_pos": 0.0, "weighted_neg": 0.0}
            assert all(out[k].count() == 0 for k in ("scores", "perf", "points", "gain_panels", "score_histogram"))


def test_a_closed_run_leaves_no_scratch(spark):
    df = spark.createDataFrame([(i, float(i), "RN"[i % 2], 1) for i in range(20)], "row_id int, s double, t string, w long")
    target = scratch_path(spark, "kept-output")
    with scratch_owner() as outer:
        with evaluate(df, SPEC, output=target) as out:
            paths = list(out.paths)
            assert paths and all(os.path.isdir(p) for p in paths)
            assert out["perf"].count() == 20
        assert not any(os.path.exists(p) for p in paths) and outer == paths
    assert spark.read.parquet(f"{target}/perf").count() == 20
    assert spark.read.parquet(f"{target}/scores").filter("labelled = 1").count() == 20
    out.close()
    with pytest.raises(ValueError, match="not a scratch path"):
        release(spark, ["/tmp/elsewhere"])
