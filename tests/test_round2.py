"""Exact weights, repeated keys, name clashes, row errors, sizes, sessions."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from modeleval import session as S
from modeleval.operators import curves as C
from modeleval.operators.labels import score_rows
from modeleval.operators.performance import performance, performance_from_long
from modeleval.operators.prefix import partitions_for, plan_bytes, prefix_sums
from modeleval.operators.purify import purify, purify_lines, simple_names
from modeleval.operators.scoring import PandasScorer, score_models
from modeleval.operators.series import series_unpivot
from modeleval.plans.evaluate import evaluate, evaluate_text, score
from modeleval.spec import EvalSpec
from tests.reference_model import fold_points, fold_score_points, perf_rows

SPEC = EvalSpec(target="t", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",), scorers=("s",), weight_col="w",
                weight_scale=1, buckets=7)


def long_of(spark, weights, tags=None, scores=None):
    n = len(weights)
    rows = [("m", float(scores[i] if scores else i), i, tags[i] if tags else i % 2, weights[i], weights[i] * (tags[i] if tags else i % 2)) for i in range(n)]
    return spark.createDataFrame(rows, "series string, score double, row_id int, tag int, weight long, weight_tag long")


# ------------------------------------------------------------------ exact weights
@pytest.mark.parametrize("method", ["range", "window"])
@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_running_weights_are_exact_above_two_to_the_63(spark, method, broadcast):
    weights = [4 * 10**18] * 10 + [1]
    tags = [0] * 10 + [1]
    out = prefix_sums(long_of(spark, weights, tags), ["row_id"], method=method, partitions=9, series_count=1,
                      max_broadcast_rows=broadcast).orderBy("score").collect()
    total = 0
    for r, w in zip(out, weights):
        assert int(r.cum_weight) == total and int(r.total_weight) == sum(weights)
        total += w


def test_rates_of_the_last_row_above_two_to_the_53(spark):
    rows = [(i, float(i), "N", 9 * 10**16) for i in range(20)] + [(20, 20.0, "R", 1)]
    df = spark.createDataFrame(rows, "row_id int, s double, t string, w long")
    spec = SPEC.with_(scorers=("s",))
    long = df.select(F.lit("model0").alias("series"), F.col("s").alias("score"), "row_id", (F.col("t") == "R").cast("int").alias("tag"),
                     F.col("w").alias("weight"), F.when(F.col("t") == "R", F.col("w")).otherwise(F.lit(0)).cast("bigint").alias("weight_tag"))
    for method in ("range", "window"):
        top = performance_from_long(long, spec, series_count=1, method=method).orderBy(F.desc("score")).first()
        assert (top.weight_tp, top.weight_precision, top.weight_fn) == (1.0, 1.0, 0.0)


@pytest.mark.parametrize("method", ["range", "window"])
def test_one_partition_holds_any_weight(spark, method):
    weights = [9 * 10**18] * 40 + [1, 2**63 - 1]
    out = prefix_sums(long_of(spark, weights), ["row_id"], method=method, partitions=1, series_count=1).orderBy("score").collect()
    for i, r in enumerate(out):
        assert int(r.cum_weight) == sum(weights[:i]) and int(r.total_weight) == sum(weights)
        assert int(r.cum_weight_tag) == sum(weights[1:i:2])


def test_negative_weights_raise(spark):
    df = spark.createDataFrame([(1, 1.0, "R", -2.0)], "row_id int, s double, t string, w double")
    with pytest.raises(Exception, match="negative"):
        score_rows(df, SPEC).collect()


# ------------------------------------------------------------------ thinning, curves
def test_thinning_with_repeated_keys_and_any_partitions(spark):
    rng = random.Random(3)
    rows = [(i % 30, float(rng.randrange(25)) * 40, rng.choice("RN"), rng.randrange(1, 50)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id int, s double, t string, w long").repartition(5)
    perf = performance(score(df, SPEC), SPEC.with_(prefix_partitions=6))
    thin = C.thin_perf(perf, 7, ["row_id"], thin=True)
    by_rank = perf.orderBy("current_record").collect()

    def bucket(x):
        return 0 if x != x else int(x * 7)

    rates = ("action_rate", "weight_action_rate", "recall", "weight_recall", "precision", "weight_precision", "fpr", "weight_fpr")
    want = [r.current_record for r, up in zip(by_rank, [*by_rank[1:], None])
            if up is None or int(r.score) != int(up.score) or any(bucket(r[m]) != bucket(up[m]) for m in rates)]
    assert sorted(r.current_record for r in thin.collect()) == want
    assert len(want) > thin.select("row_id").distinct().count()


def test_numbering_over_partitions(spark):
    rng = random.Random(5)
    rows = [(i, rng.random() * 60, rng.choice("RN"), rng.randrange(1, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id int, s double, t string, w long")
    exp = perf_rows([(i, s, t, float(w)) for i, s, t, w in rows], ("R",), ("N",), 1)
    for parts in (1, 7):
        points = C.all_points(performance(score(df, SPEC), SPEC.with_(prefix_partitions=parts)), 7, ["row_id"]).orderBy("curve", "seq").collect()
        gain = [(r.seq, r.row_id) for r in points if r.curve == "gain"]
        assert gain == list(enumerate(fold_points(exp, "action_rate", 7), 1))
        ours = [(r.seq, r.row_id) for r in points if r.curve == "score"]
        assert ours == list(enumerate(fold_score_points(exp), 1))


def test_all_points_are_one_scan(spark):
    df = spark.createDataFrame([(i, float(i), "RN"[i % 2], 1) for i in range(30)], "row_id int, s double, t string, w long")
    perf = performance(score(df, SPEC), SPEC)
    plan = C.thin_perf(perf, 7, ["row_id"], thin=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


# ------------------------------------------------------------------ names
def test_scorers_read_the_input_only(spark):
    df = spark.createDataFrame([(1, 5.0, 2.0)], "row_id int, model0 double, s double")
    ours = PandasScorer(inputs=("model0",), predict=lambda m, f: f["model0"] * 100)
    r = score_models(df, ("s * 10", "model0", ours)).first()
    assert (r.model0, r.model1, r.model2, r.score_max) == (20.0, 5.0, 500.0, 500.0)


def test_label_columns_read_the_input_only(spark):
    df = spark.createDataFrame([(1, "R", 3.0, "N", 7.0)], "row_id int, tag string, weight double, is_pos string, model0 double")
    r = score_rows(df, SPEC.with_(target="tag", weight_col="weight", scorers=("model0 + weight",), meta_cols=("is_pos",), score_meta_cols=("model0",))).first()
    assert (r.tag, r.weight, r.weight_tag, r.is_pos, r.model0, r.meta_model0, r.meta_is_pos) == ("R", 3, 3, True, 10.0, 7.0, None)
    with pytest.raises(ValueError, match="row key"):
        score_rows(df, SPEC.with_(target="tag", weight_col="weight", row_key=("model0",), scorers=("weight",)))


def test_tags_are_trimmed_of_all_white_space(spark):
    df = spark.createDataFrame([(1, 1.0, "R\t", 1), (2, 2.0, " \nN\r", 1)], "row_id int, s double, t string, w long")
    assert [r.tag for r in score_rows(df, SPEC).orderBy("row_id").collect()] == ["R", "N"]


def test_a_saved_table_keeps_only_labelled_rows_in_reports(spark):
    df = spark.createDataFrame([(1, "R"), (2, "N"), (3, "A"), (4, None)], "row_id int, tag string").selectExpr(
        "*", "1.0D AS model0", "1L AS weight", "1L AS weight_tag")
    out = series_unpivot(df, SPEC).collect()
    assert sorted((r.row_id, r.tag) for r in out) == [(1, 1), (2, 0)]


# ------------------------------------------------------------------ filters, text
def test_rows_on_which_the_filter_fails(spark):
    df = spark.createDataFrame([("1",), ("x",), ("9",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        purify(df, "a > 2").collect()
    assert [r.a for r in purify(df, "a > 2", on_row_error="drop").collect()] == ["9"]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_an_unparsable_filter_still_drops_headers(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a|b\n1|2\nshort\n")
    lines = spark.read.text(str(tmp_path))
    assert [r.value for r in purify_lines(lines, ["a", "b"], "|", ">>> (", on_invalid="keep").collect()] == ["1|2", "short"]


def test_columns_with_a_name_space(spark):
    assert simple_names(["x::a", "y::b", "b", "z::c", "w::c"]) == {"a": "x::a"}
    df = spark.createDataFrame([(1, 2), (5, 6)], "`x::a` int, b int")
    out = purify(df, "a > 2 AND `x::a` < 9")
    assert out.columns == df.columns and [r.b for r in out.collect()] == [6]


def test_from_text_to_reports(spark, tmp_path):
    for i, lines in enumerate((["id|t|s", "1|R|10", "2|N|x", "3|N"], ["id|t|s", "4|N|5", "5|R|99", "6|A|50"])):
        (tmp_path / f"f{i}.txt").write_text("\n".join(lines) + "\n")
    spec = EvalSpec(target="t", pos_tags=("R",), neg_tags=("N",), row_key=("id",), scorers=("double(s)",), condition="double(s) > 0",
                    on_row_error="drop", on_short_row="drop", buckets=4)
    out = evaluate_text(spark, str(tmp_path), "|", spec)
    assert out["counters"].first().records == 4
    assert [(r.id, r.current_record) for r in out["perf"].orderBy("score").collect()] == [("4", 1), ("1", 2), ("5", 3)]
    with pytest.raises(Exception, match="fewer than"):
        evaluate_text(spark, str(tmp_path), "|", spec.with_(on_short_row="error"))["scores"].collect()


def test_reports_exist_for_one_mode_only(spark):
    df = spark.createDataFrame([(1, 1.0, "R", 1), (2, 2.0, "N", 1)], "row_id int, s double, t string, w long")
    assert "perf" in evaluate(df, SPEC) and set(evaluate(df, SPEC.with_(multiclass=True))) == {"scores", "counters"}


# ------------------------------------------------------------------ sizes, sessions
def test_partitions_follow_the_written_size(spark, tmp_path):
    assert partitions_for(1, 5, 8) == 8 and partitions_for(100 << 40, 5, 200) > 10**6
    sizes = []
    for n in (10, 10_000):
        spark.range(n).selectExpr("id", "cast(rand() as string) x").write.parquet(str(tmp_path / str(n)))
        sizes.append(plan_bytes(spark.read.parquet(str(tmp_path / str(n)))))
    assert sizes[1] > 20 * sizes[0]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Session())


def test_tasks_need_no_installed_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\nfrom modeleval.session import local_session\nimport __spark_entry__ as e\n"
            "s = local_session(cores='2', shuffle_partitions=2, memory='2g')\nprint('rows', e.entry(s).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows 2139" in out.stdout, out.stderr[-2000:]
