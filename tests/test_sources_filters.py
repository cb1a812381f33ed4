"""Text input, header rules, short rows, the row filter and the scorers."""

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from modeleval.operators.purify import purify, purify_lines
from modeleval.operators.scoring import LogitScorer, PandasScorer, score_models, score_multiclass
from modeleval.session import scratch_path
from modeleval.sources.text import check_headers, scan_text, skip_header, split_fields
from modeleval.spec import EvalSpec

HEAD = ("a", "b", "c", "d")


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def file_lines(spark, values):
    """The lines as one text file, scanned."""
    path = scratch_path(spark, "lines")
    lines(spark, values).coalesce(1).write.text(path)
    return scan_text(spark, path)


def test_split_keeps_empty_tokens(spark):
    out = split_fields(lines(spark, ["x||z|", "1|2|3|4|extra"]), HEAD, "|").collect()
    assert tuple(out[0]) == ("x", "", "z", "")
    assert tuple(out[1]) == ("1", "2", "3", "4")


def test_regex_chars_in_delimiter(spark):
    out = split_fields(lines(spark, ["1.*2.*3.*4"]), HEAD, ".*").collect()
    assert tuple(out[0]) == ("1", "2", "3", "4")


def test_short_row_policies(spark):
    df = lines(spark, ["1|2|3|4", "1|2"])
    assert split_fields(df, HEAD, "|", on_short_row="drop").count() == 1
    rows = split_fields(df, HEAD, "|", on_short_row="null").collect()
    assert ("1", "2", None, None) in [tuple(r) for r in rows]
    with pytest.raises(Exception, match="fewer than 4 fields"):
        split_fields(df, HEAD, "|", on_short_row="error").collect()


def test_headers(spark):
    with pytest.raises(ValueError):
        check_headers(["a", " ", "c"])
    with pytest.raises(ValueError):
        check_headers(["a", "b", "a"])
    df = file_lines(spark, ["x|b|c|d", "1|2|3|4", "x|b|c|d", "a|b|c|d", "5|6|7|8"])
    assert sorted(r.value for r in skip_header(df).collect()) == ["1|2|3|4", "5|6|7|8", "a|b|c|d", "x|b|c|d"]


def test_purify_rules(spark):
    df = split_fields(lines(spark, ["1|x|3|4", "7|y|9|q", "2|z||4"]), HEAD, "|")
    assert purify(df, None).count() == 3
    assert purify(df, "   ").count() == 3
    assert purify(df, "try_cast(c AS INT) > 2").count() == 2      # '' -> NULL -> dropped
    assert purify(df, "a = '1' OR try_cast(d AS INT) = 4").count() == 2
    assert purify(df, "a >>> (", on_invalid="keep").count() == 3
    with pytest.raises(ParseException):
        purify(df, "a >>> (")
    with pytest.raises(AnalysisException):
        purify(df, "nope = 1")
    with pytest.raises(ValueError):
        purify(df, "a")


def test_purify_lines_drops_headers_only_with_condition(spark):
    df = file_lines(spark, ["a|b|c|d", "1|2|3|4", "5|6|7|8"])
    assert purify_lines(df, HEAD, "|", None).count() == 3
    kept = [r[0] for r in purify_lines(df, HEAD, "|", "a <> '5'").collect()]
    assert kept == ["1|2|3|4"]


def test_logit_and_pandas_scorers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, -1.0)], "x DOUBLE, y DOUBLE")
    lr = LogitScorer(weights=(0.5, -0.25), intercept=0.1, features=("x", "y"), scale=1000.0)
    pd_scorer = PandasScorer(inputs=("x", "y"), predict=lambda m, f: f["x"] * 3 + f["y"],
                             load=lambda: "loaded-once")
    out = score_models(df, (lr, pd_scorer), with_stats=True).orderBy("x").collect()
    import math
    z = 0.1 + 0.0 * 0.5 + (-1.0) * -0.25
    assert out[0]["model0"] == pytest.approx(1000 / (1 + math.exp(-z)))
    assert out[0]["model1"] == -1.0 and out[1]["model1"] == 5.0


def test_spark_ml_scorer(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml import Pipeline
    from modeleval.operators.scoring import SparkMLScorer
    train = spark.createDataFrame([(float(i), 1.0 if i > 5 else 0.0) for i in range(12)], "x DOUBLE, label DOUBLE")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=20)]).fit(train)
    out = score_models(train, (SparkMLScorer(model),), with_stats=False)
    assert out.columns == ["x", "label", "model0"]
    vals = [r["model0"] for r in out.orderBy("x").collect()]
    assert vals[0] < 500 < vals[-1]


def test_multiclass_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, "F", 10.0, "p1"), (2, " X ", 20.0, None)],
                               "k INT, t STRING, v DOUBLE, m STRING")
    spec = EvalSpec(target="t", pos_tags=("F",), neg_tags=(), row_key=("k",),
                    scorers=("v", "v * 2"), meta_cols=("m",), multiclass=True)
    rows = {r["k"]: r for r in score_multiclass(df, spec).collect()}
    assert rows[2]["tag"] == "X" and rows[2]["scores"] == [20.0, 40.0]
    assert rows[1]["meta_m"] == "p1"


def test_ml_fit_after_evaluate(spark):
    """An evaluation must not leave the session unable to run pyspark.ml jobs."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from modeleval.plans.evaluate import evaluate
    df = spark.createDataFrame([(i, float(i), "R" if i % 2 else "N", 1.0) for i in range(8)],
                               "row_id INT, score DOUBLE, tag STRING, weight DOUBLE")
    spec = EvalSpec(target="tag", pos_tags=("R",), neg_tags=("N",), row_key=("row_id",),
                    scorers=("score",), weight_col="weight")
    assert evaluate(df, spec)["counters"].collect()[0]["records"] == 8
    train = VectorAssembler(inputCols=["score"], outputCol="features").transform(
        df.withColumn("label", (F.col("tag") == "R").cast("double")))
    LogisticRegression(maxIter=5).fit(train)


def test_rate_format(spark):
    from modeleval.functions.stats import format_rate
    df = spark.createDataFrame([(0.5,), (0.0,), (1.0,), (1 / 3,), (float("nan"),), (0.123456785,), (100.25,)], "x DOUBLE")
    got = [r[0] for r in df.select(format_rate(F.col("x"))).collect()]
    assert got[:5] == ["0.5", "0", "1", "0.33333333", "NaN"]
    assert got[6] == "100.25"
    assert len(got[5].split(".")[1]) <= 8


def test_read_delimited_and_header_of(spark):
    from modeleval.session import scratch_path
    from modeleval.sources.text import header_of, read_delimited
    path = scratch_path(spark, "text-test")
    lines(spark, ["a|b|c|d", "1|2||4", "5|6|7|8"]).coalesce(1).write.text(path)
    assert header_of(spark, path, "|") == ["a", "b", "c", "d"]
    rows = sorted(tuple(r) for r in read_delimited(spark, path, HEAD, "|", has_header=True).collect())
    assert rows == [("1", "2", "", "4"), ("5", "6", "7", "8")]
