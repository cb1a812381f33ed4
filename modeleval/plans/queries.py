"""The registered queries: one per operator of the survey's inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
The matching DuckDB SQL lives in ``plans.oracle``; column names agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.functions.tags import binary_tag, meta_numeric, null_to_empty, trim_tag
from modeleval.operators import curves as C
from modeleval.operators.labels import add_labels, labelled_only, run_counters, scored_output
from modeleval.operators.panels import gain_panels, pr_roc_panels, score_histogram
from modeleval.operators.performance import (
    COUNT_COLS, RATE_COLS, WEIGHT_COLS, performance, perf_view,
)
from modeleval.operators.prefix import local_sums_table, merged_partitions, prefix_sums
from modeleval.operators.purify import purifier, purify, purify_lines
from modeleval.operators.scoring import score_models, score_multiclass
from modeleval.operators.series import (
    as_doubles, edge_rows, missing_scores, population_totals, prune_for_series, score_range,
    series_sources, series_unpivot,
)
from modeleval.plans import catalog as K
from modeleval.plans.evaluate import evaluate, evaluate_text, score
from modeleval.session import release, scratch_owner, scratch_path
from modeleval.sources import sinks
from modeleval.sources.text import header_of, read_delimited, scan_text, skip_header, split_fields

Query = Callable[[SparkSession, str], DataFrame]
KEY = list(K.LI_KEY)

# The conditions used by the filter queries.
PURIFY_CONDITION = "try_cast(o_totalprice AS DOUBLE) > 250000 AND o_orderstatus <> 'F'"
ROW_ERROR_CONDITION = "double(o_totalprice) > 250000 AND o_orderstatus <> 'F'"
# Of every 10 orders one value is the largest BIGINT, one is text, and one divisor is zero.
ERROR_VALUE = "CASE o_orderkey % 10 WHEN 3 THEN '9223372036854775807' WHEN 5 THEN 'n/a' ELSE string(o_orderkey) END"
ERROR_DIVISOR = "CASE o_orderkey % 10 WHEN 7 THEN '0' ELSE string(o_orderkey % 3 + 1) END"
ROW_ERRORS_CONDITION = "bigint(value) + 1 > 100 AND bigint(value) % bigint(divisor) < 2"
INVALID_CONDITION = "o_totalprice >>> ("
API_CONDITION = "l_quantity > 25 AND l_linestatus = 'O'"


# ------------------------------------------------------------------ shared steps
def li_scored(spark: SparkSession, sf: str) -> DataFrame:
    return score(K.lineitem(spark, sf), K.LI)


def li_long(spark: SparkSession, sf: str) -> DataFrame:
    return series_unpivot(li_scored(spark, sf), K.LI)


def li_perf(spark: SparkSession, sf: str, method: str | None = None) -> DataFrame:
    """Perf rows of eval set LI."""
    return performance(li_scored(spark, sf), K.LI, method=method)


def li_points(spark: SparkSession, sf: str) -> DataFrame:
    return C.all_points(li_perf(spark, sf), K.LI.buckets, KEY)


def _perf_of(df: DataFrame, spec) -> DataFrame:
    return perf_view(performance(score(df, spec), spec), spec.row_key)


def _sums_view(sums: DataFrame) -> DataFrame:
    return sums.select("series", "score", *KEY, "cum_records", "cum_tag",
                       F.col("cum_weight").cast("double").alias("cum_weight"),
                       F.col("cum_weight_tag").cast("double").alias("cum_weight_tag"))


# ------------------------------------------------------------------ sources and sinks
def q_scan_text(spark, sf):
    return scan_text(spark, K.text_set(spark, sf, "plain"))


def q_split_fields(spark, sf):
    return split_fields(scan_text(spark, K.text_set(spark, sf, "plain")), K.TEXT_HEADERS, K.DELIM)


def q_skip_header(spark, sf):
    return skip_header(scan_text(spark, K.text_set(spark, sf, "header")))


def q_skip_header_by_place(spark, sf):
    """Files whose first line is not the given names, and data lines equal to both: these stay."""
    return skip_header(scan_text(spark, K.text_set(spark, sf, "odd")))


def q_check_headers(spark, sf):
    """The checked header of the files, with the number of rows that fill each column."""
    path = K.text_set(spark, sf, "header")
    names = header_of(spark, path, K.DELIM)
    rows = read_delimited(spark, path, names, K.DELIM, has_header=True)
    filled = rows.agg(*[F.count_if(F.col(n) != "").alias(n) for n in names])
    pairs = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.col(n).alias("filled")) for i, n in enumerate(names)]
    return filled.select(F.inline(F.array(*pairs)))


def q_short_row_policy(spark, sf):
    lines = scan_text(spark, K.text_set(spark, sf, "short"))
    return split_fields(lines, K.TEXT_HEADERS, K.DELIM, on_short_row="null")


def q_null_to_empty(spark, sf):
    parsed = q_short_row_policy(spark, sf)
    return parsed.select("o_orderkey", null_to_empty(F.col("o_orderpriority")).alias("o_orderpriority"))


def q_save_scores(spark, sf):
    path = sinks.save_scores(scored_output(li_scored(spark, sf)), scratch_path(spark, "scores"))
    return spark.read.parquet(path)


def q_save_perf(spark, sf):
    path = scratch_path(spark, "perf")
    with scratch_owner() as paths:
        sinks.save_perf(perf_view(li_perf(spark, sf), KEY), path)
    # The saved rows need the running sums no more.
    release(spark, paths)
    return spark.read.parquet(path)


def q_save_sorted(spark, sf):
    """The sorted dump as it lies in the files: each row's rank, and the rank its place has."""
    ranked = li_perf(spark, sf).select("series", "score", *KEY, "current_record", "_pid")
    path = sinks.save_sorted(ranked, scratch_path(spark, "sorted"), ranges="_pid")
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    first = rows.groupBy("series", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("series").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("series", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row for each file; without the hint the rows would be shuffled by their file's name.
    return rows.join(F.broadcast(first), ["series", "_file"]).select(
        "series", *KEY, "current_record", (F.col("_before") + F.col("_row") + 1).alias("written_rank"))


def q_save_filtered(spark, sf):
    lines = scan_text(spark, K.text_set(spark, sf, "header"))
    kept = purify_lines(lines, K.TEXT_HEADERS, K.DELIM, PURIFY_CONDITION)
    path = sinks.save_filtered(kept, scratch_path(spark, "filtered"))
    return spark.read.text(path)


def q_points_csv(spark, sf):
    points = C.curves(li_perf(spark, sf), K.LI.buckets, KEY)
    path = sinks.points_csv(points, scratch_path(spark, "csv"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in sinks.CSV_HEADER]
                          + [T.StructField("series", T.StringType()),
                             T.StructField("curve", T.StringType())])
    return spark.read.schema(schema).option("header", True).csv(path)


# ------------------------------------------------------------------ filters
def q_purify(spark, sf):
    """A condition that fails on some rows (``n/a`` for a price): these are dropped."""
    lines = scan_text(spark, K.text_set(spark, sf, "bad"))
    return purify_lines(lines, K.TEXT_HEADERS, K.DELIM, ROW_ERROR_CONDITION, on_row_error="drop")


def q_purify_row_errors(spark, sf):
    """A condition that overflows, divides by zero or meets text on some rows: these are dropped."""
    orders = K.table(spark, sf, "orders").select("o_orderkey", F.expr(ERROR_VALUE).alias("value"), F.expr(ERROR_DIVISOR).alias("divisor"))
    return purify(orders, ROW_ERRORS_CONDITION, on_row_error="drop")


def q_purify_invalid(spark, sf):
    """A condition that does not parse: every line passes, but header lines do not."""
    lines = scan_text(spark, K.text_set(spark, sf, "header"))
    return purify_lines(lines, K.TEXT_HEADERS, K.DELIM, INVALID_CONDITION, on_invalid="keep")


def q_purifier_api(spark, sf):
    kept = K.lineitem(spark, sf).transform(purifier(API_CONDITION))
    return kept.select(*KEY)


def q_labelled_only(spark, sf):
    return labelled_only(li_scored(spark, sf)).select(*KEY, "tag")


def q_perf_label_filter(spark, sf):
    """The reports' rows of a saved score table that still holds other tags, and none at all."""
    scored = li_scored(spark, sf).drop("is_pos", "is_neg")
    scored = scored.withColumn("tag", F.when(F.col("l_linenumber") != 7, F.col("tag")))
    saved = spark.read.parquet(sinks.save_scores(scored, scratch_path(spark, "all-scores")))
    return series_unpivot(saved, K.LI).filter("series = 'model0'").select(*KEY, "score", "tag")


# ------------------------------------------------------------------ projections
def _li_labels(spark, sf):
    return add_labels(K.lineitem(spark, sf), K.LI)


def q_row_weight(spark, sf):
    return _li_labels(spark, sf).select(*KEY, "weight")


def q_weight_tag(spark, sf):
    return _li_labels(spark, sf).select(*KEY, "weight_tag")


def q_binary_tag(spark, sf):
    rows = labelled_only(_li_labels(spark, sf))
    return rows.select(*KEY, binary_tag(F.col("tag"), K.LI.pos_tags).alias("binary_tag"))


def q_trim_tag(spark, sf):
    li = K.lineitem(spark, sf)
    padded = F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" "))
    return li.select(*KEY, trim_tag(padded).alias("tag"))


def q_meta_numeric(spark, sf):
    li = K.lineitem(spark, sf)
    return li.select(*KEY, meta_numeric(F.col("l_tax")).alias("meta_l_tax"),
                     meta_numeric(F.col("l_linestatus")).alias("meta_l_linestatus"))


def q_meta_string(spark, sf):
    scored = score_multiclass(K.table(spark, sf, "orders"), K.OR)
    return scored.select("o_orderkey", "meta_o_orderpriority")


# ------------------------------------------------------------------ scoring
def q_score_models(spark, sf):
    return score_models(K.lineitem(spark, sf), K.LI.scorers, with_stats=False) \
        .select(*KEY, "model0", "model1", "model2")


def q_score_models_python(spark, sf):
    """Three Python models, loaded and run in one step."""
    return score_models(K.lineitem(spark, sf), K.PYTHON_SCORERS, with_stats=False).select(*KEY, "model0", "model1", "model2")


def q_score_models_clash(spark, sf):
    """Input columns named like outputs: scorers, label and weight read the input's."""
    li = K.lineitem(spark, sf).select(
        *KEY, (F.col("l_quantity") + 0.5).alias("model0"), F.col("l_returnflag").alias("tag"),
        F.col("l_tax").alias("score_max"), (F.col("l_quantity") * 2).alias("weight"))
    spec = K.LI.with_(target="tag", weight_col="weight", meta_cols=(), score_meta_cols=("score_max",),
                      scorers=("l_linenumber * 10", "model0", "weight"))
    return score(li, spec).select(*KEY, "tag", "weight", "model0", "model1", "model2", "score_max", "meta_score_max")


def q_score_stats(spark, sf):
    return li_scored(spark, sf).select(*KEY, "score_max", "score_min", "score_avg", "score_median")


def q_score_lr(spark, sf):
    emb = K.table(spark, sf, "embeddings")
    return score_models(emb, K.EM.scorers, with_stats=False).select("vec_id", "model0")


def q_scorer_api(spark, sf):
    scored = score_models(K.lineitem(spark, sf), (K.PANDAS_SCORER,), with_stats=False)
    return scored.select(*KEY, "model0")


def q_score_multiclass(spark, sf):
    return score_multiclass(K.table(spark, sf, "orders"), K.OR) \
        .select("o_orderkey", "scores", "tag")


def q_mode_dispatch(spark, sf):
    multi = evaluate(K.table(spark, sf, "orders"), K.OR)["counters"]
    binary = evaluate(K.lineitem(spark, sf), K.LI, reports=False)["counters"].select("records")
    return (multi.select(F.lit("multiclass").alias("mode"), "records")
            .unionByName(binary.select(F.lit("binary").alias("mode"), "records")))


# ------------------------------------------------------------------ aggregates
def q_run_counters(spark, sf):
    return run_counters(li_scored(spark, sf))


def q_evaluate_counters(spark, sf):
    """The counters of a whole evaluation, from the one pass that writes the score table."""
    return evaluate(K.lineitem(spark, sf), K.LI, reports=False)["counters"]


def q_partition_totals(spark, sf):
    names = [n for n, _ in series_sources(K.LI)]
    return merged_partitions(local_sums_table(li_long(spark, sf), KEY, series_names=names, weight_from=K.LI.weight_from), KEY, names)


def q_population_totals(spark, sf):
    return population_totals(li_long(spark, sf))


def q_score_range(spark, sf):
    return score_range(li_long(spark, sf))


def q_missing_score_check(spark, sf):
    spec = K.LI.with_(scorers=(K.LI.scorers[0], "nullif(l_discount, 0) * 10000", K.LI.scorers[2]),
                      on_missing_score="drop")
    long = series_unpivot(score(K.lineitem(spark, sf), spec), spec, apply_policy=False)
    return missing_scores(long)


# ------------------------------------------------------------------ windows and sorts
def q_sort_by_score(spark, sf):
    sums = prefix_sums(li_long(spark, sf), KEY, method="range",
                       series_names=[n for n, _ in series_sources(K.LI)], weight_from=K.LI.weight_from)
    return sums.select("series", "score", *KEY, (F.col("cum_records") + 1).alias("current_record"))


def q_sort_by_score_ties(spark, sf):
    """Running sums where many rows share score and row key: tag and weight decide their order."""
    keys = list(K.LI_TIES.row_key)
    long = series_unpivot(score(K.lineitem(spark, sf), K.LI_TIES), K.LI_TIES, numbered=True)
    sums = prefix_sums(long, keys, series_names=[n for n, _ in series_sources(K.LI_TIES)])
    return sums.select("series", "score", *keys, "tag", "weight", (F.col("cum_records") + 1).alias("current_record"), "cum_tag",
                       F.col("cum_weight").cast("double").alias("cum_weight"), F.col("cum_weight_tag").cast("double").alias("cum_weight_tag"))


def q_prefix_sums(spark, sf):
    return _sums_view(prefix_sums(li_long(spark, sf), KEY, method="window",
                                  series_names=[n for n, _ in series_sources(K.LI)], weight_from=K.LI.weight_from))


def q_prefix_sums_distributed(spark, sf):
    return _sums_view(prefix_sums(li_long(spark, sf), KEY, method="range",
                                  series_names=[n for n, _ in series_sources(K.LI)], weight_from=K.LI.weight_from))


def q_record_rank(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, "current_record")


def q_confusion_counts(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, *COUNT_COLS)


def q_weighted_confusion(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, *WEIGHT_COLS)


def q_action_rate(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, "action_rate", "weight_action_rate")


def q_recall(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, "recall", "weight_recall")


def q_precision(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, "precision", "weight_precision")


def q_fpr(spark, sf):
    return li_perf(spark, sf).select("series", *KEY, "fpr", "weight_fpr")


def q_perf_single(spark, sf):
    spec = K.LI.with_(scorers=K.LI.scorers[:1], score_meta_cols=())
    return _perf_of(K.lineitem(spark, sf), spec)


def q_perf_all(spark, sf):
    return perf_view(li_perf(spark, sf), KEY)


def q_perf_window(spark, sf):
    return perf_view(li_perf(spark, sf, method="window"), KEY)


def q_thin_any_metric(spark, sf):
    return C.thin_perf(li_perf(spark, sf), K.LI.buckets, KEY, thin=True)


def q_point_thin(spark, sf):
    return C.point_thin(li_perf(spark, sf), "weight_action_rate", 20, KEY, label="weight_gain_20")


def q_score_points(spark, sf):
    return C.score_points(li_perf(spark, sf), KEY)


def _edge_cols():
    return ["score", *KEY, "current_record", *COUNT_COLS, *WEIGHT_COLS, *RATE_COLS]


def q_top_row(spark, sf):
    return edge_rows(li_perf(spark, sf), KEY, _edge_cols(), top=True)


def q_bottom_row(spark, sf):
    return edge_rows(li_perf(spark, sf), KEY, _edge_cols(), top=False)


# ------------------------------------------------------------------ series, curves, panels
def q_series_unpivot(spark, sf):
    return li_long(spark, sf)


def q_prune_for_series(spark, sf):
    """Only what the sort needs: series, score, tag, weight and positive weight."""
    return prune_for_series(li_long(spark, sf))


def q_to_double(spark, sf):
    """The series table with every value as DOUBLE (tag 1.0 / 0.0)."""
    return as_doubles(li_long(spark, sf), KEY)


def _curve_query(name: str) -> Query:
    def q(spark, sf):
        return C.curve(li_perf(spark, sf), name, K.LI.buckets, KEY)
    q.__name__ = f"q_curve_{name}"
    return q


def q_curve_score(spark, sf):
    return C.score_points(li_perf(spark, sf), KEY)


def q_gain_panels(spark, sf):
    return gain_panels(li_points(spark, sf))


def q_pr_roc_panels(spark, sf):
    return pr_roc_panels(li_points(spark, sf))


def q_score_histogram(spark, sf):
    return score_histogram(li_long(spark, sf))


def q_evaluate(spark, sf):
    return evaluate(K.lineitem(spark, sf), K.LI)["points"]


def q_evaluate_text(spark, sf):
    """From text files with headers, bad prices and short rows to curve points."""
    return evaluate_text(spark, K.text_set(spark, sf, "bad"), K.DELIM, K.OT)["points"]


# ------------------------------------------------------------------ other eval sets
def q_perf_events(spark, sf):
    return _perf_of(K.table(spark, sf, "events"), K.EV)


def q_perf_labels(spark, sf):
    return _perf_of(K.labelled_documents(spark, sf), K.LB)


def q_perf_embeddings(spark, sf):
    return _perf_of(K.table(spark, sf, "embeddings"), K.EM)


def q_curves_events(spark, sf):
    perf = performance(score(K.table(spark, sf, "events"), K.EV), K.EV)
    return C.all_points(perf, K.EV.buckets, list(K.EV.row_key))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "scan_text": q_scan_text,
        "split_fields": q_split_fields,
        "skip_header": q_skip_header,
        "skip_header_by_place": q_skip_header_by_place,
        "check_headers": q_check_headers,
        "short_row_policy": q_short_row_policy,
        "null_to_empty": q_null_to_empty,
        "save_scores": q_save_scores,
        "save_perf": q_save_perf,
        "save_sorted": q_save_sorted,
        "save_filtered": q_save_filtered,
        "points_csv": q_points_csv,
        "purify": q_purify,
        "purify_row_errors": q_purify_row_errors,
        "purify_invalid": q_purify_invalid,
        "purifier_api": q_purifier_api,
        "labelled_only": q_labelled_only,
        "perf_label_filter": q_perf_label_filter,
        "row_weight": q_row_weight,
        "weight_tag": q_weight_tag,
        "binary_tag": q_binary_tag,
        "trim_tag": q_trim_tag,
        "meta_numeric": q_meta_numeric,
        "meta_string": q_meta_string,
        "score_models": q_score_models,
        "score_models_python": q_score_models_python,
        "score_models_clash": q_score_models_clash,
        "score_stats": q_score_stats,
        "score_lr": q_score_lr,
        "scorer_api": q_scorer_api,
        "score_multiclass": q_score_multiclass,
        "mode_dispatch": q_mode_dispatch,
        "run_counters": q_run_counters,
        "evaluate_counters": q_evaluate_counters,
        "partition_totals": q_partition_totals,
        "population_totals": q_population_totals,
        "score_range": q_score_range,
        "missing_score_check": q_missing_score_check,
        "sort_by_score": q_sort_by_score,
        "sort_by_score_ties": q_sort_by_score_ties,
        "prefix_sums": q_prefix_sums,
        "prefix_sums_distributed": q_prefix_sums_distributed,
        "record_rank": q_record_rank,
        "confusion_counts": q_confusion_counts,
        "weighted_confusion": q_weighted_confusion,
        "action_rate": q_action_rate,
        "recall": q_recall,
        "precision": q_precision,
        "fpr": q_fpr,
        "perf_single": q_perf_single,
        "perf_all": q_perf_all,
        "perf_window": q_perf_window,
        "thin_any_metric": q_thin_any_metric,
        "point_thin": q_point_thin,
        "score_points": q_score_points,
        "top_row": q_top_row,
        "bottom_row": q_bottom_row,
        "series_unpivot": q_series_unpivot,
        "prune_for_series": q_prune_for_series,
        "to_double": q_to_double,
    }
    for name in C.CURVE_METRICS:
        q[f"curve_{name}"] = _curve_query(name)
    q.update({
        "curve_score": q_curve_score,
        "gain_panels": q_gain_panels,
        "pr_roc_panels": q_pr_roc_panels,
        "score_histogram": q_score_histogram,
        "evaluate": q_evaluate,
        "evaluate_text": q_evaluate_text,
        "perf_events": q_perf_events,
        "perf_labels": q_perf_labels,
        "perf_embeddings": q_perf_embeddings,
        "curves_events": q_curves_events,
    })
    return q
