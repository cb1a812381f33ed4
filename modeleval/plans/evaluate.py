"""The whole evaluation: one DataFrame per output.

    rows -> purify -> score -> label/weight -> counters, score table
         -> series unpivot -> prefix sums -> rates -> perf rows
         -> curve points -> panels, CSV

``evaluate`` picks the binary or the multi-class path from the spec (the
original's ``isRegression`` switch); reports exist only for the binary path.

The score table, the local running sums and the curve points are written as soon as
``evaluate`` is called; the other outputs are lazy and read what was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeleval.operators.curves import all_points, thin_perf
from modeleval.operators.labels import LABELLED, score_rows, score_table, table_counters
from modeleval.operators.panels import gain_panels, pr_roc_panels, score_histogram
from modeleval.operators.performance import performance_from_long, perf_view, spread
from modeleval.operators.prefix import partitions_for, plan_bytes
from modeleval.operators.purify import purify
from modeleval.operators.scoring import score_multiclass
from modeleval.operators.series import series_sources, series_unpivot
from modeleval.session import Run, materialize, scratch_owner, scratch_path
from modeleval.sources import sinks
from modeleval.sources.text import header_of, read_delimited
from modeleval.spec import EvalSpec


def score(df: DataFrame, spec: EvalSpec, unlabelled: bool = True) -> DataFrame:
    """Filtered, scored and labelled rows (unlabelled ones still present)."""
    return score_rows(purify(df, spec.condition, spec.on_invalid, spec.on_row_error), spec, unlabelled)


def evaluate_binary(df: DataFrame, spec: EvalSpec, output: str | None = None,
                    reports: bool = True) -> dict[str, DataFrame]:
    """Score once, then report from the written score table.

    One pass over the input writes the score rows (to ``output`` or the shared scratch
    folder), the labelled ones under ``labelled=1`` and the others, which hold nothing,
    under ``labelled=0``. The counters count both; every report reads the first only.
    """
    spark = df.sparkSession
    rows = score_table(score(spread(df, spec.row_key), spec, unlabelled=False))
    path = f"{output}/scores" if output is not None else scratch_path(spark, "scores")
    sinks.save_scores(rows, path, by=[LABELLED])
    table = spark.read.schema(rows.schema).parquet(path)
    saved = table.filter(F.col(LABELLED) == 1).drop(LABELLED)
    result = {"counters": table_counters(table, spec), "scores": saved}
    if not reports:
        return result
    long = series_unpivot(saved, spec, numbered=True)
    if spec.prefix_partitions is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spec = spec.with_(prefix_partitions=partitions_for(plan_bytes(saved), len(series_sources(spec)), least))
    perf = performance_from_long(long, spec)
    # Points are small (about B + 1 per curve and series); written once, they
    # feed the panels and the CSV without recomputing the curve filters.
    points = materialize(all_points(perf, spec.buckets, spec.row_key), "points")
    result.update(
        perf=perf_view(thin_perf(perf, spec.buckets, spec.row_key, spec.thin), spec.row_key),
        points=points,
        gain_panels=gain_panels(points),
        pr_roc_panels=pr_roc_panels(points),
        score_histogram=score_histogram(perf),
    )
    if output is not None:
        sinks.save_perf(result["perf"], f"{output}/perf")
        sinks.points_csv(points.filter(F.col("curve") != "score"), f"{output}/curves")
    return result


def evaluate_multiclass(df: DataFrame, spec: EvalSpec, output: str | None = None) -> dict[str, DataFrame]:
    scores = score_multiclass(purify(df, spec.condition, spec.on_invalid, spec.on_row_error), spec)
    if output is not None:
        sinks.save_scores(scores, f"{output}/scores")
    return {"scores": scores, "counters": scores.agg(F.count(F.lit(1)).alias("records"))}


def evaluate(df: DataFrame, spec: EvalSpec, output: str | None = None,
             reports: bool = True) -> Run:
    """Run the evaluation; ``output`` (shared storage) also writes scores, perf and CSVs.

    The result is a dict of DataFrames that owns the scratch tables behind them: close it,
    or use it in a ``with`` block, when its outputs have been read or written.
    ``reports=False`` stops after scores and counters (the performance tables
    write intermediate tables as soon as they are planned).
    """
    with scratch_owner() as paths:
        outputs = evaluate_multiclass(df, spec, output) if spec.multiclass else evaluate_binary(df, spec, output, reports)
    return Run(df.sparkSession, outputs, paths)


def evaluate_text(spark: SparkSession, paths: str | Sequence[str], delimiter: str, spec: EvalSpec,
                  headers: Sequence[str] | None = None, has_header: bool = True,
                  output: str | None = None, reports: bool = True) -> Run:
    """From delimited text to reports: lines -> fields (all text) -> ``evaluate``.

    Without ``headers`` they are read from the first line. The first line of every file is
    dropped (``has_header``), and rows with too few fields follow ``spec.on_short_row``.
    """
    names = list(headers) if headers is not None else header_of(spark, paths, delimiter)
    rows = read_delimited(spark, paths, names, delimiter, has_header=has_header, on_short_row=spec.on_short_row)
    return evaluate(rows, spec, output, reports)
