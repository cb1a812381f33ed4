"""Curve points: thinning perf rows into gain, PR, ROC and score curves.

The original folds each series on the driver from the highest score down and
keeps a row when ``trunc(metric * B)`` differs from the last kept row. A row
that is not kept has the last kept row's bucket, so "differs from the last
kept row" is the same as "differs from the row just above". The row just above
(next higher score) has exclusive sums equal to this row's sums plus this row's
own values, so every test is known at the row itself: the performance step
gives them all as bits of one integer column, and each curve and the thinning
are a filter on it - no sort, no window, no driver fold. Only kept points get
numbered, in each range partition first; the counts of the partitions before it
are added, so no task holds a whole curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeleval.functions.safe import bucket_of
from modeleval.operators.performance import COUNT_COLS, RATE_COLS, SCORE_ABOVE, SCORE_BELOW, TOP, WEIGHT_COLS, kept_name
from modeleval.session import materialize

# Curve names and the perf metric each one is thinned on.
CURVE_METRICS = {
    "weight_gain": "weight_action_rate",
    "gain": "action_rate",
    "weight_recall": "weight_recall",
    "recall": "recall",
    "weight_roc": "weight_fpr",
    "roc": "fpr",
}
SCORE_CURVE = "score"


def _with_kept(perf: DataFrame, buckets: int, rates: Sequence[str]) -> DataFrame:
    """``perf`` with the keep bits for ``buckets``, of the named rates at least.

    Other bucket counts than the perf table's own compare its rates with those of the row
    above; the bits that do not depend on the bucket count are taken over.
    """
    name = kept_name(buckets)
    if name in perf.columns:
        return perf
    other = next(c for c in perf.columns if c.startswith("_kept_"))
    bits = F.col(other).bitwiseAND(F.lit(sum(1 << b for b in (SCORE_ABOVE, SCORE_BELOW, TOP))))
    for m in rates:
        differs = bucket_of(F.col(m), buckets) != bucket_of(F.col(f"_above.{m}"), buckets)
        bits = bits.bitwiseOR(F.when(differs, F.lit(1 << RATE_COLS.index(m))).otherwise(F.lit(0)))
    return perf.withColumn(name, bits)


def _has(buckets: int, *bits: int) -> Column:
    return F.col(kept_name(buckets)).bitwiseAND(F.lit(sum(1 << b for b in bits))) != 0


def _point_cols(keys: Sequence[str]) -> list[str]:
    return ["series", "score", *keys, "current_record", *COUNT_COLS, *WEIGHT_COLS, *RATE_COLS]


def _numbered(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``seq`` of each point in its curve: from the highest score down, but the score curve from
    the lowest up, its repeated top row last.

    Points are numbered within (series, curve, range partition); the number of points in
    the partitions that come first, at most partitions x series x curves rows, is added.
    """
    rows = points
    sign = F.when(F.col("curve") == SCORE_CURVE, F.lit(1)).otherwise(F.lit(-1))
    rows = rows.withColumn("_order", sign * F.col("current_record")).withColumn("_part", sign * F.col("_pid"))
    counts = rows.groupBy("series", "curve", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("series", "curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("series", "curve", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("series", "curve", "_part").orderBy("_tail", "_order"))
    out = rows.withColumn("_local", local).join(counts, ["series", "curve", "_part"])
    return out.select("series", "curve", (F.col("_before") + F.col("_local")).cast("int").alias("seq"), *_point_cols(keys)[1:])


def _points(perf: DataFrame, buckets: int, keys: Sequence[str], metrics: dict[str, str], with_score: bool) -> DataFrame:
    """Points of the curves in ``metrics`` (name -> rate), and of the score curve, in one scan.

    The kept rows are written in this call.
    """
    rows = _with_kept(perf, buckets, list(metrics.values()))
    bits = {c: RATE_COLS.index(m) for c, m in metrics.items()}
    names = [F.when(_has(buckets, b, TOP), F.struct(F.lit(c).alias("curve"), F.lit(0).alias("_tail"))) for c, b in bits.items()]
    if with_score:
        names += [F.when(_has(buckets, SCORE_BELOW), F.struct(F.lit(SCORE_CURVE).alias("curve"), F.lit(0).alias("_tail"))),
                  F.when(_has(buckets, TOP), F.struct(F.lit(SCORE_CURVE).alias("curve"), F.lit(1).alias("_tail")))]
    any_bit = [*bits.values(), TOP, *([SCORE_BELOW] if with_score else [])]
    kept = rows.filter(_has(buckets, *any_bit)).select(F.explode(F.array_compact(F.array(*names))).alias("_c"), *_point_cols(keys), "_pid")
    # Few rows, read twice by the numbering.
    return _numbered(materialize(kept.select("_c.*", *_point_cols(keys), "_pid"), "kept"), keys)


def curves(perf: DataFrame, buckets: int, keys: Sequence[str],
           names: Sequence[str] | None = None) -> DataFrame:
    """Points of the metric curves, all in one pass over the perf table.

    Columns: series, curve, seq (1 = highest score), score, row key, rank,
    counts and rates.
    """
    return _points(perf, buckets, keys, {c: CURVE_METRICS[c] for c in names or CURVE_METRICS}, with_score=False)


def curve(perf: DataFrame, name: str, buckets: int, keys: Sequence[str]) -> DataFrame:
    """One metric curve by name (``weight_gain``, ``gain``, ``weight_recall``, ...)."""
    return curves(perf, buckets, keys, [name])


def point_thin(perf: DataFrame, metric: str, buckets: int, keys: Sequence[str],
               label: str | None = None) -> DataFrame:
    """Thin on any rate column (the general form behind the named curves)."""
    return _points(perf, buckets, keys, {label or metric: metric}, with_score=False)


def score_points(perf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From the lowest score up, keep each row whose integer score differs from the
    row below; then append the highest row again as the last point.

    ``seq`` runs from 1 at the lowest kept row. Integer scores are clamped to the
    32-bit range.
    """
    buckets = next(int(c.removeprefix("_kept_")) for c in perf.columns if c.startswith("_kept_"))
    return _points(perf, buckets, keys, {}, with_score=True)


def all_points(perf: DataFrame, buckets: int, keys: Sequence[str]) -> DataFrame:
    """The six metric curves and the score curve in one table, from one scan."""
    return _points(perf, buckets, keys, CURVE_METRICS, with_score=True)


def thin_perf(perf: DataFrame, buckets: int, keys: Sequence[str], thin: bool = True) -> DataFrame:
    """Perf rows thinned to operating points.

    ``thin=False`` keeps every row, which is what the original job ends up doing
    (its keep test is always true). ``thin=True`` does what it meant: from the
    top down, keep a row when the bucket of any of the eight rates or the
    integer score differs from the row above. One scan, no shuffle.
    """
    if not thin:
        return perf.select(*_point_cols(keys))
    return _with_kept(perf, buckets, RATE_COLS).filter(_has(buckets, *range(len(RATE_COLS)), SCORE_ABOVE, TOP)).select(*_point_cols(keys))
