"""Confusion counts and rates at every row of every series.

With ``P, N`` the positives and negatives of a series, ``n = P + N``, and
``cr, ct, cw, cwt`` the records, positives, weight and positive weight of the
rows *before* this one in ascending score order:

    tp = P - ct       tn = cr - ct       fn = ct        fp = N - tn
    wtp = WP - cwt    wtn = cw - cwt     wfn = cwt      wfp = WN - wtn
    action_rate = (tp + fp) / n          recall = tp / (tp + fn)
    precision   = tp / (tp + fp), 1.0 when tp + fp = 0
    fpr         = fp / (fp + tn)
and the same with weights. ``current_record`` is the 1-based rank.

The written local sums and the offsets of their partitions are all a row needs, so
counts, rates and keep bits are one vectorised step over Arrow batches: exact whole
numbers (``functions.wide``) until one conversion to DOUBLE per value, each rate
divided once. Nothing but the local sums is stored. The step is an Arrow UDF, so rows
that a filter on the keep bits drops never get counts or rates, and row keys never
leave the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeleval.functions import wide
from modeleval.operators.prefix import Running, decode_series, plan_bytes, running_sums, with_offsets
from modeleval.operators.series import series_sources, series_unpivot
from modeleval.session import materialize
from modeleval.spec import DEFAULT_MAX_BROADCAST_ROWS, EvalSpec

COUNT_COLS = ("tp", "tn", "fn", "fp")
WEIGHT_COLS = ("weight_tp", "weight_tn", "weight_fn", "weight_fp")
RATE_COLS = ("action_rate", "weight_action_rate", "recall", "weight_recall",
             "precision", "weight_precision", "fpr", "weight_fpr")
PERF_COLS = ("series", "score", "current_record", *COUNT_COLS, *WEIGHT_COLS, *RATE_COLS)
# Bits of the keep column: one per rate in RATE_COLS, then these.
SCORE_ABOVE, SCORE_BELOW, TOP = 8, 9, 10
# Offsets of so many (partition, series) travel with the step; more are joined to the rows.
LOOKUP_ROWS = 20_000

WHOLE = ("off_records", "off_tag", "total_records", "total_pos")
WEIGHTS = ("off_weight", "off_weight_tag", "total_weight", "total_weight_pos")
EDGES = ("prev_run_last", "next_run_first")
# What each step reads of a row: its local sums; its own values; its score and those around it.
LOCAL = ("loc_records", "loc_tag", "loc_weight_low", "loc_weight_tag_low", "loc_weight_high", "loc_weight_tag_high")
OWN = ("tag", "weight", "weight_tag")
SCORES = ("score", "prev_score", "next_score")
Arrays = dict[str, np.ndarray]


def kept_name(buckets: int) -> str:
    return f"_kept_{buckets}"


def to_int(x: np.ndarray) -> np.ndarray:
    """Truncate toward zero; NaN -> 0; clamped to 32 bits."""
    return np.clip(np.nan_to_num(x, nan=0.0), -(2.0**31), 2.0**31 - 1).astype(np.int64)


def _pair(rows: Arrays, name: str) -> wide.Wide:
    return rows[f"{name}_high"], rows[f"{name}_low"]


class Sums:
    """The exclusive sums of the rows of a batch (or, ``above``, of the next-higher rows of
    their series, which are these sums plus the rows' own values), with the series' totals."""

    def __init__(self, rows: Arrays, above: bool = False):
        self.cr, self.ct = rows["off_records"] + rows["loc_records"], rows["off_tag"] + rows["loc_tag"]
        self.cw = wide.add(_pair(rows, "off_weight"), _pair(rows, "loc_weight"))
        self.cwt = wide.add(_pair(rows, "off_weight_tag"), _pair(rows, "loc_weight_tag"))
        if above:
            self.cr, self.ct = self.cr + 1, self.ct + rows["tag"]
            self.cw = wide.normal(self.cw[0] + (rows["weight"] >> wide.BITS), self.cw[1] + (rows["weight"] & wide.MASK))
            self.cwt = wide.normal(self.cwt[0] + (rows["weight_tag"] >> wide.BITS), self.cwt[1] + (rows["weight_tag"] & wide.MASK))
        self.n, self.p = rows["total_records"], rows["total_pos"]
        self.w, self.wp = _pair(rows, "total_weight"), _pair(rows, "total_weight_pos")

    def counts(self) -> Arrays:
        tn = self.cr - self.ct
        return {"tp": self.p - self.ct, "tn": tn, "fn": self.ct, "fp": self.n - self.p - tn}

    def weights(self) -> Arrays:
        tn = wide.subtract(self.cw, self.cwt)
        fp = wide.subtract(wide.subtract(self.w, self.wp), tn)
        return {"weight_tp": wide.to_double(wide.subtract(self.wp, self.cwt)), "weight_tn": wide.to_double(tn),
                "weight_fn": wide.to_double(self.cwt), "weight_fp": wide.to_double(fp)}

    def rates(self, counts: Arrays, weights: Arrays) -> Arrays:
        """NaN where a denominator is zero, but precision 1.0.

        Denominators use tp + fp = n - cr, tp + fn = P and fp + tn = N, unit-wise and weighted.
        """
        at, weight_at = self.n - self.cr, wide.to_double(wide.subtract(self.w, self.cw))
        parts = {
            "action_rate": (at, self.n), "weight_action_rate": (weight_at, wide.to_double(self.w)),
            "recall": (counts["tp"], self.p), "weight_recall": (weights["weight_tp"], wide.to_double(self.wp)),
            "precision": (counts["tp"], at), "weight_precision": (weights["weight_tp"], weight_at),
            "fpr": (counts["fp"], self.n - self.p),
            "weight_fpr": (weights["weight_fp"], wide.to_double(wide.subtract(self.w, self.wp))),
        }
        out = {}
        with np.errstate(divide="ignore", invalid="ignore"):
            for name, (num, den) in parts.items():
                den = den.astype(np.float64)
                out[name] = np.where(den == 0, 1.0 if "precision" in name else np.nan, num.astype(np.float64) / den)
        return out

    def all_rates(self) -> Arrays:
        return self.rates(self.counts(), self.weights())


def kept_bits(rows: Arrays, buckets: int) -> np.ndarray:
    """All keep tests of a row as bits of one integer: is ``trunc(rate * B)`` not that of the
    row above, is the integer score not that of the row above or below, is it the top row."""
    here, above = Sums(rows), Sums(rows, above=True)
    now, up = here.all_rates(), above.all_rates()
    out = np.zeros(len(here.cr), np.int64)
    for i, m in enumerate(RATE_COLS):
        out |= (to_int(now[m] * buckets) != to_int(up[m] * buckets)).astype(np.int64) << i
    score = to_int(rows["score"])
    has_above, has_below = ~rows["next_score_null"], ~rows["prev_score_null"]
    out |= (has_above & (score != to_int(rows["next_score"]))).astype(np.int64) << SCORE_ABOVE
    out |= (~has_below | (score != to_int(rows["prev_score"]))).astype(np.int64) << SCORE_BELOW
    out |= (here.cr + 1 == here.n).astype(np.int64) << TOP
    return out


class Lookup:
    """The offsets of all (partition, series), for rows that only name theirs."""

    def __init__(self, offsets: pa.Table, series: int):
        place = offsets["_pid"].to_numpy() * series + offsets["series"].to_numpy()
        order = np.argsort(place)
        self.series, self.place, self.columns = series, place[order], {}
        for c in WHOLE:
            self.columns[c] = offsets[c].to_numpy()[order]
        for c in WEIGHTS:
            high, low = wide.wide([int(x) for x in offsets[c].to_pylist()])
            self.columns[f"{c}_high"], self.columns[f"{c}_low"] = high[order], low[order]
        self.wide = bool(self.columns["total_weight_high"].any())
        for c in EDGES:
            self.columns[c] = offsets[c].to_numpy()[order].astype(np.float64)
            self.columns[f"{c}_null"] = np.asarray(offsets[c].is_null())[order]

    def of(self, pid: np.ndarray, series: np.ndarray) -> Arrays:
        at = np.searchsorted(self.place, pid.astype(np.int64) * self.series + series)
        return {c: v[at] for c, v in self.columns.items()}


def _batch(columns: Sequence[pa.Array], names: Sequence[str], lookup: Lookup | None) -> Arrays:
    """The columns of a batch as arrays, with the offsets and the scores around each row."""
    rows: Arrays = {}
    for name, column in zip(names, columns):
        rows[name] = column.to_numpy(zero_copy_only=False)
        if name in ("prev_score", "next_score", *EDGES):
            rows[f"{name}_null"] = np.asarray(column.is_null())
    if lookup is not None:
        rows.update(lookup.of(rows["_pid"], rows["series"]))
    for name in ("loc_weight_high", "loc_weight_tag_high"):
        if name not in rows:  # left out where all sums fit the low limb
            rows[name] = np.zeros(len(rows["loc_tag"]), np.int64)
    if "tag" in rows:
        rows["tag"] = rows["tag"].astype(np.int64)
    if "score" in rows:
        for near, edge in (("prev_score", "prev_run_last"), ("next_score", "next_run_first")):
            missing = rows[f"{near}_null"]
            rows[near] = np.where(missing, rows[edge], rows[near]).astype(np.float64)
            rows[f"{near}_null"] = missing & rows[f"{edge}_null"]
    return rows


def _step(names: Sequence[str], lookup: Lookup | None, kind: str, returns: Callable[[Arrays], pa.Array]) -> Column:
    @F.arrow_udf(kind)
    def step(*columns: pa.Array) -> pa.Array:
        return returns(_batch(columns, names, lookup))

    return step(*names)


def _struct(values: Arrays) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v) for v in values.values()], list(values))


def perf_rows(found: Running, keys: Sequence[str], buckets: int,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Perf rows over written running sums: ``PERF_COLS`` and the row key, and for the curves
    ``_kept_<buckets>``, ``_above`` (the rates of the row above) and ``_pid``."""
    lookup, local = None, LOCAL
    if found.names and found.bound <= min(LOOKUP_ROWS, max_broadcast_rows):
        lookup = Lookup(found.offsets.toArrow(), len(found.names))
        rows, place, edges = found.table, ("_pid", "series"), ()
        local = LOCAL if lookup.wide else LOCAL[:4]
    else:
        offsets = materialize(found.offsets, "offsets")
        limbs = {f"{c}_{part}": v for c in WEIGHTS for part, v in zip(("high", "low"), wide.limbs(F.col(c)))}
        rows = with_offsets(replace(found, offsets=offsets.withColumns(limbs)), max_broadcast_rows)
        place, edges = (*WHOLE, *limbs), EDGES
    rates = ",".join(f"{c}:double" for c in RATE_COLS)
    whole = ",".join(f"{c}:bigint" for c in COUNT_COLS)
    weighted = ",".join(f"{c}:double" for c in WEIGHT_COLS)
    # One step for each group of columns, all in one pass: those that no output reads are left out.
    rank = _step([*place, *local], lookup, "bigint", lambda r: pa.array(Sums(r).cr + 1))
    counts = _step([*place, *local], lookup, f"struct<{whole}>", lambda r: _struct(Sums(r).counts()))
    weights = _step([*place, *local], lookup, f"struct<{weighted}>", lambda r: _struct(Sums(r).weights()))
    here = _step([*place, *local], lookup, f"struct<{rates}>", lambda r: _struct(Sums(r).all_rates()))
    above = _step([*place, *local, *OWN], lookup, f"struct<{rates}>", lambda r: _struct(Sums(r, above=True).all_rates()))
    kept = _step([*place, *local, *OWN, *SCORES, *edges], lookup, "bigint", lambda r: pa.array(kept_bits(r, buckets)))
    rows = rows.select(
        decode_series(F.col("series"), found.names).alias("series"), "score", *keys, "_pid", rank.alias("current_record"),
        counts.alias("_counts"), weights.alias("_weights"), here.alias("_rates"), above.alias("_above"), kept.alias(kept_name(buckets)))
    return rows.select(
        "series", "score", *keys, "current_record", *[F.col(f"_counts.{c}").alias(c) for c in COUNT_COLS],
        *[F.col(f"_weights.{c}").alias(c) for c in WEIGHT_COLS], *[F.col(f"_rates.{c}").alias(c) for c in RATE_COLS],
        "_pid", "_above", kept_name(buckets))


def performance_from_long(long: DataFrame, spec: EvalSpec, series_count: int | None = None,
                          method: str | None = None) -> DataFrame:
    """Perf rows (with what the curves need) for a long series table.

    The local sums and offsets are written once under the shared checkpoint folder, in
    this call; every output reads them with the vectorised step on top.
    """
    found = running_sums(long, spec.row_key, method or spec.prefix_method, spec.prefix_partitions,
                         series_count, [n for n, _ in series_sources(spec)], spec.weight_from, whole_scores=True)
    return perf_rows(found, spec.row_key, spec.buckets, spec.max_broadcast_rows)


def performance(scored: DataFrame, spec: EvalSpec, method: str | None = None) -> DataFrame:
    """Scored rows -> perf rows for every series (models, avg, score meta)."""
    return performance_from_long(series_unpivot(spread(scored, spec.row_key), spec, numbered=True), spec, method=method)


def spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` dealt over the shuffle partitions by their key, if they are so few bytes that
    their scan may be one or two tasks; larger inputs stay as they are.

    Range partitioning computes its input twice, so one long task would run twice. A scan is
    cut into a split for each core or more, but not finer than row groups of up to 128 MB: from
    that size for every third core on, dealing costs more than the cores that may wait.
    """
    spark = rows.sparkSession
    split = 128 << 20
    if 3 * plan_bytes(rows) >= split * spark.sparkContext.defaultParallelism:
        return rows
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)


def perf_view(perf: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The published perf columns: series, score, row key, rank, counts and rates."""
    return perf.select("series", "score", *keys, "current_record", *COUNT_COLS,
                       *WEIGHT_COLS, *RATE_COLS)
