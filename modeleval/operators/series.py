"""From the wide score table to one long table of (series, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeleval.functions.safe import weight_sum
from modeleval.functions.tags import is_tag
from modeleval.operators.labels import labelled_only
from modeleval.operators.scoring import model_names
from modeleval.spec import EvalSpec

LONG_VALUES = ("tag", "weight", "weight_tag")


def series_sources(spec: EvalSpec) -> list[tuple[str, str]]:
    """(series name, score column) pairs in report order.

    One series per model, then ``avg`` (only with more than one model), then one
    per score-meta column, named by the bare column name.
    """
    pairs = [(m, m) for m in model_names(spec.model_count)]
    if spec.model_count > 1:
        pairs.append(("avg", "score_avg"))
    pairs.extend((c, f"meta_{c}") for c in spec.score_meta_cols)
    names = [p[0] for p in pairs]
    clash = {n for n in names if names.count(n) > 1} | (set(names) & (set(spec.row_key) | set(LONG_VALUES)))
    if clash:
        raise ValueError(f"series names clash with other columns: {sorted(clash)}")
    return pairs


def missing_score_policy(long: DataFrame, policy: str, name: Column | None = None) -> DataFrame:
    """A row without a score for its series fails the job (``error``) or is left out (``drop``).

    The check rides along in the same stage; no extra pass over the data.
    """
    score = F.col("score")
    if policy == "drop":
        return long.filter(score.isNotNull())
    if policy == "error":
        return long.withColumn("score", F.when(score.isNull(), F.raise_error(
            F.concat(F.lit("No score value for series "), F.col("series") if name is None else name)))
            .otherwise(score))
    raise ValueError(f"unknown missing-score policy {policy!r}")


def series_unpivot(scored: DataFrame, spec: EvalSpec, apply_policy: bool = True, numbered: bool = False) -> DataFrame:
    """Long table ``series, score, <row key>, tag (0/1), weight, weight_tag``.

    Only labelled rows; the columns a series does not need are pruned here, so
    the later shuffle moves nothing else. ``unpivot`` keeps NULL scores, so the
    missing-score rule can see them. ``numbered`` gives each series its position
    in ``series_sources`` (INT) instead of its name.
    """
    # A saved score table has the trimmed tag text only; rows of other tags are not in the reports.
    saved = "is_pos" not in scored.columns
    rows = scored.filter(is_tag(F.col("tag"), spec.pos_tags + spec.neg_tags)) if saved else labelled_only(scored)
    keys = list(spec.row_key)
    pairs = series_sources(spec)
    tag = (is_tag(F.col("tag"), spec.pos_tags) if saved else F.col("is_pos")).cast("int")
    base = rows.select(
        *[F.col(k) for k in keys],
        tag.alias("tag"), F.col("weight"), F.col("weight_tag"),
        *[F.col(src).cast("double").alias(name) for name, src in pairs],
    )
    if numbered:
        cells = F.array(*[F.struct(F.lit(i).alias("series"), F.col(name).alias("score")) for i, (name, _) in enumerate(pairs)])
        long = base.select(F.inline(cells), *keys, *LONG_VALUES)
    else:
        long = base.unpivot(keys + list(LONG_VALUES), [n for n, _ in pairs], "series", "score")
    long = long.select("series", "score", *keys, *LONG_VALUES)
    name = F.element_at(F.array(*[F.lit(n) for n, _ in pairs]), F.col("series") + 1) if numbered else None
    return missing_score_policy(long, spec.on_missing_score, name) if apply_policy else long


def prune_for_series(long: DataFrame) -> DataFrame:
    """The columns a series needs before its sort (Catalyst prunes the rest anyway)."""
    return long.select("series", "score", *LONG_VALUES)


def as_doubles(long: DataFrame, keys: list[str]) -> DataFrame:
    """The series table with tag and weights as DOUBLE, the original's value type."""
    return long.select("series", "score", *keys,
                       *[F.col(c).cast("double").alias(c) for c in LONG_VALUES])


def missing_scores(long: DataFrame) -> DataFrame:
    """Per series: how many rows have no score."""
    return long.groupBy("series").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("score").isNull()).alias("missing"),
    )


def population_totals(long: DataFrame) -> DataFrame:
    """Per series: n, P, N, weight sum, positive and negative weight."""
    t = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("tag").alias("pos"),
        weight_sum(F.col("weight")).alias("_w"),
        weight_sum(F.col("weight_tag")).alias("_wp"),
    )
    return t.select(
        "series", "records", "pos", (F.col("records") - F.col("pos")).alias("neg"),
        F.col("_w").cast("double").alias("weight_sum"),
        F.col("_wp").cast("double").alias("weight_pos"),
        (F.col("_w") - F.col("_wp")).cast("double").alias("weight_neg"),
    )


def score_range(long: DataFrame) -> DataFrame:
    """Per series: lowest and highest score."""
    return long.groupBy("series").agg(
        F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def edge_rows(table: DataFrame, keys: list[str], cols: list[str], top: bool = True) -> DataFrame:
    """Per series, the highest (or lowest) row in (score, key) order: ``max_by``/``min_by``.

    The rows of a series are sorted for this aggregate, since a struct is no fixed-size buffer.
    Where the table has range partitions (``_pid`` rises with score and key), the last (or
    first) partition of each series is found by a hash aggregate and only its rows are taken.
    """
    if "_pid" in table.columns:
        ends = table.groupBy(F.col("series").alias("_s")).agg((F.max("_pid") if top else F.min("_pid")).alias("_p"))
        table = table.join(F.broadcast(ends), F.col("series").eqNullSafe(F.col("_s")) & (F.col("_pid") == F.col("_p")), "left_semi")
    order = F.struct(F.col("score"), *[F.col(k) for k in keys])
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(row, order) if top else F.min_by(row, order)
    return table.groupBy("series").agg(pick.alias("_r")).select("series", "_r.*")
