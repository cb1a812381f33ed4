"""Labels, weights, counters and the binary score table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeleval.functions.safe import weight_sum
from modeleval.functions.tags import is_tag, meta_numeric, row_weight, trim_tag, weight_tag
from modeleval.operators.scoring import apply_scorers, model_names, score_stats
from modeleval.spec import EvalSpec


LABELS = ("tag", "weight", "weight_tag", "is_pos", "is_neg")
STATS = ("score_max", "score_min", "score_avg", "score_median")
# Names that the reports use beside the row key.
RESERVED = {"series", "score", "curve", "seq", "current_record", "_pid"}


def add_labels(df: DataFrame, spec: EvalSpec) -> DataFrame:
    """Add ``tag`` (trimmed text), ``weight`` (scaled BIGINT), ``is_pos``, ``is_neg``
    and ``weight_tag`` (weight for positives, else 0)."""
    return df.withColumns(label_columns(spec))


def label_columns(spec: EvalSpec) -> dict:
    """The label columns, each from input columns only (an input column may have one's name)."""
    tag = trim_tag(F.col(spec.target))
    weight = row_weight(F.col(spec.weight_col) if spec.weight_col else None, spec.weight_scale)
    pos = is_tag(tag, spec.pos_tags)
    return {"tag": tag, "weight": weight, "is_pos": pos, "is_neg": is_tag(tag, spec.neg_tags),
            "weight_tag": weight_tag(pos, weight)}


def labelled_only(df: DataFrame) -> DataFrame:
    """Rows whose tag is positive or negative; unlabelled rows are counted, not scored."""
    return df.filter(F.col("is_pos") | F.col("is_neg"))


def counter_columns() -> list:
    """The five counters as aggregate expressions over scored rows (unlabelled included)."""
    pos, neg = F.col("is_pos"), F.col("is_neg")
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(pos).alias("pos"),
        F.count_if(neg).alias("neg"),
        weight_sum(F.when(pos, F.col("weight")).otherwise(F.lit(0))).alias("weighted_pos"),
        weight_sum(F.when(neg, F.col("weight")).otherwise(F.lit(0))).alias("weighted_neg"),
    ]


def run_counters(labelled: DataFrame) -> DataFrame:
    """One row: records (unlabelled included), positives, negatives and their weights.

    A single aggregate with map-side partial sums; weights are summed exactly
    as DECIMAL(38,0) and reported as DOUBLE.
    """
    return labelled.agg(*counter_columns()).select(
        "records", "pos", "neg",
        F.coalesce(F.col("weighted_pos").cast("double"), F.lit(0.0)).alias("weighted_pos"),
        F.coalesce(F.col("weighted_neg").cast("double"), F.lit(0.0)).alias("weighted_neg"),
    )


def score_rows(df: DataFrame, spec: EvalSpec, unlabelled: bool = True) -> DataFrame:
    """Scored and labelled rows, before the label filter.

    ``unlabelled=False`` leaves the scores of rows without a known label NULL.

    Columns: row key, ``tag``, ``weight``, ``weight_tag``, ``is_pos``, ``is_neg``,
    ``model0..``, ``score_max/min/avg/median`` and ``meta_<c>`` (DOUBLE) for each
    meta and score-meta column. Everything is computed from input columns, whatever
    their names; only a row key column may not have the name of an output column.
    """
    needed = set(spec.row_key) | {spec.target} | set(spec.meta_cols) | set(spec.score_meta_cols)
    if spec.weight_col:
        needed.add(spec.weight_col)
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the input: {sorted(missing)}")
    metas = list(dict.fromkeys([*spec.score_meta_cols, *spec.meta_cols]))
    outputs = {*LABELS, *model_names(spec.model_count), *STATS, *(f"meta_{c}" for c in metas)}
    clash = set(spec.row_key) & (outputs | RESERVED)
    if clash:
        raise ValueError(f"row key columns have names of output columns: {sorted(clash)}")
    labels = label_columns(spec)
    scored, hidden = apply_scorers(df, spec.scorers, None if unlabelled else labels["is_pos"] | labels["is_neg"])
    return scored.select(
        *[F.col(k) for k in spec.row_key],
        *[labels[c].alias(c) for c in LABELS],
        *[F.col(h).alias(n) for n, h in zip(model_names(spec.model_count), hidden)],
        *[c.alias(n) for n, c in score_stats([F.col(h) for h in hidden]).items()],
        *[meta_numeric(F.col(c)).alias(f"meta_{c}") for c in metas],
    )


LABELLED = "labelled"


def score_table(scored: DataFrame) -> DataFrame:
    """Every scored row under a flag ``labelled`` (1 or 0); unlabelled rows are counted but hold nothing else.

    Written by that flag, the reports read its labelled part only and the counters need
    no second pass over the input.
    """
    known = F.col("is_pos") | F.col("is_neg")
    return scored.select(*[F.when(known, F.col(c)).alias(c) for c in scored.columns if c not in ("is_pos", "is_neg")],
                         known.cast("int").alias(LABELLED))


def table_counters(saved: DataFrame, spec: EvalSpec) -> DataFrame:
    """``run_counters`` of a written ``score_table``."""
    tag = F.col("tag")
    return run_counters(saved.select("weight", is_tag(tag, spec.pos_tags).alias("is_pos"), is_tag(tag, spec.neg_tags).alias("is_neg")))


def scored_output(scored: DataFrame) -> DataFrame:
    """The saved score table: labelled rows only, without the helper flags."""
    return labelled_only(scored).drop("is_pos", "is_neg")
