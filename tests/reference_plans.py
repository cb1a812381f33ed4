"""One window per series, a single task each: what the distributed plans must equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeleval.functions.safe import running_weight, weight_sum
from modeleval.operators.prefix import _out_columns


def prefix_global_window(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One window per series (a single task each): a small-data reference only."""
    order = [F.col("score"), *[F.col(k) for k in keys]]
    w = Window.partitionBy("series").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("series")
    zero = F.lit(0)
    out = long.select(
        "*",
        (F.row_number().over(w) - 1).cast("bigint").alias("cum_records"),
        F.coalesce(F.sum("tag").over(before), zero).cast("bigint").alias("cum_tag"),
        running_weight(F.coalesce(F.sum(running_weight(F.col("weight"))).over(before), zero))
        .alias("cum_weight"),
        running_weight(F.coalesce(F.sum(running_weight(F.col("weight_tag"))).over(before), zero))
        .alias("cum_weight_tag"),
        F.lag("score").over(w).alias("prev_score"),
        F.lead("score").over(w).alias("next_score"),
        F.count(F.lit(1)).over(whole).alias("total_records"),
        F.sum("tag").over(whole).cast("bigint").alias("total_pos"),
        running_weight(weight_sum(F.col("weight")).over(whole)).alias("total_weight"),
        running_weight(weight_sum(F.col("weight_tag")).over(whole)).alias("total_weight_pos"),
    )
    return out.withColumn("_pid", F.lit(0)).select(*_out_columns(keys))
