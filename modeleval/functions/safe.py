"""Guarded arithmetic that keeps ANSI mode on.

Spark 4 runs with ANSI semantics: a division by zero or a cast of NaN to an
integer raises. The evaluation rules want Scala ``Double.toInt`` truncation (toward
zero, NaN -> 0, saturating) and exact sums, so these helpers say so explicitly. They are
plain column expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2147483647
INT_MIN = -2147483648

# Sums and running sums of scaled weights are exact (10^12 rows of weight 10^8 overflow
# BIGINT); DOUBLE appears only in the finished weights and rates.
WEIGHT_SUM_TYPE = "decimal(38,0)"


def to_int(x: Column) -> Column:
    """Scala ``Double.toInt``: truncate toward zero, NaN -> 0, clamp to int range.

    ``x`` appears once, so a large rate expression is not copied into the plan.
    """
    clamped = F.least(F.greatest(F.nanvl(x, F.lit(0.0)), F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    return clamped.cast("int")


def bucket_of(metric: Column, buckets: int) -> Column:
    """The bucket a rate falls in: ``trunc(metric * B)`` with Scala int rules."""
    return to_int(metric * F.lit(float(buckets)))


def weight_sum(c: Column) -> Column:
    """Exact sum of a scaled integer weight (no overflow), as DECIMAL(38,0)."""
    return F.sum(c.cast(WEIGHT_SUM_TYPE))


def running_weight(c: Column) -> Column:
    """A per-row running weight value, exact."""
    return c.cast(WEIGHT_SUM_TYPE)
