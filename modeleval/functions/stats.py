"""Per-row statistics over a row's model scores, and number formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_max(scores: Sequence[Column]) -> Column:
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def score_min(scores: Sequence[Column]) -> Column:
    return F.least(*scores) if len(scores) > 1 else scores[0]


def score_avg(scores: Sequence[Column]) -> Column:
    """Mean of the non-missing scores, summed left to right."""
    total = None
    present = None
    for s in scores:
        term = F.coalesce(s, F.lit(0.0))
        flag = s.isNotNull().cast("int")
        total = term if total is None else total + term
        present = flag if present is None else present + flag
    return F.when(present == 0, F.lit(None).cast("double")).otherwise(total / present)


def score_median(scores: Sequence[Column]) -> Column:
    """Median of the non-missing scores; the mean of the two middle ones when even.

    ``sort_array`` puts NULLs first, so with k present values out of N they sit
    at positions N-k+1 .. N; no lambda, so the expression stays in codegen.
    """
    total = len(scores)
    arr = F.sort_array(F.array(*[s.cast("double") for s in scores]))
    k = None
    for s in scores:
        flag = s.isNotNull().cast("int")
        k = flag if k is None else k + flag
    skip = F.lit(total) - k
    lo = F.element_at(arr, (skip + ((k + 1) / 2).cast("int")).cast("int"))
    hi = F.element_at(arr, (skip + (k / 2).cast("int") + 1).cast("int"))
    return F.when(k == 0, F.lit(None).cast("double")).otherwise((lo + hi) / 2.0)


# Fixed value: the number pattern of the curve CSV files.
RATE_PATTERN = "#.########"


def format_rate(c: Column) -> Column:
    """A rate as text with up to eight decimals and no trailing zeros."""
    return F.call_function("format_number", c, F.lit(RATE_PATTERN))
