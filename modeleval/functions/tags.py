"""Row-level label, weight and meta functions (all built-in column expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_to_empty(c: Column) -> Column:
    """A missing field reads as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


# White space that is trimmed from a target value.
TAG_SPACE = " \t\n\x0b\f\r"


def trim_tag(c: Column, space: str = TAG_SPACE) -> Column:
    """Normalised target value: text, trimmed, missing -> ''."""
    return F.coalesce(F.btrim(c.cast("string"), F.lit(space)), F.lit(""))


def is_tag(tag: Column, tags: Iterable[str]) -> Column:
    values = list(tags)
    if not values:
        return F.lit(False)
    return tag.isin(values)


def binary_tag(tag: Column, pos_tags: Iterable[str]) -> Column:
    """1 for a positive tag, 0 otherwise (applied after the label filter)."""
    return is_tag(tag, pos_tags).cast("int")


def row_weight(weight: Column | None, scale: int) -> Column:
    """``trunc(weight * scale)`` as BIGINT; a constant ``scale`` without a weight column.

    A weight that is missing or not a number fails the task, as a bad weight did
    in the original job: ANSI casts raise on bad text and NULL is raised on here.
    So does a negative one: the sums would no longer rise with the rank.
    """
    if weight is None:
        return F.lit(int(scale)).cast("bigint")
    w = weight.cast("double")
    return (
        F.when(w.isNull(), F.raise_error(F.lit("weight is missing")))
        .when(w < 0, F.raise_error(F.lit("weight is negative")))
        .otherwise((w * F.lit(float(scale))).cast("bigint"))
    )


def likely_weight(value: Column, scale: int) -> Column:
    """What ``row_weight`` gives wherever it does not fail, and 0 elsewhere."""
    return F.coalesce((value.try_cast("double") * F.lit(float(scale))).try_cast("bigint"), F.lit(0).cast("bigint"))


def weight_tag(is_positive: Column, weight: Column) -> Column:
    """The weight for positives, 0 for negatives."""
    return F.when(is_positive, weight).otherwise(F.lit(0).cast("bigint"))


def meta_numeric(c: Column) -> Column:
    """A meta column read as DOUBLE; text that is not a number becomes NULL."""
    return c.cast("string").try_cast("double")
