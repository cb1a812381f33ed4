"""Row filter over the input columns (the "purifier").

The condition is a Spark SQL boolean expression over the input columns, which
for text input are all STRING; use ``try_cast`` for numbers so a bad value makes
the row fail the test (dropped) instead of failing the job. Rules:

* no condition, or a blank one: every row passes untouched;
* a condition that does not parse: every row passes (``on_invalid='keep'``,
  the original behaviour) or an error (``'error'``, our default);
* a row where the condition is false or NULL is dropped;
* a row on which it cannot be evaluated (text where a number is needed, an overflow, a
  division by zero) fails the job (``on_row_error='error'``, our default) or is dropped
  (``'drop'``, the original). ANSI rules hold in both, and no session setting changes;
* a column ``space::name`` can also be called ``name``, if nothing else has that name;
* an unknown column or a non-boolean condition is always an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from modeleval.sources.text import skip_header, split_fields


def parse_condition(df: DataFrame, condition: str | None, on_invalid: str = "error") -> Column | None:
    """The condition as a boolean Column over ``df``, or None when every row should pass.

    Parsing happens when the plan is analysed, so the check runs against ``df``:
    a syntax error keeps every row (``on_invalid='keep'``) or raises; an unknown
    column or a non-boolean result always raises.
    """
    if condition is None or not condition.strip():
        return None
    cond = F.expr(condition)
    try:
        dtype = df.select(cond.alias("_keep")).schema["_keep"].dataType
    except ParseException:
        if on_invalid == "keep":
            return None
        raise
    if not isinstance(dtype, BooleanType):
        raise ValueError(f"filter condition is not boolean: {condition!r}")
    return cond


def simple_names(columns: Sequence[str]) -> dict[str, str]:
    """Short name -> column, for each ``space::name`` whose short name nothing else has."""
    short = {c: c.rsplit("::", 1)[1] for c in columns if "::" in c}
    taken = Counter(short.values()) + Counter(columns)
    return {s: c for c, s in short.items() if s and taken[s] == 1}


def _true_without_error(df: DataFrame, cond: Column, condition: str) -> Column:
    """True where ``cond`` is; not where it is false, NULL or cannot be evaluated.

    ``try_to_binary`` gives NULL for whatever its input raises. The branch keeps parts of the
    condition from being computed ahead of it. The columns that the condition names are read
    first, outside of it, so that errors from before the filter still end the job.
    """
    tried = F.try_to_binary(F.when(F.spark_partition_id() >= 0, cond.cast("string")), F.lit("utf-8"))
    kept = tried == F.encode(F.lit("true"), "utf-8")
    text = condition.lower()
    named = [f"`{c}`" for c, t in df.dtypes if c.lower() in text and "map<" not in t and "variant" not in t]
    return (F.xxhash64(*named) >= F.lit(-(2**63)).cast("bigint")) & kept if named else kept


def purify(df: DataFrame, condition: str | None, on_invalid: str = "error",
           on_row_error: str = "error") -> DataFrame:
    """Keep the rows for which ``condition`` is true (false and NULL drop the row)."""
    if on_row_error not in ("error", "drop"):
        raise ValueError(f"unknown row-error policy {on_row_error!r}")
    extra = simple_names(df.columns)
    named = df.withColumns({s: F.col(f"`{c}`") for s, c in extra.items()}) if extra else df
    cond = parse_condition(named, condition, on_invalid)
    if cond is None:
        return df
    if on_row_error == "drop":
        cond = _true_without_error(named, cond, condition)
    return named.filter(cond).drop(*extra)


def purify_lines(lines: DataFrame, headers: Sequence[str], delimiter: str,
                 condition: str | None, on_invalid: str = "error",
                 has_header: bool = True, on_short_row: str = "error",
                 on_row_error: str = "error") -> DataFrame:
    """Filter raw text lines by a condition over their named fields; lines come out unchanged.

    As in the original job, a set condition also drops the header, the first line of each
    file (``lines`` comes from ``scan_text`` then); with no condition the input passes
    through untouched.
    """
    if condition is None or not condition.strip():
        return lines
    body = skip_header(lines) if has_header else lines
    parsed = split_fields(body, headers, delimiter, on_short_row=on_short_row, keep_line=True)
    kept = purify(parsed, condition, on_invalid, on_row_error)
    # Not parsable: all lines pass but headers, and unparsed, so no short row can matter.
    return body.select("value") if kept is parsed else kept.select("value")


def purifier(condition: str | None, on_invalid: str = "error",
             on_row_error: str = "error") -> Callable[[DataFrame], DataFrame]:
    """A filter callable for ``df.transform`` (the purifier extension point)."""
    def apply(df: DataFrame) -> DataFrame:
        return purify(df, condition, on_invalid, on_row_error)
    return apply
