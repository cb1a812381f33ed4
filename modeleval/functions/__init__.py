"""Column-expression helpers (all JVM-side, codegen friendly)."""

from modeleval.functions.safe import bucket_of, to_int, weight_sum
from modeleval.functions.stats import (
    format_rate,
    score_avg,
    score_max,
    score_median,
    score_min,
)
from modeleval.functions.tags import (
    binary_tag,
    is_tag,
    meta_numeric,
    null_to_empty,
    row_weight,
    trim_tag,
    weight_tag,
)

__all__ = [
    "binary_tag", "bucket_of", "format_rate", "is_tag", "meta_numeric", "null_to_empty",
    "row_weight", "score_avg", "score_max", "score_median",
    "score_min", "to_int", "trim_tag", "weight_sum", "weight_tag",
]
