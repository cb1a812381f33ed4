"""Evaluation settings.

One frozen dataclass carries what the job needs to know about an eval set: which
column is the target, which tag values are positive or negative, how rows are
weighted, which scorers to run, which columns travel along as meta data and how
the performance tables are cut into curve points.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

# Fixed defaults. The values the original job used live in a library outside the
# reference tree, so these are our own choices and every one is a parameter.
DEFAULT_WEIGHT_SCALE = 1000
DEFAULT_SCORE_SCALE = 1000.0
DEFAULT_BUCKETS = 10
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000

POLICIES_ON_INVALID = ("error", "keep")
POLICIES_SHORT_ROW = ("error", "null", "drop")
POLICIES_MISSING_SCORE = ("error", "drop")
POLICIES_ROW_ERROR = ("error", "drop")
PREFIX_METHODS = ("range", "window")


@dataclass(frozen=True)
class EvalSpec:
    """Everything an evaluation run needs besides the data.

    target            column holding the label (any type; compared as trimmed text)
    pos_tags/neg_tags tag values counted as positive / negative; others are unlabelled
    row_key           columns that make a row unique; they break score ties
    scorers           scorer objects (see ``operators.scoring``); produce model0..
    weight_col        optional weight column; weight = trunc(value * weight_scale)
    meta_cols         columns carried to the score output: ``meta_<c>`` DOUBLE, text for multi-class
    score_meta_cols   numeric meta columns that get their own performance series
    buckets           B, the number of buckets a curve metric is cut into
    condition         optional row filter (Spark SQL boolean expression)
    multiclass        True selects the multi-class scoring path (no reports)
    on_row_error      what a row does on which the condition fails: the job ends, or it is dropped
    prefix_partitions range partitions; None derives them from the written score table's size
    max_broadcast_rows  offsets (partitions x series) are broadcast up to so many rows, else joined
    """

    target: str
    pos_tags: tuple[str, ...]
    neg_tags: tuple[str, ...]
    row_key: tuple[str, ...]
    scorers: tuple[Any, ...] = ()
    weight_col: str | None = None
    weight_scale: int = DEFAULT_WEIGHT_SCALE
    meta_cols: tuple[str, ...] = ()
    score_meta_cols: tuple[str, ...] = ()
    buckets: int = DEFAULT_BUCKETS
    condition: str | None = None
    on_invalid: str = "error"
    on_short_row: str = "error"
    on_missing_score: str = "error"
    prefix_method: str = "range"
    prefix_partitions: int | None = None
    thin: bool = False
    multiclass: bool = False
    on_row_error: str = "error"
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS

    def __post_init__(self) -> None:
        object.__setattr__(self, "pos_tags", tuple(str(t) for t in self.pos_tags))
        object.__setattr__(self, "neg_tags", tuple(str(t) for t in self.neg_tags))
        object.__setattr__(self, "row_key", tuple(self.row_key))
        object.__setattr__(self, "scorers", tuple(self.scorers))
        object.__setattr__(self, "meta_cols", tuple(self.meta_cols))
        object.__setattr__(self, "score_meta_cols", tuple(self.score_meta_cols))
        if self.on_invalid not in POLICIES_ON_INVALID:
            raise ValueError(f"on_invalid must be one of {POLICIES_ON_INVALID}")
        if self.on_short_row not in POLICIES_SHORT_ROW:
            raise ValueError(f"on_short_row must be one of {POLICIES_SHORT_ROW}")
        if self.on_missing_score not in POLICIES_MISSING_SCORE:
            raise ValueError(f"on_missing_score must be one of {POLICIES_MISSING_SCORE}")
        if self.on_row_error not in POLICIES_ROW_ERROR:
            raise ValueError(f"on_row_error must be one of {POLICIES_ROW_ERROR}")
        if self.prefix_method not in PREFIX_METHODS:
            raise ValueError(f"prefix_method must be one of {PREFIX_METHODS}")
        if self.buckets < 1:
            raise ValueError("buckets must be >= 1")
        if not self.row_key:
            raise ValueError("row_key must name at least one column")
        overlap = set(self.pos_tags) & set(self.neg_tags)
        if overlap:
            raise ValueError(f"tags both positive and negative: {sorted(overlap)}")

    @property
    def model_count(self) -> int:
        return len(self.scorers)

    @property
    def weight_from(self) -> tuple[str, int] | None:
        """The row key column, and the scale, that give the weights, if the weight column is one."""
        return (self.weight_col, self.weight_scale) if self.weight_col in self.row_key else None

    def with_(self, **changes: Any) -> "EvalSpec":
        return replace(self, **changes)
