"""Scorers and the scoring step.

A scorer turns input rows into one DOUBLE score. Three kinds:

* ``ExprScorer``   a Spark SQL expression or Column (JVM-side, codegen);
* ``LogitScorer``  a linear model behind a logistic link, scaled
                   (``scale / (1 + exp(-(b + sum w_i x_i)))``), also an expression;
* ``PandasScorer`` any vectorised Python model; all of a run share one iterator
                   ``pandas_udf`` that loads them once per task and scores Arrow batches;
* ``SparkMLScorer`` a fitted ``pyspark.ml`` model; its probability of class 1, scaled.

``score_models`` runs them all and adds ``model0 .. model{N-1}`` plus the per-row
statistics ``score_max``, ``score_min``, ``score_avg``, ``score_median``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from modeleval.functions.stats import score_avg, score_max, score_median, score_min
from modeleval.functions.tags import trim_tag


@dataclass(frozen=True)
class ExprScorer:
    """A score given by a column expression."""

    expr: Any  # str (Spark SQL) or Column

    def column(self) -> Column:
        c = F.expr(self.expr) if isinstance(self.expr, str) else self.expr
        return c.cast("double")

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.column())


@dataclass(frozen=True)
class LogitScorer:
    """``scale / (1 + exp(-(intercept + sum w_i * x_i)))``.

    Features are named columns, or positions of one array column
    (``array_col``); the sum runs left to right. ``digits`` rounds the result.
    """

    weights: tuple[float, ...]
    intercept: float = 0.0
    features: tuple[str, ...] = ()
    array_col: str | None = None
    scale: float = 1000.0
    digits: int | None = None

    def linear(self) -> Column:
        if self.array_col is not None:
            # One array literal and a fold: the plan does not grow with the model.
            terms = F.zip_with(F.slice(F.col(self.array_col), 1, len(self.weights)),
                               F.array(*[F.lit(float(w)) for w in self.weights]),
                               lambda x, w: x.cast("double") * w)
            return F.aggregate(terms, F.lit(float(self.intercept)), lambda z, t: z + t)
        else:
            if len(self.features) != len(self.weights):
                raise ValueError("features and weights differ in length")
            terms = [F.col(c).cast("double") * F.lit(float(w))
                     for c, w in zip(self.features, self.weights)]
        z = F.lit(float(self.intercept))
        for t in terms:
            z = z + t
        return z

    def column(self) -> Column:
        s = F.lit(float(self.scale)) / (F.lit(1.0) + F.exp(-self.linear()))
        return F.round(s, self.digits) if self.digits is not None else s

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.column())


@dataclass(frozen=True)
class PandasScorer:
    """A vectorised Python model.

    ``load()`` builds the model once per task; ``predict(model, frame)`` gets a
    pandas DataFrame of the ``inputs`` columns for one Arrow batch and returns
    a Series of scores.
    """

    inputs: tuple[str, ...]
    predict: Callable[[Any, Any], Any]
    load: Callable[[], Any] = field(default=lambda: None)

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        return score_in_python(df, {out: self})


def score_in_python(df: DataFrame, scorers: dict[str, PandasScorer], only: Column | None = None) -> DataFrame:
    """``df`` with one more column per Python model, all scored in one step.

    A task loads every model once and gets the union of their inputs once; rows where
    ``only`` is not true are not given to the models and score NULL.
    """
    inputs = list(dict.fromkeys(c for s in scorers.values() for c in s.inputs))
    models = [(name, s.load, s.predict, list(s.inputs)) for name, s in scorers.items()]

    @pandas_udf(", ".join(f"`{name}` double" for name in scorers))
    def _score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        loaded = [load() for _, load, _, _ in models]
        for columns in batches:
            wanted, frame = columns[0], pd.concat(columns[1:], axis=1, keys=inputs)
            rows = frame if wanted.all() else frame[wanted.to_numpy()]
            scores = {name: pd.Series(predict(model, rows[names]), dtype="float64").to_numpy()
                      for model, (name, _, predict, names) in zip(loaded, models)}
            out = pd.DataFrame(scores, index=rows.index)
            yield out if rows is frame else out.reindex(frame.index)

    together = free_name(df, "_python")
    wanted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    scored = df.withColumn(together, _score(wanted, *[F.col(c) for c in inputs]))
    return scored.withColumns({name: F.col(together)[name] for name in scorers}).drop(together)


@dataclass(frozen=True)
class SparkMLScorer:
    """A fitted ``pyspark.ml`` model: scale times the probability of ``index``."""

    model: Any
    probability_col: str = "probability"
    index: int = 1
    scale: float = 1000.0

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        before = set(df.columns)
        scored = self.model.transform(df)
        prob = vector_to_array(F.col(self.probability_col)).getItem(self.index)
        scored = scored.withColumn(out, prob * F.lit(float(self.scale)))
        added = [c for c in scored.columns if c not in before and c != out]
        return scored.drop(*added)


def as_scorer(s: Any) -> Any:
    """Accept a scorer object, a SQL string or a Column."""
    if isinstance(s, (str, Column)):
        return ExprScorer(s)
    if hasattr(s, "apply"):
        return s
    raise TypeError(f"not a scorer: {s!r}")


def model_names(n: int) -> list[str]:
    return [f"model{i}" for i in range(n)]


def score_models(df: DataFrame, scorers: Sequence[Any], with_stats: bool = True) -> DataFrame:
    """Add ``model0..`` (one per scorer) and, optionally, the per-row statistics.

    Every scorer reads the input columns only: the scores get their names, and replace
    input columns of these names, after all scorers have run.
    """
    names = model_names(len(scorers))
    out, hidden = apply_scorers(df, scorers)
    out = out.withColumns({n: F.col(h) for n, h in zip(names, hidden)}).drop(*hidden)
    if with_stats:
        out = add_score_stats(out, names)
    return out


def apply_scorers(df: DataFrame, scorers: Sequence[Any], only: Column | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with one more column per scorer, under names that no input column has.

    Expressions and Python models are evaluated only on the rows where ``only`` is true
    (a fitted ``pyspark.ml`` model on all); all Python models share one step.
    """
    if not scorers:
        raise ValueError("at least one scorer is needed")
    prefix = free_name(df, "_score")
    hidden = [f"{prefix}{i}" for i in range(len(scorers))]
    named = dict(zip(hidden, map(as_scorer, scorers)))
    ready = {h: s.column() for h, s in named.items() if hasattr(s, "column")}
    if only is not None:
        ready = {h: F.when(only, c) for h, c in ready.items()}
    out = df.withColumns(ready) if ready else df
    in_python = {h: s for h, s in named.items() if isinstance(s, PandasScorer)}
    if in_python:
        out = score_in_python(out, in_python, only)
    for h, s in named.items():
        if h not in ready and h not in in_python:
            out = s.apply(out, h)
    return out, hidden


def free_name(df: DataFrame, prefix: str) -> str:
    """``prefix``, longer if a column of ``df`` starts with it."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def add_score_stats(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``score_max``, ``score_min``, ``score_avg``, ``score_median`` of the named scores."""
    return df.withColumns(score_stats([F.col(n) for n in names]))


def score_stats(cols: Sequence[Column]) -> dict[str, Column]:
    cols = list(cols)
    return {"score_max": score_max(cols), "score_min": score_min(cols), "score_avg": score_avg(cols),
            "score_median": score_median(cols)}


def score_multiclass(df: DataFrame, spec: Any) -> DataFrame:
    """Multi-class scoring: ``scores`` array, trimmed ``tag`` and text meta; no label filter.

    The original looked meta values up under the wrong key and so emitted none;
    this keeps them as ``meta_<column>`` strings, which is what it meant to do.
    """
    scored, names = apply_scorers(df, spec.scorers)
    keys = [F.col(k) for k in spec.row_key]
    meta = [F.col(c).cast("string").alias(f"meta_{c}") for c in spec.meta_cols]
    return scored.select(
        *keys,
        F.array(*[F.col(n) for n in names]).alias("scores"),
        *meta,
        trim_tag(F.col(spec.target)).alias("tag"),
    )
