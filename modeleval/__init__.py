"""modeleval: measure classification models on large tables with PySpark.

    from modeleval import EvalSpec, evaluate
    out = evaluate(df, EvalSpec(...))   # counters, scores, perf, points, panels
"""

import sys

from pyspark import cloudpickle

from modeleval.operators.scoring import ExprScorer, LogitScorer, PandasScorer, SparkMLScorer
from modeleval.plans.evaluate import evaluate, evaluate_text, score
from modeleval.spec import EvalSpec

__all__ = ["EvalSpec", "ExprScorer", "LogitScorer", "PandasScorer", "SparkMLScorer",
           "evaluate", "evaluate_text", "score"]

# Functions that run inside tasks are pickled whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
