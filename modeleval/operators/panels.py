"""Chart panels as tables: (chart, panel, series, seq, y, x, tips, score).

The original wrote these rows into HTML pages. Here each panel is a projection
of a curve; the rates are shown in percent, the score as it is. Three fixes to
the gain chart, all documented: on the score-axis panels (4, 5) x is the score
itself, not the score times 100; panel 5 shows the unit-wise recall its title
promises; panel 6 is the score histogram (``score_histogram``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeleval.functions.safe import to_int

# Panel number, source curve and the metric behind each column.
# Gain panels: y, x, tip1, tip2, tip3, score.
GAIN_PANELS = (
    (0, "weight_gain", ("weight_recall", "weight_action_rate", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (1, "weight_gain", ("recall", "weight_action_rate", "weight_action_rate", "precision", "action_rate", "score")),
    (2, "gain", ("weight_recall", "action_rate", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (3, "gain", ("recall", "action_rate", "weight_action_rate", "precision", "action_rate", "score")),
    (4, "score", ("weight_recall", "score", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (5, "score", ("recall", "score", "weight_action_rate", "weight_precision", "action_rate", "score")),
)
# PR / ROC panels: y, x, tip1, tip2, tip3, tip4, score.
PR_ROC_PANELS = (
    (0, "weight_recall", ("weight_precision", "weight_recall", "weight_precision", "weight_recall", "weight_fpr", "weight_action_rate", "score")),
    (1, "weight_recall", ("precision", "weight_recall", "precision", "weight_recall", "weight_fpr", "weight_action_rate", "score")),
    (2, "recall", ("weight_precision", "recall", "weight_precision", "recall", "fpr", "action_rate", "score")),
    (3, "recall", ("precision", "recall", "precision", "recall", "fpr", "action_rate", "score")),
    (4, "weight_roc", ("weight_recall", "weight_fpr", "weight_recall", "weight_fpr", "weight_precision", "weight_recall", "score")),
    (5, "weight_roc", ("recall", "weight_fpr", "weight_precision", "recall", "weight_fpr", "weight_action_rate", "score")),
    (6, "roc", ("weight_recall", "fpr", "precision", "weight_recall", "fpr", "action_rate", "score")),
    (7, "roc", ("recall", "fpr", "precision", "recall", "fpr", "action_rate", "score")),
)
PANEL_COLS = ("chart", "panel", "series", "seq", "y", "x", "tip1", "tip2", "tip3", "tip4", "score")


def _pct(name: str) -> "F.Column":
    c = F.col(name).cast("double")
    return c if name == "score" else c * F.lit(100.0)


def _panels(points: DataFrame, chart: str, table: tuple) -> DataFrame:
    """All panels of a chart in one pass: each point row fans out to the panels
    drawn from its curve (``explode`` of the matching panel structs)."""
    names = PANEL_COLS[4:10]
    choices = []
    for panel, curve, keys in table:
        vals = [_pct(k) for k in keys[:-1]]
        while len(vals) < len(names):
            vals.append(F.lit(None).cast("double"))
        row = F.struct(F.lit(panel).alias("panel"), *[v.alias(n) for v, n in zip(vals, names)],
                       F.col(keys[-1]).cast("double").alias("score"))
        choices.append(F.when(F.col("curve") == F.lit(curve), row))
    fanned = points.select("series", "seq",
                           F.explode(F.array_compact(F.array(*choices))).alias("_p"))
    return fanned.select(F.lit(chart).alias("chart"), "_p.panel", "series", "seq",
                         *[f"_p.{n}" for n in names], "_p.score")


def gain_panels(points: DataFrame) -> DataFrame:
    """Gain chart panels 0-5 from a points table holding the needed curves."""
    return _panels(points, "gain", GAIN_PANELS)


def pr_roc_panels(points: DataFrame) -> DataFrame:
    """Precision-recall (0-3) and ROC (4-7) panels."""
    return _panels(points, "pr_roc", PR_ROC_PANELS)


def score_histogram(long_or_perf: DataFrame) -> DataFrame:
    """Rows per series and integer score (gain panel 6, "Score Count")."""
    return (long_or_perf.groupBy("series", to_int(F.col("score")).alias("score_bin"))
            .agg(F.count(F.lit(1)).alias("records")))
