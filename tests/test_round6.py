"""The sum step leaves row keys in the JVM; the performance step gives what is read only."""

import pytest

from modeleval.operators import prefix
from modeleval.operators.performance import perf_rows

LONG = "series string, score double, row_id long, tag int, weight long, weight_tag long"


def rows_of(spark):
    rows = [(s, float(i * 7 % 50), i, i % 2, i % 5, (i % 2) * (i % 5)) for s in ("a", "b") for i in range(300)]
    return spark.createDataFrame(rows, LONG).repartition(5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_keys_stay_out_of_the_sum_step(spark, monkeypatch):
    written = []
    keep = prefix.materialize
    monkeypatch.setattr(prefix, "materialize", lambda df, *a: (written.append(df), keep(df, *a))[1])
    table = prefix.local_sums_table(rows_of(spark), ["row_id"], 6, ["a", "b"])
    step = next(line for line in plan(written[0]).splitlines() if "InArrow" in line or "ArrowEvalPython" in line)
    assert "ArrowEvalPython" in step and "row_id" not in step
    assert table.count() == 600


@pytest.mark.parametrize("batch", [1, 7])
def test_sums_across_batches(spark, batch):
    """State goes on from batch to batch; the last row of a batch knows the first of the next."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        found = prefix.prefix_sums(rows_of(spark), ["row_id"], partitions=3, series_names=["a", "b"]).collect()
    finally:
        spark.conf.set(name, before)
    for s in ("a", "b"):
        rows = sorted((r for r in found if r.series == s), key=lambda r: (r.score, r.row_id))
        assert [r.cum_records for r in rows] == list(range(300))
        assert [r.cum_weight for r in rows] == [sum(x.weight for x in rows[:i]) for i in range(300)]
        assert [r.prev_score for r in rows] == [None, *[r.score for r in rows[:-1]]]
        assert [r.next_score for r in rows] == [*[r.score for r in rows[1:]], None]


def test_outputs_that_are_not_read_are_not_computed(spark):
    """A query of ranks or weights alone gets no rates from the performance step."""
    found = prefix.running_sums(rows_of(spark), ["row_id"], partitions=3, series_names=["a", "b"])
    perf = perf_rows(found, ["row_id"], 10)
    for cols in (["current_record"], ["tp", "fp"], ["weight_tp", "weight_fp"]):
        shown = plan(perf.select("series", "row_id", *cols))
        assert shown.count("ArrowEvalPython") == 1 and "precision" not in shown
    shown = plan(perf.select("current_record", "tp", "weight_tp", "recall"))
    assert shown.count("ArrowEvalPython") == 1
