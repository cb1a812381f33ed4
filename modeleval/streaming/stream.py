"""Structured Streaming forms of the row-level steps.

The original job is batch only. Filtering, scoring, labelling and the
counters are row-level or plain aggregates, so the same functions run on a
streaming DataFrame unchanged; these helpers wire them to ``writeStream``
with checkpoints on the shared folder. The sort-based reports (perf rows,
curves) need the whole population and stay batch jobs over the saved scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from modeleval.operators.labels import run_counters, scored_output
from modeleval.plans.evaluate import score
from modeleval.session import scratch_path
from modeleval.spec import EvalSpec


def score_stream(stream: DataFrame, spec: EvalSpec) -> DataFrame:
    """Filtered, scored, labelled rows of a stream (labelled rows only)."""
    if spec.multiclass:
        raise ValueError("streaming scoring covers the binary path")
    return scored_output(score(stream, spec))


def counters_stream(stream: DataFrame, spec: EvalSpec) -> DataFrame:
    """Running counters over everything seen so far (use output mode ``complete``)."""
    return run_counters(score(stream, spec))


def write_scores_stream(scored: DataFrame, path: str, checkpoint: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Append score rows to Parquet; the checkpoint makes restarts exactly-once."""
    spark = scored.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    writer = (scored.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_counters_stream(counters: DataFrame, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Keep the running counters in an in-memory table ``name`` (complete mode)."""
    spark = counters.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    return (counters.writeStream.format("memory").queryName(name)
            .option("checkpointLocation", checkpoint).outputMode("complete")
            .trigger(availableNow=True).start())
