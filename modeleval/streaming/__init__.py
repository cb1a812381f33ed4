"""Streaming forms of the row-level steps (scoring, labels, counters)."""

from modeleval.streaming.stream import (
    counters_stream, score_stream, write_counters_stream, write_scores_stream,
)

__all__ = ["counters_stream", "score_stream", "write_counters_stream", "write_scores_stream"]
