"""Inputs (delimited text) and outputs (score, perf, sorted, filtered, curve CSV)."""
