"""Relational steps of an evaluation: filter, score, label, unpivot, prefix sums, rates, curves, panels."""
