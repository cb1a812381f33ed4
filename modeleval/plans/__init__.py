"""Whole pipelines, the eval sets over the test tables, registered queries and their DuckDB SQL."""
