"""Operators for large training corpora: filtering, deduplication, mixing, search.

Nothing else in the package imports this subpackage.
"""
