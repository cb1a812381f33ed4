"""Approximate nearest neighbours by a forest of hash-prefix arrays.

Each tree gives a vector a long hash string: the signs of ``BITS`` random projections. A
tree is the array of its strings in order, in which all strings with a common prefix are
neighbours. A query descends to the longest prefix it shares with anything in each tree,
then all trees ascend together, one bit at a time, and bring in what shares the shorter
prefix, until the chance that a nearer vector is still out falls below ``miss``: with a
fifth best cosine s, a vector at least that near agrees in a bit with probability
q = 1 - arccos(s) / pi, so all trees miss it with probability (1 - q^depth)^trees.

Equal vectors are one entry with their least ids, so a vector that a third of the rows
share costs one entry. The index is dealt into blocks of bounded size; a block of queries
visits every block of the index and the best of all are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.session import materialize

TREES, BITS, MISS = 96, 32, 0.08
INDEX_BLOCK, QUERY_BLOCK = 16_384, 512


class Forest:
    """Hash strings of unit vectors (rows of ``units``), sorted in each tree."""

    def __init__(self, units: np.ndarray, seed: int = 17):
        self.planes = np.random.default_rng([seed, units.shape[1]]).standard_normal((TREES, units.shape[1], BITS)).astype(np.float32)
        self.units = units
        strings = self.strings(units)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, units: np.ndarray) -> np.ndarray:
        """(TREES, rows) hash strings, the first projection as the highest bit."""
        out = np.zeros((TREES, len(units)), np.uint64)
        x = units.astype(np.float32)
        for t in range(TREES):
            bits = (x @ self.planes[t] >= 0).astype(np.uint64)
            for b in range(BITS):
                out[t] = (out[t] << np.uint64(1)) | bits[:, b]
        return out

    def descend(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, query and prefix length the run (first, end) of entries that share the prefix."""
        shift = np.uint64(BITS) - np.arange(BITS + 1, dtype=np.uint64)
        low = (strings[:, :, None] >> shift) << shift
        first, end = np.empty(low.shape, np.int32), np.empty(low.shape, np.int32)
        for t in range(TREES):
            first[t] = np.searchsorted(self.sorted[t], low[t])
            end[t] = np.searchsorted(self.sorted[t], low[t] + (np.uint64(1) << shift))
        return first, end

    def search(self, unit: np.ndarray, first: np.ndarray, end: np.ndarray, k: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
        """(entries, cosines) of the candidates of one query, from its runs (trees, prefix lengths)."""
        seen = np.zeros(len(self.units), bool)
        ids, scores, have = [], [], 0
        for depth in range(BITS, -1, -1):
            longer = min(depth + 1, BITS)
            grown = np.flatnonzero((end[:, depth] - first[:, depth]) > (end[:, longer] - first[:, longer])) if depth < BITS else range(TREES)
            runs = [self.order[t, first[t, depth]:end[t, depth]] for t in grown]
            if not runs and depth:
                continue
            new = np.concatenate(runs) if runs else np.zeros(0, np.int32)
            new = new[~seen[new]]
            seen[new] = True
            new = np.unique(new)
            if len(new):
                ids.append(new)
                scores.append(self.units[new] @ unit)
                have += len(new)
            if have < k:
                continue
            kth = np.partition(np.concatenate(scores), have - k)[have - k]
            agree = 1 - np.arccos(np.clip(kth, -1, 1)) / np.pi
            if (1 - agree**depth) ** TREES <= miss:
                break
        return (np.concatenate(ids), np.concatenate(scores)) if ids else (np.zeros(0, np.int64), np.zeros(0))


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _entries(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: ``vector, ids`` (its ``keep`` least ids)."""
    # Spark limits the rank before the shuffle, so a vector sends at most ``keep`` ids from each task.
    rank = F.row_number().over(W.partitionBy("key").orderBy("vec_id"))
    least = rows.withColumn("rank", rank).filter(F.col("rank") <= keep)
    return least.groupBy("key").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, miss: float = MISS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` nearest rows of
    ``rows`` by cosine (double precision), but not itself; nearest first, ties to the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do rows with a null id. Repeated rows (same id and vector) count once. Vectors of different
    lengths are never compared. Fewer than k candidates: all of them. An empty table gives none.
    """
    def prepared(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        # Adding zero turns -0.0 into 0.0, so that equal vectors have equal keys.
        own = own.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
        return own.withColumn("key", F.md5(F.array_join(F.col("vector").cast("array<string>"), ","))).dropDuplicates(["vec_id", "key"])

    # A query drops itself, so k + 1 ids of an entry are always enough.
    entries = materialize(_entries(prepared(rows), k + 1).withColumn("size", F.size("vector")), "ann-entries")
    asked = materialize(prepared(queries).select(F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("size")), "ann-queries")
    counts = {r.size: (r.n, r.q) for r in entries.groupBy("size").agg(F.count(F.lit(1)).alias("n")).join(
        asked.groupBy("size").agg(F.count(F.lit(1)).alias("q")), "size").select("size", "n", "q").collect()}
    schema = "query_id long, vec_id long, score double"
    found = None
    for size, (n, q) in sorted(counts.items()):
        index_blocks, query_blocks = -(-n // INDEX_BLOCK), -(-q // QUERY_BLOCK)
        dealt = entries.filter(F.col("size") == size).select(
            F.pmod(F.xxhash64("key"), F.lit(index_blocks)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("j"), "vector", "ids")
        sent = asked.filter(F.col("size") == size).select(
            F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("i"),
            F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("j"), "query_id", "vector")
        part = dealt.groupBy("i", "j").cogroup(sent.groupBy("i", "j")).applyInPandas(_searcher(k, miss), schema)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(k: int, miss: float):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(index) and len(queries):
            vectors, asked = np.stack(index.vector.to_numpy()), np.stack(queries.vector.to_numpy())
            norms, asked_norms = np.linalg.norm(vectors, axis=1), np.linalg.norm(asked, axis=1)
            # Scaled first, since the square of a very large or small component has no finite double.
            forest = Forest(unit_rows(vectors))
            units = unit_rows(asked)
            first, end = forest.descend(forest.strings(units))
            ids = index.ids.to_numpy()
            for row, query_id in enumerate(queries.query_id.tolist()):
                # One entry more, since the query itself may be the whole of the nearest.
                entry, score = forest.search(units[row], first[:, row], end[:, row], k + 1, miss)
                if len(entry) > k + 1:
                    kth = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    top = score >= kth - 1e-9
                    entry, score = entry[top], score[top]
                exact = cosines(vectors[entry], norms[entry], asked[row], asked_norms[row])
                near = [(-s, v) for e, s in zip(entry.tolist(), exact.tolist()) for v in ids[e].tolist() if v != query_id]
                out.extend((query_id, v, -s) for s, v in sorted(near)[:k])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return search


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Of the original vectors, in double precision."""
    bottom = norms * norm
    if np.isfinite(bottom).all() and (bottom > 1e-290).all():
        return (vectors * query).sum(axis=1) / bottom
    return (unit_rows(vectors) * unit_rows(query[None])[0]).sum(axis=1)
