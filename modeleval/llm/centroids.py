"""Centroid clustering over a VA-file.

Vectors become integer components, floor(scale * x). The VA-file holds for each vector a
cell of ``bits`` bits per dimension beside the vector itself. In each round a lookup table
gives, per dimension, cell and centroid, the least and the largest share of the squared
distance that any component of the cell can have (less the vector's own square, which all
centroids have in common). The sums of these shares are an interval for the distance to
each centroid; a centroid stays a candidate if its interval reaches below the least upper
end. Only vectors with more than one candidate are fetched and measured exactly, so
every assignment is exact whatever the cells.

A round is one scan that sends at most one row of sums per centroid and task; the sums of
all tasks are added in Spark, and only centroids x dimensions numbers reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeleval.session import materialize

SAMPLE = 2048
BITS = 6
BLOCK = 4096


def limit(dims: int) -> int:
    """The largest component: squared distances, and sums that lead to them, fit a BIGINT."""
    return math.isqrt((1 << 60) // dims)


def whole_vectors(column: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, components as integers) of the vectors that have ``dims`` finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dims)
    flat = column.take(pa.array(rows)).flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dims)  # a null is NaN here
    good = np.isfinite(x).all(axis=1)
    whole = np.floor(scale * x[good])
    if len(whole) and np.abs(whole).max() > limit(dims):
        raise ValueError(f"a component times {scale:g} is beyond {limit(dims)}; use a smaller scale")
    return rows[good], whole.astype(np.int64)


@dataclass
class Cells:
    """The marks that cut each dimension into cells, and its least and largest component."""

    marks: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) share of each dimension, cell and centroid: c*c - 2*x*c at the cell's ends."""
        dims, k = centroids.shape[1], len(centroids)
        least, most = (np.zeros((dims, max(map(len, self.marks)) + 1, k), np.int64) for _ in range(2))
        for d, marks in enumerate(self.marks):
            first = np.maximum(np.append(self.low[d], marks), self.low[d])
            last = np.maximum(np.minimum(np.append(marks - 1, self.high[d]), self.high[d]), first)
            c = centroids[:, d]
            ends = c * c - 2 * np.stack([first, last])[:, :, None] * c
            least[d, :len(first)], most[d, :len(first)] = ends.min(axis=0), ends.max(axis=0)
        return least, most


def fit_marks(sample: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """Marks at the quantiles of the sample: cells hold about as many vectors each."""
    shares = np.arange(1, 1 << bits) / (1 << bits)
    return [np.unique(np.quantile(column, shares, method="nearest")) if len(column) else np.zeros(0, np.int64) for column in sample.T]


def encode(whole: np.ndarray, marks: Sequence[np.ndarray]) -> np.ndarray:
    """The cell of each component."""
    return np.stack([np.searchsorted(m, column, "right") for m, column in zip(marks, whole.T)], axis=1).astype(np.uint8)


def nearest_centroid(cells: np.ndarray, vectors: np.ndarray, centroids: np.ndarray,
                     tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """(nearest centroid of each row, rows fetched); ties go to the smaller number.

    ``vectors`` is read only where the intervals of several centroids overlap.
    """
    low, high = (np.zeros((len(cells), len(centroids)), np.int64) for _ in range(2))
    for d in range(cells.shape[1]):
        low += tables[0][d][cells[:, d]]
        high += tables[1][d][cells[:, d]]
    candidate = low <= high.min(axis=1, keepdims=True)
    best = candidate.argmax(axis=1)
    open_ = np.flatnonzero(candidate.sum(axis=1) > 1)
    if len(open_):
        x = vectors[open_]
        # Products of whole numbers below 2^53 are exact as doubles, and much faster.
        small = 4 * x.shape[1] * int(np.abs(x).max()) * int(np.abs(centroids).max()) < 1 << 53
        product = (x.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64) if small else x.astype(np.int64) @ centroids.T
        share = (centroids * centroids).sum(axis=1) - 2 * product
        share[~candidate[open_]] = np.iinfo(np.int64).max
        best[open_] = share.argmin(axis=1)
    return best, len(open_)


@dataclass
class Clusters:
    """``assigned``: ``vec_id, cluster, distance``, written; ``centroids``: the final ones."""

    assigned: DataFrame
    centroids: list[list[int]]


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The VA-file in blocks: rows, their cells and (not copied) their vectors."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            block = batch.slice(lo, BLOCK)
            cells, vectors = (np.frombuffer(c.buffers()[2], t)[c.offset * dims:(c.offset + len(c)) * dims].reshape(-1, dims)
                              for c, t in ((block.column(1), np.uint8), (block.column(2), np.int32)))
            yield block, cells, vectors


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: float = 256.0, seed: str = "2",
            bits: int = BITS, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """``rounds`` rounds of assignment and update from ``k`` of the vectors, then a last assignment.

    Kept are the vectors of exactly ``dims`` components, none null or non-finite, as integers
    floor(scale * x) of at most ``limit(dims)`` (a larger one ends the job). The first centroids are
    the kept vectors with the smallest SHA-256 of ``seed:id`` in hex, in that order (rows with
    a null id last, equal ids by their components; all kept vectors if fewer than ``k``). An
    empty centroid stays where it is; another becomes floor(sum / count) of its vectors.
    The cells are fitted on the ``sample`` vectors with the smallest hashes, which decides how
    many vectors are fetched, not the result. Repeated rows count each; other columns are
    not read; an empty table, or no kept vector, gives no rows.
    """
    spark, id_type = rows.sparkSession, rows.schema[id_col].dataType.simpleString()
    own = rows.select(rows[id_col].alias("vec_id"), rows[vector_col].alias("vector"))

    def prepared(batches: Iterator[pa.RecordBatch], marks: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = whole_vectors(batch.column(1), dims, scale)
            vectors = _binary(whole.astype("<i4"))
            columns = [batch.column(0).take(pa.array(kept))] + ([_binary(encode(whole, marks))] if marks else []) + [vectors]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cells", "vector"] if marks else ["vec_id", "vector"])

    finite = (F.size("vector") == dims) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), F.col("vector")]
    first = own.filter(F.coalesce(finite, F.lit(False))).orderBy(*order).limit(max(sample, k)).mapInArrow(
        lambda batches: prepared(batches, None), f"vec_id {id_type}, vector binary").select("vector").collect()
    drawn = np.array([np.frombuffer(r[0], "<i4") for r in first], np.int64).reshape(-1, dims)
    if not len(drawn):
        return Clusters(spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long"), [])
    marks, centroids = fit_marks(drawn, bits), drawn[:k].copy()
    va_file = materialize(own.mapInArrow(lambda batches: prepared(batches, marks), f"vec_id {id_type}, cells binary, vector binary"), "va-file")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, limit(dims), np.int64), np.full(dims, -limit(dims), np.int64)
        for _, _, vectors in _blocks(batches, dims):
            low, high = np.minimum(low, vectors.min(axis=0)), np.maximum(high, vectors.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high)], ["dim", "low", "high"])

    found = va_file.mapInArrow(ends, "dim long, low long, high long").groupBy("dim").agg(F.min("low"), F.max("high")).orderBy("dim").collect()
    cells = Cells(marks, np.array([r[1] for r in found]), np.array([r[2] for r in found]))
    for _ in range(rounds):
        centroids = _updated(va_file, cells, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = cells.tables(centroids)
        for block, cell, vectors in _blocks(batches, dims):
            best, _ = nearest_centroid(cell, vectors, centroids, tables)
            apart = vectors.astype(np.int64) - centroids[best]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(best, pa.int32()), pa.array((apart * apart).sum(axis=1))],
                                             ["vec_id", "cluster", "distance"])

    assigned = materialize(va_file.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long"), "clusters")
    return Clusters(assigned, centroids.tolist())


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _updated(va_file: DataFrame, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, count, total = cells.tables(centroids), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, cell, vectors in _blocks(batches, dims):
            best, _ = nearest_centroid(cell, vectors, centroids, tables)
            count += np.bincount(best, minlength=k)
            np.add.at(total, best, vectors)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(count), pa.array(total.tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "total"])

    parts = va_file.mapInArrow(sums, "cluster long, n long, total array<long>").filter("n > 0")
    added = parts.select("cluster", "n", F.posexplode("total").alias("dim", "part")).groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out = centroids.copy()
    for r in added:
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def inertia_report(found: Clusters) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    assigned = found.assigned
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, found.centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    table = assigned.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
