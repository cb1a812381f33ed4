"""Helpers the corpus operators share: Arrow text buffers, word and shingle hashes, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, longer if a column of ``df`` starts with it."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix += "_"
    return prefix


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[off[0]:off[-1]] if len(off) else data, off - off[0] if len(off) else np.zeros(1, np.int64)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``max_bytes`` of text (one row at least), so that
    the working arrays of a task stay small however many rows Spark puts into a batch."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), np.int64) + 16)
    lo = 0
    while lo < batch.num_rows:
        base = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, base + max_bytes, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    A word is a maximal run of ASCII letters, digits or non-ASCII characters, after
    lower-casing; everything else separates. The hash of a byte run is a polynomial
    over 2^64, read off prefix sums, then mixed.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.is_word = np.zeros(256, bool)
        for lo, hi in ((48, 58), (97, 123), (128, 256)):
            self.is_word[lo:hi] = True
        self.base = np.uint64(_ODD | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 2 * len(self.powers))
            for name, b in (("powers", self.base), ("inverses", self.inverse)):
                a = np.full(size, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def words(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes of all texts in order, offsets of each text's first word)."""
        data, off = text_buffers(pc.utf8_lower(arr))
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
        self._grow(n)
        word = np.zeros(n + 2, bool)
        word[1:-1] = self.is_word[data]
        first, last = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
        inner = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < n)]
        first[inner] |= word[1:-1][inner]
        last[inner - 1] |= word[1:-1][inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.powers[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverses[starts]), np.searchsorted(starts, off)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``size`` words, row of it). A text with fewer words has one shingle of all."""
    n = np.diff(offsets)
    keep = np.maximum(n - size + 1, n > 0)
    row = np.repeat(np.arange(len(n)), keep)
    pos = np.arange(len(row)) + (offsets[:-1] - (np.cumsum(keep) - keep))[row]
    factors = [pow(_ODD, k + 1, 2**64) | 1 for k in range(size)]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total = sum(padded[k:k + len(words)] * np.uint64(f) for k, f in enumerate(factors))[pos] if len(words) else np.zeros(0, np.uint64)
    for i in np.flatnonzero((n > 0) & (n < size)):
        short = [words[offsets[i] + k] if k < n[i] else np.uint64(k + 1) for k in range(size)]
        total[np.searchsorted(row, i)] = sum(int(w) * f for w, f in zip(short, factors)) % 2**64
    return mix(total), row
