"""Removal of long repeated byte strings, found with suffix arrays.

Every byte that a ``LENGTH``-byte string covers which also starts elsewhere, in any
document, goes. Each string of ``LENGTH`` bytes (a window) has an anchor: its ``GRAM``-byte
substring of least hash, the leftmost of equals. Equal windows have equal anchors, so
consecutive windows with one anchor (a run) only need comparing with runs of the same
anchor. Runs are grouped by anchor:

1. Anchors are counted over all documents. Those seen once are done: nothing repeats there.
2. Runs with equal anchor and run hashes (two sums of 64 bits over their bytes, not a
   cryptographic digest) count as equal: they repeat as a whole, and the group keeps one
   of them. So thousands of copies of a text weigh as much as one.
3. Runs that share an anchor but differ are suffix-sorted together (``suffixes.py``);
   windows that repeat are neighbours in that order, and are compared symbol by symbol.
   Every window of a run has the whole anchor inside, so the anchor is one symbol there.

Which anchors repeat, and with different runs, is shared with the tasks as two bit tables
of fixed size. They only spare work: an anchor let through in error is dropped later.
An anchor with more than ``MAX_RUNS`` different runs is not sorted in one task: each of its
windows is compared by a digest of all its bytes instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.llm.common import mix, slices, text_buffers
from modeleval.llm.suffixes import suffix_array
from modeleval.session import materialize

LENGTH, GRAM = 200, 100
SLICE = 1 << 18
TABLE_BITS, BLOCK_BITS = 25, 20
SORT_BYTES = 1 << 16
MAX_RUNS = 20_000


class Anchors:
    """Runs of windows that share an anchor, for many texts at once."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, seed: int = 41):
        self.length, self.gram = length, gram
        self.byte = np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            for name, b in (("powers", self.base), ("inverses", self.inverse)):
                a = np.full(max(n + 1, 2 * len(self.powers)), b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Hash of every window of one byte string."""
        self._grow(len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.byte[data] * self.powers[:len(data)], dtype=np.uint64)])
        return mix((sums[self.length:] - sums[:-self.length]) * self.inverses[:max(0, len(sums) - self.length)])

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, first byte in ``data``, windows, anchor hash, hash of the run's bytes, first byte of
        the anchor) of every run."""
        n, span = len(data), self.length - self.gram + 1
        empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
        if n < self.length:
            return empty
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.powers[:n], out=sums[1:])

        def digest(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            return mix((sums[hi] - sums[lo]) * self.inverses[lo])

        at = np.arange(n - self.gram + 1)
        grams = digest(at, at + self.gram)
        # Hash above place: the least is the least hash, the leftmost of equals.
        ranked = ((grams >> np.uint64(32)) << np.uint64(32)) | at.astype(np.uint64)
        full = np.full(-(-len(ranked) // span) * span + span, np.uint64(2**64 - 1))
        full[:len(ranked)] = ranked
        blocks = full.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(blocks, axis=1).ravel()
        windows = n - self.length + 1
        anchor = np.minimum(ahead[:windows], behind[span - 1:span - 1 + windows]) & np.uint64(0xFFFFFFFF)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = row[:windows] == row[self.length - 1:]
        new = np.ones(windows, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:windows] != row[:windows - 1]) | ~inside[:-1]
        first = np.flatnonzero(new & inside)
        after = np.flatnonzero(np.append(new, True) | np.append(~inside, True))
        end = after[np.searchsorted(after, first, "right")]
        place = anchor[first].astype(np.int64)
        # Anchors have small hashes; mixed again they spread over the tables and partitions.
        return row[first], first, end - first, mix(grams[place] ^ self.base), digest(first, end + self.length - 1), place


def _table(keys: DataFrame) -> np.ndarray:
    """A bit for each hash bucket that has one of ``keys`` (column ``anchor``): fixed in size."""
    shift = 64 - TABLE_BITS

    def fill(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BLOCK_BITS, bool)
        for part in parts:
            bits[part.column(1).to_numpy() & ((1 << BLOCK_BITS) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["block", "bits"])

    at = F.shiftrightunsigned("anchor", shift)
    blocks = keys.select(F.shiftright(at, BLOCK_BITS).alias("block"), at.alias("at")).groupBy("block").applyInArrow(fill, "block long, bits binary")
    table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    for r in blocks.collect():
        table[r.block << (BLOCK_BITS - 3):(r.block + 1) << (BLOCK_BITS - 3)] = np.frombuffer(r.bits, np.uint8)
    return table


def _in_table(table: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    at = (anchors >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated_windows(groups: list[list[tuple[bytes, bytes]]], length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """For each run, given as its bytes before and after the anchor of its group, which of its
    windows another place in the group starts too. One suffix array over all groups."""
    span = length - gram + 1  # a window, with the anchor as one symbol
    runs = [(2 + 256 + g, before, after) for g, group in enumerate(groups) for before, after in group]
    sizes = np.array([len(before) + 1 + len(after) for _, before, after in runs], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    # A separator after each run, below all bytes; one end symbol below that.
    symbols = np.ones(int(sizes.sum()) + len(runs) + 1, np.int64)
    symbols[-1] = 0
    valid = np.zeros(len(symbols), bool)
    for start, (anchor, before, after) in zip(starts.tolist(), runs):
        middle = start + len(before)
        symbols[start:middle] = np.frombuffer(before, np.uint8).astype(np.int64) + 2
        symbols[middle] = anchor
        symbols[middle + 1:middle + 1 + len(after)] = np.frombuffer(after, np.uint8).astype(np.int64) + 2
        valid[start:middle + 1 + len(after) - span + 1] = True
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    order = order[valid[order]]
    again = np.zeros(len(symbols), bool)
    views = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.int32), span)
    for lo in range(0, len(order) - 1, 4096):
        a, b = order[lo:lo + 4096][:len(order) - 1 - lo], order[lo + 1:lo + 4097]
        same = (views[a] == views[b]).all(axis=1)
        again[a[same]] = again[b[same]] = True
    return [again[start:start + n - span + 1] for start, n in zip(starts.tolist(), sizes.tolist())]


def _intervals(flags: np.ndarray) -> list[int]:
    """Starts and ends of the runs of set flags, in turn."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.tolist()


class Spans:
    """The three passes over one ``docs`` (columns ``key``, ``text``)."""

    def __init__(self, docs: DataFrame, length: int, gram: int):
        self.docs, self.length, self.gram = docs, length, gram

    def _runs(self, emit, schema: str) -> DataFrame:
        length, gram = self.length, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, seen = Anchors(length, gram), set()
            for whole in batches:
                for batch in slices(whole, "text", SLICE):
                    data, offsets = text_buffers(batch.column(1))
                    found = emit(batch, data, offsets, anchors.runs(data, offsets), seen)
                    if found is not None and found.num_rows:
                        yield found

        return self.docs.mapInArrow(run, schema)

    def anchors(self) -> DataFrame:
        """Per anchor seen more than once: whether its runs differ."""
        def emit(batch, data, offsets, found, seen):
            return pa.RecordBatch.from_arrays([_signed(found[3]), _signed(found[4])], ["anchor", "run"])

        return self._runs(emit, "anchor long, run long").groupBy("anchor").agg(
            F.count(F.lit(1)).alias("n"), (F.min("run") != F.max("run")).alias("differ")).filter("n > 1").select("anchor", "differ")

    def runs(self, repeated: np.ndarray) -> DataFrame:
        """The runs of repeated anchors, by text."""
        def emit(batch, data, offsets, found, seen):
            keep = _in_table(repeated, found[3])
            row, first, size, anchor, run, _ = (x[keep] for x in found)
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(first - offsets[row]), pa.array(size.astype(np.int32)),
                                               _signed(anchor), _signed(run)], ["key", "first", "size", "anchor", "run"])

        return self._runs(emit, "key binary, first long, size int, anchor long, run long")

    def contents(self, differing: np.ndarray) -> DataFrame:
        """The bytes before and after the anchor of the runs whose anchor has different ones; a task
        sends equal runs once."""
        length, gram = self.length, self.gram

        def emit(batch, data, offsets, found, seen):
            keep = np.flatnonzero(_in_table(differing, found[3]))
            if len(seen) > 500_000:
                seen.clear()
            rows = []
            for i in keep.tolist():
                key = (int(found[3][i]), int(found[4][i]))
                if key not in seen:
                    seen.add(key)
                    rows.append(i)
            first, size, place = found[1][rows].tolist(), found[2][rows].tolist(), found[5][rows].tolist()
            before = [data[a:p].tobytes() for a, p in zip(first, place)]
            after = [data[p + gram:a + n + length - 1].tobytes() for a, n, p in zip(first, size, place)]
            return pa.RecordBatch.from_arrays([_signed(found[3][rows]), _signed(found[4][rows]), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                                              ["anchor", "run", "before", "after"])

        return self._runs(emit, "anchor long, run long, before binary, after binary")


def _sorted_groups(length: int, gram: int):
    """Tasks get whole anchors, in order; they are sorted some ``SORT_BYTES`` at a time."""
    def flush(groups: list[list[tuple]]) -> pa.RecordBatch:
        rows = [r for group in groups for r in group]
        found = repeated_windows([[r[2:] for r in group] for group in groups], length, gram)
        out = [(r[0], r[1], _intervals(f)) for r, f in zip(rows, found) if f.any()]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                           pa.array([x[2] for x in out], pa.list_(pa.int32()))], ["anchor", "run", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, group, size, last = [], [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[0][0]:
                    if len(group) > 1:
                        ready.append(group)
                        size += sum(len(r[2]) + len(r[3]) for r in group)
                        if size >= SORT_BYTES:
                            yield flush(ready)
                            ready, size = [], 0
                    group, last = [], None
                if row[1] != last:
                    group.append(row)
                    last = row[1]
        if len(group) > 1:
            ready.append(group)
        if ready:
            yield flush(ready)

    return run


def _windowed(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """For anchors of very many runs: the windows of each run that another run has too, by 128
    bits of each window (its anchor, which all share, left out), counted like any other key."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Anchors(length - gram, 1, 43), Anchors(length - gram, 1, 47)
        for batch in batches:
            for anchor, run, before, after in zip(*(c.to_pylist() for c in batch.columns)):
                # Windows that start at different distances from the anchor differ: the distance is mixed in.
                data = np.frombuffer(before + after, np.uint8)
                far = mix(len(before) - np.arange(len(data) - (length - gram) + 1))
                w1, w2 = one.windows(data) ^ far, two.windows(data) ^ far
                n = len(w1)
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * n), pa.array([run] * n), pa.array(np.arange(n, dtype=np.int32)), _signed(w1), _signed(w2)],
                                                 ["anchor", "run", "at", "w1", "w2"])

    each = contents.dropDuplicates(["anchor", "run"]).mapInArrow(split, "anchor long, run long, at int, w1 long, w2 long")
    twice = each.groupBy("anchor", "w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return each.join(twice, ["anchor", "w1", "w2"]).groupBy("anchor", "run").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list("at")), lambda x: F.array(x, x + 1))).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_runs: int = MAX_RUNS) -> DataFrame:
    """``key, spans`` of the texts that one row only of ``docs`` (``key, text``) has, with repeated
    windows: spans is a list of (first, size, intervals) of runs; null intervals mean the whole
    run. What repeats is judged over all rows; texts that several rows have repeat as a whole."""
    work = Spans(docs, length, gram)
    anchors = materialize(work.anchors(), "suffix-anchors")
    repeated, differing = _table(anchors.select("anchor")), _table(anchors.filter("differ").select("anchor"))
    runs = materialize(work.runs(repeated), "suffix-runs")
    counted = runs.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("n"))
    contents = work.contents(differing)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = materialize(counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")).filter(F.col("runs") > max_runs).select("anchor"), "suffix-hot")
    crowded = not hot.isEmpty()
    tasked = (contents.join(hot, "anchor", "left_anti") if crowded else contents).repartition(parts, "anchor").sortWithinPartitions("anchor", "run")
    sorted_spans = tasked.mapInArrow(_sorted_groups(length, gram), "anchor long, run long, spans array<int>")
    if crowded:
        sorted_spans = sorted_spans.unionAll(_windowed(contents.join(hot, "anchor", "left_semi"), length, gram))
    hits = counted.join(sorted_spans, ["anchor", "run"], "left").filter("n > 1 or spans is not null").select(
        "anchor", "run", F.when(F.col("n") > 1, F.lit(None).cast("array<int>")).otherwise(F.col("spans")).alias("spans"))
    hits = materialize(hits, "suffix-hits")
    # All copies of a text have a run at the same places: as many rows of a place as copies, counted
    # before they meet in a task. So a list holds the runs of one row, however many share a text.
    single = runs.groupBy("key", "first").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("size", "anchor", "run")]).filter("n = 1").drop("n")
    return single.join(hits, ["anchor", "run"]).groupBy("key").agg(F.collect_list(F.struct("first", "size", "spans")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_runs: int = MAX_RUNS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left).

    Texts are whole UTF-8 byte strings, null is empty, and no match crosses documents. Texts
    shorter than ``length`` lose nothing unless a part does, which needs ``length`` bytes. All
    copies of a text of at least ``length`` bytes lose everything. Overlapping repeats inside
    one text count; what repeats is judged on the input. An empty table gives an empty result.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    copies = materialize(rows.filter(F.length(F.encode("text", "utf-8")) >= length).groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "suffix-copies")
    spans = repeated_spans(rows.select("key", "text"), length, gram, max_runs)
    # Copies lose all they have; only single texts have spans, so no list is longer than a text.
    known = copies.join(spans, "key", "left").select("key", "copies", "spans")
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_buffers(batch.column(1))
                out = []
                for i, (copies_, found) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    body = data[offsets[i]:offsets[i + 1]]
                    gone = np.zeros(len(body) + 1, np.int32)
                    if copies_ and copies_ > 1:
                        gone[0] += 1
                    for s in found or ():
                        edges = s["spans"] if s["spans"] is not None else (0, s["size"])
                        for a, b in zip(edges[::2], edges[1::2]):
                            gone[s["first"] + a] += 1
                            gone[s["first"] + b + length - 1] -= 1
                    lost = np.cumsum(gone[:-1]) > 0
                    out.append((len(body), int(lost.sum()), len(_intervals(lost)) // 2, body[~lost].tobytes()))
                yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                 [f.name for f in schema])

    return rows.join(known, "key", "left").select("doc_id", "text", "copies", "spans").mapInArrow(cut, schema)


def digest_kept(cleaned: DataFrame) -> DataFrame:
    """``remove_repeats`` with the remaining bytes as their SHA-256."""
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
