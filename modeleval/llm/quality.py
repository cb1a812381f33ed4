"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into half chunks of ``HALF`` bytes; two neighbours make a chunk, so the
chunks overlap by half and cover the whole text. Learned filters of ``WIDTH`` bytes run
over it with a stride of half their width. Their activations are averaged and maximised
in each chunk, a hidden layer reads these, its units are max-pooled over all chunks of
the text and combined into one probability.

Training takes at most ``per_class`` labelled texts of each class, chosen by digest;
scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.llm.common import slices, text_buffers

WIDTH, STRIDE, HALF = 8, 4, 128
FILTERS, HIDDEN = 24, 16
PER_HALF = HALF // STRIDE
MAX_PER_CLASS = 1200


@dataclass
class Network:
    """Weights: filters (WIDTH, 256, FILTERS) over one-hot bytes, then two dense layers."""

    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def f(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(f(WIDTH, 256, FILTERS, scale=0.25), np.zeros(FILTERS, np.float32),
                   f(2 * FILTERS, HIDDEN, scale=0.2), np.full(HIDDEN, 0.1, np.float32), f(HIDDEN, scale=0.3),
                   np.zeros(1, np.float32))

    def params(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]

    # ------------------------------------------------------------------ forward
    def activations(self, codes: np.ndarray) -> np.ndarray:
        """Filter activations of (windows, WIDTH) byte codes."""
        z = np.repeat(self.bias[None], len(codes), 0)
        for k in range(WIDTH):
            z += self.filters[k].take(codes[:, k], axis=0)
        return np.maximum(z, 0, out=z)

    def forward(self, data: np.ndarray, offsets: np.ndarray, block: int = 512) -> dict[str, np.ndarray]:
        """Everything up to the logits of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        size = np.diff(offsets)
        halves = np.maximum(1, -(-size // HALF))
        first = np.concatenate([[0], np.cumsum(halves)])
        row = np.repeat(np.arange(len(size)), halves)
        begin = (np.arange(first[-1]) - first[row]) * HALF
        left = size[row] - begin
        valid = np.clip(-(-left // STRIDE), 0, PER_HALF)
        total, top = np.zeros((len(row), FILTERS), np.float32), np.zeros((len(row), FILTERS), np.float32)
        for lo in range(0, len(row), block):
            part = slice(lo, lo + block)
            a = self.activations(windows(data, offsets[row[part]] + begin[part], left[part])).reshape(-1, PER_HALF, FILTERS)
            a *= (np.arange(PER_HALF) < valid[part, None])[:, :, None]
            total[part], top[part] = a.sum(1), a.max(1)
        # Chunk i is half i with its right neighbour in the same text; a text of one half is one chunk.
        alone = halves == 1
        keep = np.flatnonzero((np.arange(len(row)) < first[1:][row] - 1) | alone[row])
        right = np.where(alone[row[keep]], keep, keep + 1)
        twice = (right != keep).astype(np.float32)[:, None]
        count = np.maximum(1, valid[keep] + valid[right] * twice[:, 0])[:, None]
        features = np.concatenate([(total[keep] + twice * total[right]) / count, np.maximum(top[keep], top[right])], 1).astype(np.float32)
        hidden = np.maximum(features @ self.dense + self.dense_bias, 0)
        chunks = np.concatenate([[0], np.cumsum(np.maximum(1, halves - 1))])
        pooled = np.maximum.reduceat(hidden, chunks[:-1], axis=0) if len(size) else np.zeros((0, HIDDEN), np.float32)
        return dict(row=row, begin=begin, left=left, valid=valid, keep=keep, right=right, count=count, features=features,
                    hidden=hidden, chunks=chunks, pooled=pooled, logits=pooled @ self.out + self.out_bias[0])

    # ----------------------------------------------------------------- backward
    def gradients(self, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        s = self.forward(data, offsets)
        error = ((sigmoid(s["logits"]) - labels) / len(labels)).astype(np.float32)
        d_pooled = np.outer(error, self.out)
        d_hidden = np.zeros_like(s["hidden"])
        for i, (lo, hi) in enumerate(zip(s["chunks"], s["chunks"][1:])):
            best = lo + s["hidden"][lo:hi].argmax(0)
            d_hidden[best, np.arange(HIDDEN)] += d_pooled[i]
        d_hidden *= s["hidden"] > 0
        d_features = d_hidden @ self.dense.T
        # Only chunks that won a hidden unit's maximum pass anything on to the filters.
        won = np.flatnonzero(d_hidden.any(1))
        half = np.concatenate([s["keep"][won], s["right"][won]])
        chunk = np.concatenate([np.arange(len(won))] * 2)
        used = np.concatenate([np.ones(len(won), bool), s["right"][won] != s["keep"][won]])
        half, chunk = half[used], chunk[used]
        codes = windows(data, offsets[s["row"][half]] + s["begin"][half], s["left"][half])
        inside = (np.arange(PER_HALF) < s["valid"][half, None]).ravel()
        codes, chunk = codes[inside], np.repeat(chunk, PER_HALF)[inside]
        a = self.activations(codes)
        g = (d_features[won, :FILTERS] / s["count"][won])[chunk]
        order = np.argsort(chunk, kind="stable")
        cut = np.searchsorted(chunk[order], np.arange(len(won) + 1))
        for i, c in enumerate(won):
            rows = order[cut[i]:cut[i + 1]]
            if len(rows):
                g[rows[a[rows].argmax(0)], np.arange(FILTERS)] += d_features[c, FILTERS:]
        g *= a > 0
        d_filters = np.stack([np.bincount((codes[:, k, None] * np.int64(FILTERS) + np.arange(FILTERS)).ravel(), g.ravel(), 256 * FILTERS)
                              for k in range(WIDTH)]).reshape(WIDTH, 256, FILTERS).astype(np.float32)
        d_bias = g.sum(0)
        return [d_filters, d_bias, s["features"].T @ d_hidden, d_hidden.sum(0), s["pooled"].T @ error, error.sum(keepdims=True)]


def windows(data: np.ndarray, begin: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Byte codes of the windows that start in each half chunk; beyond the text they are 0."""
    step = np.arange(HALF + WIDTH - STRIDE)
    at = begin[:, None] + step
    codes = np.where(step < left[:, None], data.take(at, mode="clip") if len(data) else 0, 0).astype(np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(codes, WIDTH, axis=1)[:, ::STRIDE]
    return view.reshape(-1, WIDTH)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -60, 60)))


def train(texts: list[bytes], labels: list[int], epochs: int = 14, batch: int = 16, rate: float = 5e-3, seed: int = 5) -> Network:
    """Adam over shuffled small batches; the same rows in the same order give the same network."""
    net, rng = Network.fresh(), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.params()]
    second = [np.zeros_like(p) for p in net.params()]
    y, step = np.asarray(labels, np.float64), 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            ids = order[lo:lo + batch]
            data = np.frombuffer(b"".join(texts[i] for i in ids), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in ids])])
            step += 1
            speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, v in zip(net.params(), net.gradients(data, offsets, y[ids]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= speed * m / (np.sqrt(v) + 1e-8) + 1e-5 * p
    return net


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0. A null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> Network:
    """Train on at most ``per_class`` documents of each label that are not held out.

    Rows with a null id or label, and ids labelled both ways, are not used. With one
    class only (or none) the scores are constant: 1 for all-good labels, 0 for all-bad,
    0.5 without any.
    """
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("__y")).filter("y = __y"))
    picked = [usable.filter(F.col("y") == y).select("doc_id", "y", F.xxhash64("doc_id").alias("__h")).orderBy("__h", "doc_id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(picked[0].unionAll(picked[1]).select(F.col("doc_id").alias("__id"), "y"))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).collect())
    rows.sort(key=lambda r: r.doc_id)
    y = [r.y for r in rows]
    if len(set(y)) < 2:
        net = Network.fresh()
        net.out[:] = 0
        net.out_bias[:] = 0 if not y else 60 if y[0] else -60
        return net
    return train([r.text.encode() for r in rows], y)


def score_batch(net: Network, texts: pa.Array) -> np.ndarray:
    data, offsets = text_buffers(texts)
    return sigmoid(net.forward(data, offsets)["logits"])


def score_quality(docs: DataFrame, net: Network, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row: whole texts of any length, repeated
    rows alike; null counts as the empty text, which has a score of its own; an empty table
    gives an empty result."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text"):
                score = score_batch(net, batch.column(2))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    return docs.select(docs[id_col].alias("doc_id"), held_out(docs[id_col]).alias("held_out"), docs[text_col].alias("__text")).mapInArrow(run, schema)


def keep_quality(docs: DataFrame, net: Network, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that score at least ``threshold``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                score = score_batch(net, batch.column(batch.schema.get_field_index(text_col)))
                yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
