"""Connected components of a link table, by local forests, minimum labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeleval.session import materialize

# Links that one task joins to a forest at once (two keys of 16 bytes each).
FOREST_LINKS = 1 << 16


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b`` for every key of some links: b is the least key that they connect with a."""
    up: dict[bytes, bytes] = {}

    def root(key: bytes) -> bytes:
        end = key
        while up.setdefault(end, end) != end:
            end = up[end]
        while up[key] != end:
            up[key], key = end, up[key]
        return end

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one, other = root(a), root(b)
            if one != other:
                up[max(one, other)] = min(one, other)
    if up:
        yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.binary()), pa.array([root(k) for k in list(up)], pa.binary())], ["a", "b"])


def connected_components(links: DataFrame) -> DataFrame:
    """``key, comp`` for every key in ``links`` (columns ``a, b``): comp is the least key of its component.

    Tasks first reduce about ``FOREST_LINKS`` links each to stars, which say the same with a link
    for each key at most. If one task has all links, these are the components. Otherwise, in each
    round, a node takes the least label among its neighbours and then the label of
    its label, so paths halve. Labels are written each round: lineage stays short and a
    lost executor costs one round. Nothing is collected but two counts.
    """
    links = links.select("a", "b")
    parts = -(-links.count() // FOREST_LINKS)
    dealt = links.coalesce(1) if parts <= 1 else links.repartition(parts)
    stars = materialize(dealt.mapInArrow(forest, "a binary, b binary"), "cc-stars")
    if parts <= 1:
        return stars.select(F.col("a").alias("key"), F.col("b").alias("comp"))
    both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "cc-links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("__m")).select(
        F.col("a").alias("key"), F.least("a", "__m").alias("comp")), "cc-labels")
    while True:
        # One aggregation brings a node its own label and those of its neighbours.
        heard = both.join(labels, both["b"] == labels["key"]).select("a", "comp", F.lit(None).cast("binary").alias("own"))
        step = heard.unionAll(labels.select("key", "comp", F.col("comp").alias("own"))).groupBy("a").agg(F.min("comp").alias("near"), F.max("own").alias("own"))
        # The label's own label: it is a key too, so the join loses nothing.
        jump = labels.select(F.col("key").alias("k"), F.col("comp").alias("far"))
        new = materialize(step.join(jump, F.col("near") == F.col("k")).select(
            F.col("a").alias("key"), F.least("near", "far").alias("comp"), (F.least("near", "far") != F.col("own")).alias("changed")), "cc-labels")
        done = new.filter("changed").isEmpty()
        labels = new.select("key", "comp")
        if done:
            return labels
