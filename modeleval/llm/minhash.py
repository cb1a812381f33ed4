"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles: occurrences times an inverse document
frequency. Improved consistent weighted sampling draws from each set so that two sets
share a draw with a probability equal to their weighted Jaccard similarity; the draws
are banded, texts that share a band are candidates, and a candidate is a link only if
the weighted Jaccard similarity of the whole texts reaches the threshold. Classes are
the connected components of the links, equal texts counted once.

Document frequencies are counted over all documents in a table of ``BUCKETS`` hashed
shingles. With share ``p`` of documents the weight is 1 + ln(p + e) / ln(e), from 2 for
a rare shingle down to 1 for one that every document has; hash collisions are far below
``e``. The table of weights, one byte a bucket, is what tasks share: its size is fixed.

A bucket of a band is never expanded into all its pairs. Its members are compared with
one hub (the member that shares most bands), then buckets that are more than one component
of all links so far go on with ``HUB_GROWTH`` more hubs, and those that still are with the
last ones: every member outside the bucket's largest component. Of two members in different
components one is outside the largest, so no pair that could matter is left out, and a group
of near copies costs rows for the few that have no link yet, not for the whole group. Pairs whose total weights differ by more than the threshold allows are not
compared, since their similarity is at most the ratio of the totals. After the first
round blocks of a bucket's hubs meet parts of its members as sets, about ``PART`` texts of
each in one call, so no row is made for a pair that is no link.

After the first round the members of buckets of more than ``PART`` are dealt anew, by their
rarest shingles: so many that the rest weighs less than the threshold. Two sets that reach
the threshold share one of these (prefix filtering, which is exact), while texts that only
have a common passage part. The buckets of these shingles go through the same rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.llm.common import WordHasher, free_prefix, mix, shingle_hashes, slices
from modeleval.llm.components import connected_components
from modeleval.session import materialize

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 10, 4
BUCKET_BITS, BLOCK_BITS = 22, 16
SMOOTH = 0.01
PAIRS_PER_TASK_GROUP = 64
HUB_GROWTH = 256
PART = 256
SLICE = 1 << 18


def text_key(text) -> F.Column:
    """128 bits of the text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def weighted_shingles(hasher: WordHasher, levels: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of the distinct shingles of each text, sorted by row and hash."""
    hashes, row = shingle_hashes(*hasher.words(texts), SHINGLE)
    # Row and 48 bits of the hash in one number: one plain sort. (A slice has fewer than 2^16 rows.)
    packed = np.sort((row.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    at = np.flatnonzero(np.append(True, packed[1:] != packed[:-1])[:len(packed)])
    times = np.diff(np.append(at, len(packed)))
    row, hashes = (packed[at] >> np.uint64(48)).astype(np.int64), packed[at] << np.uint64(16)
    return row, hashes, times * (1 + levels[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] / 255.0)


# ------------------------------------------------------------ document frequency
def idf_levels(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weight level (0 to 255, for weights 1 to 2) of each hash bucket, from all documents."""
    total = max(1, docs.count())
    blocks = 1 << (BUCKET_BITS - BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = WordHasher(), np.zeros(1 << BUCKET_BITS, np.uint32)
        for whole in batches:
            for batch in slices(whole, "__text", SLICE):
                hashes, row = shingle_hashes(*hasher.words(batch.column(0)), SHINGLE)
                pairs = np.unique((row.astype(np.uint64) << np.uint64(BUCKET_BITS)) | (hashes >> np.uint64(64 - BUCKET_BITS)))
                np.add.at(seen, (pairs & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), np.uint32(1))
        for block in range(blocks):
            part = seen[block << BLOCK_BITS:(block + 1) << BLOCK_BITS]
            at = np.flatnonzero(part)
            if len(at):
                n = part[at]
                kind = np.uint8 if n.max() < 256 else np.uint32
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                                                  pa.array([n.astype(kind).tobytes()], pa.binary())], ["block", "at", "n"])

    def merge(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BLOCK_BITS, np.int64)
        for part in parts:
            for at, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                at = np.frombuffer(at, np.uint16)
                seen[at] += np.frombuffer(n, np.uint8 if len(n) == len(at) else np.uint32)
        share = np.minimum(1.0, seen / total)
        level = np.clip(np.round(255 * np.log(share + SMOOTH) / np.log(SMOOTH)), 0, 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([level.tobytes()], pa.binary())], ["block", "level"])

    counted = docs.select(docs[text_col].alias("__text")).mapInArrow(count, "block long, at binary, n binary")
    levels = np.full(1 << BUCKET_BITS, 255, np.uint8)
    for r in counted.groupBy("block").applyInArrow(merge, "block long, level binary").collect():
        levels[r.block << BLOCK_BITS:(r.block + 1) << BLOCK_BITS] = np.frombuffer(r.level, np.uint8)
    return levels


# ---------------------------------------------------------------------- sampling
class Sampler:
    """Improved consistent weighted sampling, ``BANDS * ROWS`` draws per set.

    For draw j, an element's c (Gamma(2, 1)) and its pair of r (Gamma(2, 1)) and b (uniform)
    come from tables read at bits of its hash times an odd number of the draw. With
    t = floor(ln w / r + b) the element's value is ln a = ln c - r (t + 1 - b); the element
    of the least value is drawn.
    """

    def __init__(self, seed: int = 23):
        rng = np.random.default_rng(seed)
        draws = BANDS * ROWS
        self.odd = rng.integers(0, 2**63, draws, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.r = rng.gamma(2.0, 1.0, 8192).astype(np.float32)
        self.b = rng.random(8192).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, 65536)).astype(np.float32)

    def bands(self, row: np.ndarray, hashes: np.ndarray, weight: np.ndarray, rows: int) -> list[list[int] | None]:
        """The band keys of each row; None for a row without shingles."""
        out: list[list[int] | None] = [None] * rows
        if not len(hashes):
            return out
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        log_w, low = np.log(weight).astype(np.float32), (hashes >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
        keys = np.zeros((len(starts), BANDS), np.uint64)
        over = 1 / self.r
        for j, odd in enumerate(self.odd):
            x = hashes * odd
            pair = ((x >> np.uint64(35)) & np.uint64(8191)).astype(np.intp)
            b = self.b.take(pair, mode="clip")
            value = over.take(pair, mode="clip")
            value *= log_w
            value += b
            np.floor(value, out=value)
            value += 1
            value -= b
            value *= self.r.take(pair, mode="clip")
            np.subtract(self.log_c.take((x >> np.uint64(48)).astype(np.intp), mode="clip"), value, out=value)
            # Floats in order as unsigned numbers; below them the element, so that the least names it.
            bits = value.view(np.int32)
            bits ^= (bits >> 31) & np.int32(0x7FFFFFFF)
            ordered = (bits.astype(np.int64) << 32).view(np.uint64) ^ np.uint64(1 << 63)
            ordered |= low
            drawn = np.minimum.reduceat(ordered, starts)
            keys[:, j // ROWS] = mix(keys[:, j // ROWS] ^ drawn ^ np.uint64(j + 1))
        for i, values in zip(row[starts].tolist(), keys.view(np.int64).tolist()):
            out[i] = values
        return out


def signatures(docs: DataFrame, levels: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, bands, total`` (weight of all shingles) of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("key", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("total", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sampler = WordHasher(), Sampler()
        for whole in batches:
            for batch in slices(whole, "__text", SLICE):
                row, hashes, weight = weighted_shingles(hasher, levels, batch.column(2))
                bands = sampler.bands(row, hashes, weight, batch.num_rows)
                total = np.bincount(row, weight, batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(total)],
                                                 ["doc_id", "key", "bands", "total"])

    text = docs[text_col]
    return docs.select(docs[id_col].alias("doc_id"), text_key(text).alias("key"), text.alias("__text")).mapInArrow(run, schema)


# ------------------------------------------------------------------ verification
def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two weighted sets (sorted distinct hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def verify(pairs: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (``hub, member``, written) whose whole texts reach the threshold, as ``a, b``.

    A hub with many members is split into groups; each gets a copy of the hub's text."""
    sized = pairs.join(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK_GROUP).cast("int").alias("groups")), "hub")
    member = sized.withColumn("part", F.pmod(F.xxhash64("member"), F.col("groups")).cast("int")).join(
        texts, F.col("member") == texts["key"]).select("hub", "part", "member", "text")
    hub = sized.select("hub", "groups").distinct().join(texts, F.col("hub") == texts["key"]).select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(None).cast("binary").alias("member"), "text")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        hasher, frame = WordHasher(), frame.sort_values("member", na_position="first", kind="stable").reset_index(drop=True)
        base, linked = None, []
        for lo in range(0, len(frame), 32):
            part = pa.array(frame.text[lo:lo + 32].tolist(), pa.string())
            row, hashes, weight = weighted_shingles(hasher, levels, part)
            cut = np.searchsorted(row, np.arange(len(part) + 1))
            for i in range(len(part)):
                one = (hashes[cut[i]:cut[i + 1]], weight[cut[i]:cut[i + 1]])
                if base is None:
                    base = one
                elif weighted_jaccard(base, one) >= threshold:
                    linked.append(frame.member[lo + i])
        return pd.DataFrame({"a": [frame.hub[0]] * len(linked), "b": linked})

    return hub.unionByName(member).groupBy("hub", "part").applyInPandas(compare, "a binary, b binary")


def dealt(open_members: DataFrame, chosen: DataFrame) -> DataFrame:
    """``band, part, block, key, comp, is_hub``: a bucket's members in parts of about ``PART``, its
    ``chosen`` hubs (numbered by ``place``) in blocks of ``PART``; each part meets each block."""
    parts, block = F.ceil(F.col("n") / PART).cast("int"), F.floor((F.col("place") - 1) / PART).cast("int")
    blocks = chosen.select("band", block.alias("block")).distinct()
    member = open_members.select("band", F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"), "key", "comp").join(blocks, "band").select(
        "band", "part", "block", "key", "comp", F.lit(False).alias("is_hub"))
    hub = chosen.select("band", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), block.alias("block"),
                        F.col("hub").alias("key"), F.col("hub_comp").alias("comp"), F.lit(True).alias("is_hub"))
    return member.unionAll(hub)


def compare_parts(open_members: DataFrame, chosen: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """Links ``a, b`` between the ``chosen`` hubs of each bucket and its members in other components.

    All are compared; of those within one call only links that join two components are
    returned, so there are fewer of them than members and hubs.
    """
    rows = dealt(open_members, chosen).join(texts.withColumnRenamed("key", "__k"), F.col("key") == F.col("__k")).select(
        "band", "part", "block", "is_hub", "key", F.col("comp.key").alias("comp"), "text")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        hasher, hubs, members, out = WordHasher(), frame[frame.is_hub], frame[~frame.is_hub], []
        joined: dict[int, int] = {}

        def root(comp: int) -> int:
            while comp in joined:
                comp = joined[comp]
            return comp

        if len(hubs) and len(members):
            sets = [_sets(hasher, levels, side.text) for side in (hubs, members)]
            both = shared_weight(*sets, len(hubs), len(members))
            hub_total, total = (np.bincount(s[0], s[2], len(side)) for s, side in zip(sets, (hubs, members)))
            comps = pd.factorize(pd.concat([hubs.comp, members.comp]))[0]
            hub_comp, comp = comps[:len(hubs)], comps[len(hubs):]
            linked = both >= threshold * (hub_total[None, :] + total[:, None] - both)
            hub_keys, keys = hubs.key.tolist(), members.key.tolist()
            for i, j in np.argwhere(linked & (hub_comp[None, :] != comp[:, None])).tolist():
                one, other = root(hub_comp[j]), root(comp[i])
                if one != other:
                    joined[other] = one
                    out.append((hub_keys[j], keys[i]))
        return pd.DataFrame(out, columns=["a", "b"])

    return rows.groupBy("band", "part", "block").applyInPandas(compare, "a binary, b binary")


def shared_weight(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], n_a: int, n_b: int) -> np.ndarray:
    """(n_b, n_a) sums of the lesser weights of what each set of ``b`` has in common with each of
    ``a``, both as (row, hash, weight).

    Shingles that many of both sides have, with one weight, are columns of a matrix product;
    the others are looked up one by one. Both go in pieces, so memory does not grow with the texts.
    """
    both, common = np.zeros((n_b, n_a)), np.intersect1d(a[1], b[1])
    if not len(common):
        return both
    sides = []
    for row, hashes, weight in (a, b):
        keep = np.isin(hashes, common)
        sides.append((row[keep], np.searchsorted(common, hashes[keep]), weight[keep]))
    (a_row, a_at, a_weight), (b_row, b_at, b_weight) = sides
    pairs = np.bincount(a_at, minlength=len(common)) * np.bincount(b_at, minlength=len(common))
    low, high = np.full(len(common), np.inf), np.zeros(len(common))
    for _, at, weight in sides:
        np.minimum.at(low, at, weight)
        np.maximum.at(high, at, weight)
    wide = (low == high) & (32 * pairs >= n_a * n_b)
    column = np.where(wide, np.cumsum(wide) - 1, -1)
    a_column, b_column = column[a_at], column[b_at]
    for lo in range(0, int(wide.sum()), 2048):
        left, right = np.zeros((n_a, 2048)), np.zeros((n_b, 2048))
        mine, own = (a_column >= lo) & (a_column < lo + 2048), (b_column >= lo) & (b_column < lo + 2048)
        left[a_row[mine], a_column[mine] - lo] = 1
        right[b_row[own], b_column[own] - lo] = b_weight[own]
        both += right @ left.T
    mine, own = np.flatnonzero(a_column < 0), np.flatnonzero(b_column < 0)
    mine = mine[np.argsort(a_at[mine], kind="stable")]
    first = np.searchsorted(a_at[mine], np.arange(len(common) + 1))
    many = np.diff(first)[b_at[own]]
    ends = np.cumsum(many)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, 1 << 20):
        piece = slice(*np.searchsorted(ends, [lo, lo + (1 << 20)], "right"))
        n, at = many[piece], own[piece]
        mate = mine[np.repeat(first[b_at[at]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        at = np.repeat(at, n)
        both += np.bincount(b_row[at] * n_a + a_row[mate], np.minimum(b_weight[at], a_weight[mate]), n_a * n_b).reshape(n_b, n_a)
    return both


def _sets(hasher: WordHasher, levels: np.ndarray, texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``weighted_shingles`` of a column of texts, a few at a time."""
    found = []
    for lo in range(0, len(texts), 32):
        row, hashes, weight = weighted_shingles(hasher, levels, pa.array(texts.iloc[lo:lo + 32].tolist(), pa.string()))
        found.append((row + lo, hashes, weight))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def shingle_buckets(members: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """The texts of ``members`` in buckets by their rarest shingles, as ``members`` has them by band.

    Shingles are ordered by the texts that have them, ties by hash; a text goes to the bucket of a
    shingle if that and those after it weigh the threshold's share of the text at least. If two
    texts had no such shingle in common, all they share would weigh less than that for one."""
    own = members.groupBy("key").agg(F.first("total").alias("total"), F.first("rank").alias("rank"), F.max("comp").alias("comp"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                row, hashes, weight = weighted_shingles(hasher, levels, batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(hashes.view(np.int64)), pa.array(weight)], ["key", "shingle", "weight"])

    each = texts.join(own.select("key"), "key", "left_semi").select("key", "text").mapInArrow(split, "key binary, shingle long, weight double")
    each = materialize(each, "near-shingles")
    common = each.join(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"), "shingle")
    onward = F.sum("weight").over(W.partitionBy("key").orderBy(F.col("times").desc(), F.col("shingle").desc()).rowsBetween(W.unboundedPreceding, 0))
    first = common.withColumn("onward", onward).join(own, "key").filter(F.col("onward") >= (threshold - 1e-6) * F.col("total"))
    first = materialize(first.select(F.col("shingle").alias("band"), "key", "total", "rank", "comp"), "near-first")
    sized = first.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(F.col("lo") != F.col("hi"))
    return materialize(first.join(sized.select("band", "n"), "band").select("band", "key", "total", "n", "rank", "comp"), "near-open")


# ----------------------------------------------------------------------- classes
def _place() -> F.Column:
    return F.row_number().over(W.partitionBy("band").orderBy(F.col("rank").desc()))


def last_hubs(open_members: DataFrame, tried: int) -> DataFrame:
    """The members outside their bucket's largest component that are not among its first ``tried``
    ones, as ``dealt`` takes hubs. Places are dealt by hash, about ``PART`` to a block."""
    sizes = open_members.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("c", "comp")).alias("largest"))
    # Spark limits the place before the shuffle, so a bucket sends few rows from each task.
    first = open_members.withColumn("place", _place()).filter(F.col("place") <= tried).groupBy("band").agg(F.min("rank").alias("seen"))
    blocks = F.ceil((F.col("n") - F.col("largest.c")) / PART).cast("int")
    return open_members.join(largest, "band").join(first, "band").filter(
        (F.col("comp") != F.col("largest.comp")) & (F.col("rank") < F.col("seen"))).select(
        "band", "n", (F.pmod(F.xxhash64("key"), blocks) * PART + 1).alias("place"), F.col("key").alias("hub"), F.col("comp").alias("hub_comp"))


def _round(open_members: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float, tried: int) -> tuple[DataFrame, DataFrame]:
    """One round over buckets whose first ``tried`` members have been hubs: the links ``a, b`` found,
    and the rows of buckets with pairs that have not been compared. The rounds have 1, then
    ``HUB_GROWTH`` more, then all hubs that can matter."""
    hubs = tried * HUB_GROWTH + 1  # how many of each bucket have been hubs after this round
    if tried > 1:
        links = compare_parts(open_members, last_hubs(open_members, tried), texts, levels, threshold)
        return materialize(links, "near-links"), open_members.filter(F.lit(False))
    chosen = open_members.withColumn("place", _place()).filter(F.col("place") <= hubs).filter(F.col("place") > tried).select(
        "band", "n", (F.col("place") - tried).alias("place"), F.col("key").alias("hub"), F.col("total").alias("hub_total"), F.col("comp").alias("hub_comp"))
    if tried == 0:
        pairs = open_members.join(chosen.drop("n", "place"), "band").filter(F.col("comp") != F.col("hub_comp")).filter(
            F.least("total", "hub_total") >= (threshold - 1e-6) * F.greatest("total", "hub_total")).select(
            "hub", F.col("key").alias("member")).distinct()
        links = verify(materialize(pairs, "near-pairs"), texts, levels, threshold)
    else:
        links = compare_parts(open_members, chosen, texts, levels, threshold)
    return materialize(links, "near-links"), open_members.filter(F.col("n") > hubs)


def more_components(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components (``key, comp``) of all links so far: of those before, which ``labels`` stands
    for, and new ``links``; None if there are none yet."""
    if links.isEmpty():
        return labels
    return connected_components(links if labels is None else links.unionAll(labels.select(F.col("key").alias("a"), F.col("comp").alias("b"))))


def still_open(left: DataFrame, labels: DataFrame | None, degree: DataFrame) -> DataFrame:
    """The rows of ``left`` in buckets that are more than one component (``labels``) of all links so far.

    Components are whole: a bucket whose members hang together through other buckets is done,
    and none of its texts is sent again. A component is named by its member of highest rank.
    """
    if labels is not None:
        ranked = labels.join(degree, "key").select("key", F.col("comp").alias("label"), F.struct("degree", "key").alias("rank"))
        top = ranked.groupBy("label").agg(F.max("rank").alias("top"))
        named = ranked.join(top, "label").select("key", "top")
        left = left.join(named, "key", "left").select("band", "key", "total", "n", "rank", F.coalesce("top", "comp").alias("comp"))
    left = materialize(left, "near-left")
    split = left.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(F.col("lo") != F.col("hi")).select("band")
    return materialize(left.join(split, "band", "left_semi"), "near-open")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: ``key, first_id`` (its least id), ``class_id`` (the least id in
    its class) and ``class_key`` (the text of that id)."""
    levels = idf_levels(docs, text_col)
    signed = materialize(signatures(docs, levels, id_col, text_col), "near-signed")
    alone = materialize(signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("total").alias("total")), "near-texts")
    banded = alone.select("key", "total", F.posexplode("bands").alias("at", "value")).select("key", "total", F.xxhash64("at", "value").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(banded.join(shared, "band").select("band", "key", "total", "n"), "near-members")
    degree = members.groupBy("key").agg(F.sum("n").alias("degree"))
    # A component is named by its member of highest degree as far as known; ties go to the key.
    open_members = members.join(degree, "key").select("band", "key", "total", "n", F.struct("degree", "key").alias("rank"), F.struct("degree", "key").alias("comp"))
    texts = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).join(degree.select("key"), "key", "left_semi").dropDuplicates(["key"])
    open_members, texts = materialize(open_members, "near-open"), materialize(texts, "near-candidates")

    degree = materialize(degree, "near-degree")
    links, left = _round(open_members, texts, levels, threshold, 0)
    labels = more_components(None, links)
    open_members = still_open(left, labels, degree)
    for large, tried in ((False, 1), (True, 0)):
        if large:
            some = open_members.filter(F.col("n") > PART)
            some = some if some.isEmpty() else shingle_buckets(still_open(some, labels, degree), texts, levels, threshold)
        else:
            some = open_members.filter(F.col("n") <= PART)
        while not some.isEmpty():
            links, left = _round(some, texts, levels, threshold, tried)
            labels = more_components(labels, links)
            some = left if left.isEmpty() else still_open(left, labels, degree)
            tried = tried * HUB_GROWTH + 1

    own = alone.select("key", "first_id")
    if labels is None:
        return own.select("key", "first_id", F.col("first_id").alias("class_id"), F.col("key").alias("class_key"))
    joined = own.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = joined.groupBy("comp").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("m")).select(
        "comp", F.col("m.first_id").alias("class_id"), F.col("m.key").alias("class_key"))
    return joined.join(least, "comp").select("key", "first_id", "class_id", "class_key")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, kept`` for every row of ``docs``: equal class_id, near-duplicates.

    class_id is the least id of the class and ``kept`` marks its rows (repeated rows alike).
    Equal texts are one class whatever their length, null and empty among them; a text of
    fewer than five words has one shingle of all its words, one without words none. Null ids
    are last, so a class of null ids only has a null class_id. An empty table gives none.
    """
    classes = near_classes(docs, threshold, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"))
    return rows.join(classes, "key").select("doc_id", "class_id", (
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, the one with the least id, with all columns of ``docs``."""
    keepers = near_classes(docs, threshold, id_col, text_col).filter(F.col("key") == F.col("class_key")).select(F.struct("key", "class_id").alias("keeper"))
    name = free_prefix(docs, "__near_key")
    own = docs.withColumn(name, text_key(F.col(text_col))).alias("d")
    found = own.join(keepers.alias("k"), (F.col(f"d.{name}") == F.col("k.keeper.key")) & F.col(f"d.`{id_col}`").eqNullSafe(F.col("k.keeper.class_id")), "left_semi")
    return found.dropDuplicates([name]).drop(name)
