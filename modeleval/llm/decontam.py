"""Benchmark decontamination: random-walk embedding, bit-sampling LSH, exact edit check.

A document is contaminated by a benchmark item if some passage of it is within a share of
the item's words in word edits (insert, delete, replace). Windows that start at each word of
an item and of a document are embedded by the CGK random walk: at each of ``STEPS`` steps
the walk writes down the word under it and moves on if a random bit of (step, word) says so.
Two windows walk by the same bits, so after an edit they fall into step again, and a small
edit distance becomes a small Hamming distance of what they wrote. Bit sampling reads
``SAMPLES`` steps of the embedding as a key; windows of equal keys are candidates.

That is repeated with independent walks. An item is looked for in as many as a window of
its length and edits needs to be found with a chance of ``RECALL``, which is measured on
random edits of each kind (``repetitions``). Items of more than ``LONGEST`` words have a
run of that many words with its share of the edits at most, so they need no more.

A candidate that has too few words of the item to be near it is passed over (that test loses
nothing); the others are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.llm.common import WordHasher, mix, slices

EDIT_SHARE, MIN_WORDS = 0.2, 8
#: Steps of a walk (about half as many words), how many of them make a key, and words that a
#: candidate's windows may be out of step.
STEPS, SAMPLES, SLACK = 12, 4, 2
RECALL, LONGEST, MOST_WALKS, TRIALS = 0.995, 40, 48, 400
TABLE_BITS = 20
MAX_BLOCK_WORDS = 500_000
CHUNK_PAIRS, CHUNK_CELLS = 1 << 18, 1 << 20


@dataclass
class Walk:
    """The windows of all items under one walk, by key: whose each is and where it starts."""

    keys: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    table: np.ndarray


def walk_keys(line: np.ndarray, start: np.ndarray, walk: int) -> np.ndarray:
    """The key of the window at each ``start`` of ``line`` under walk number ``walk``; 0 for one
    that meets a blank (a zero word, which every walk stops at) at a sampled step."""
    rng = np.random.default_rng((17, walk))
    odd = rng.integers(0, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    gap = STEPS // SAMPLES
    sampled = rng.integers(gap) + gap * np.arange(SAMPLES)
    bits = ((line * odd) >> np.uint64(48)).astype(np.uint16)
    at, key, word = start.astype(np.intp), np.zeros(len(start), np.uint64), None
    for step in range(int(sampled[-1]) + 1):
        if step in sampled:
            word = line.take(at)
            key = (key ^ word) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step + 1)
        at += (bits.take(at) >> np.uint16(step)) & np.uint16(1)
    key = mix(key)
    key[word == 0] = 0
    return key


def spread_edits(items: np.ndarray, edits: int, kind: str, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words with ``edits`` edits of one kind at random places: (words, lengths), blanks after."""
    count, n = items.shape
    out = np.zeros((count, n + edits), np.uint64)
    length = np.full(count, n + (edits if kind == "insert" else -edits if kind == "delete" else 0))
    for i, words in enumerate(items):
        at, new = np.sort(rng.choice(n, edits, replace=False)), rng.integers(1, 2**63, edits, dtype=np.uint64)
        if kind == "insert":
            words = np.insert(words, at, new)
        elif kind == "delete":
            words = np.delete(words, at)
        else:
            words = words.copy()
            words[at] = new
        out[i, :len(words)] = words
    return out, length


@lru_cache(maxsize=4096)
def repetitions(n: int, edits: int, recall: float = RECALL) -> int:
    """Walks after which an item of ``n`` words with ``edits`` random edits of the worst kind has
    been a candidate with a chance of ``recall``, over ``TRIALS`` items of random words."""
    if edits == 0:
        return 1
    if n > LONGEST:
        return repetitions(LONGEST, min(LONGEST - 1, -(-edits * LONGEST // n)), recall)
    rng = np.random.default_rng((n, edits))
    items = rng.integers(1, 2**63, (TRIALS, n), dtype=np.uint64)
    need = 1
    for kind in ("insert", "delete", "replace"):
        passages, length = spread_edits(items, edits, kind, rng)
        seen = np.zeros(TRIALS, bool)
        for walk in range(MOST_WALKS):
            row, keys = _row_keys(items, np.full(TRIALS, n), walk)
            other, theirs = _row_keys(passages, length, walk)
            # Words are random, so equal keys are of a pair; the row in the key keeps pairs apart.
            seen[np.intersect1d(row[np.isin(keys, theirs)], other[np.isin(theirs, keys)])] = True
            if seen.mean() >= recall:
                break
        need = max(need, walk + 1)
    return need


def _row_keys(rows: np.ndarray, length: np.ndarray, walk: int) -> tuple[np.ndarray, np.ndarray]:
    line = np.concatenate([rows, np.zeros((len(rows), 1), np.uint64)], axis=1)
    start = np.flatnonzero(np.arange(line.shape[1]) < length[:, None])
    keys = walk_keys(line.ravel(), start, walk)
    return (start // line.shape[1])[keys != 0], keys[keys != 0]


def edit_row(item: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Exact: the least word edits that turn ``item`` into a run of words of each region row that
    ends before each place."""
    step = np.arange(regions.shape[1] + 1)
    row = np.zeros((len(regions), len(step)), np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, :-1] + (regions != word), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step
    return row


class Index:
    """A block of benchmark items, ready for look-up."""

    def __init__(self, texts: list[str], share: float = EDIT_SHARE, min_words: int = MIN_WORDS):
        if not 0 <= share < 1:
            raise ValueError(f"share {share}: an item's edits must be fewer than its words")
        words, offsets = WordHasher().words(pa.array(texts, pa.string()))
        self.words = [words[a:b] for a, b in zip(offsets, offsets[1:])]
        self.allowed = [int(len(w) * share) for w in self.words]
        self.known = [np.unique(w) for w in self.words]
        walks = np.array([repetitions(len(w), a) if len(w) >= max(1, min_words) else 0 for w, a in zip(self.words, self.allowed)], np.int64)
        self.walks = [self._walk(walk, np.flatnonzero(walks > walk)) for walk in range(int(walks.max(initial=0)))]
        self.span = max([len(w) + 4 * a for w, a in zip(self.words, self.allowed)], default=0) + 4 * SLACK

    def _walk(self, walk: int, items: np.ndarray) -> Walk:
        line = np.concatenate([np.append(self.words[i], np.uint64(0)) for i in items.tolist()])
        size = np.array([len(self.words[i]) + 1 for i in items.tolist()])
        offset = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size)
        keys = walk_keys(line, np.arange(len(line)), walk)
        order = np.argsort(keys, kind="stable")
        order = order[keys[order] != 0]
        keys, table = keys[order], np.zeros(1 << TABLE_BITS, bool)
        table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return Walk(keys, np.repeat(items, size)[order], offset[order], table)

    def find(self, hasher: WordHasher, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item, edits, first word) of every text and every item it holds."""
        words, offsets = hasher.words(texts)
        if not self.walks or not len(words):
            return []
        # Texts are set apart by ``span`` blanks, so that no window or region sees two of them.
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        place = np.arange(len(words)) + (row + 1) * self.span
        line = np.zeros(len(words) + len(offsets) * self.span, np.uint64)
        line[place] = words
        found: dict[tuple[int, int], tuple[int, int]] = {}
        near = [(np.zeros(0, np.int64),) * 3]
        for number, walk in enumerate(self.walks):
            keys = walk_keys(line, place, number)
            at = np.flatnonzero(walk.table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            first, last = np.searchsorted(walk.keys, keys[at], "left"), np.searchsorted(walk.keys, keys[at], "right")
            hit = np.flatnonzero(last > first)
            at, first, many = at[hit], first[hit], (last - first)[hit]
            # A key may be that of many items: hits are taken some CHUNK_PAIRS pairs at a time.
            done, lo = np.concatenate([[0], np.cumsum(many)]), 0
            while lo < len(at):
                hi = max(lo + 1, int(np.searchsorted(done, done[lo] + CHUNK_PAIRS, "right")) - 1)
                pick = np.repeat(first[lo:hi] - (done[lo:hi] - done[lo]), many[lo:hi]) + np.arange(done[hi] - done[lo])
                # Where the item's first word would be without edits before the window.
                origin = np.repeat(place[at[lo:hi]], many[lo:hi]) - walk.offset[pick]
                near.append((walk.owner[pick], origin, row[np.repeat(at[lo:hi], many[lo:hi])]))
                if sum(len(n[0]) for n in near) >= CHUNK_PAIRS:
                    self._verify(line, place, offsets, *map(np.concatenate, zip(*near)), found)
                    near = near[:1]
                lo = hi
        self._verify(line, place, offsets, *map(np.concatenate, zip(*near)), found)
        return [(r, i, e, s) for (r, i), (e, s) in sorted(found.items())]

    def _verify(self, line, place, offsets, owner: np.ndarray, origin: np.ndarray, text: np.ndarray, found: dict) -> None:
        """Search the words around each origin for its item; hits a few words apart share a region."""
        if not len(owner):
            return
        order = np.argsort(owner, kind="stable")
        owner, origin, text = owner[order], origin[order], text[order]
        edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(owner)]):
            item = int(owner[lo])
            item_words, extra, known = self.words[item], self.allowed[item], self.known[item]
            begin = place[offsets[text[lo:hi]]]
            block = (origin[lo:hi] - begin) // (extra + 1)
            regions = np.unique(np.stack([text[lo:hi], block]), axis=1)
            # All runs of words that are near the item and hold a window at an origin in the block.
            width = len(item_words) + 3 * extra + 2 * SLACK
            step = max(1, CHUNK_CELLS // width)
            for part in range(0, regions.shape[1], step):
                which, block = regions[:, part:part + step]
                begin = place[offsets[which]]
                left = begin + block * (extra + 1) - extra - SLACK
                around = line[np.clip(left[:, None] + np.arange(width), 0, len(line) - 1)]
                shared = known[np.minimum(np.searchsorted(known, around), len(known) - 1)] == around
                near = np.flatnonzero(shared.sum(1) >= len(item_words) - extra)
                edits = edit_row(item_words, around[near]).min(1)
                near, edits = near[edits <= extra], edits[edits <= extra]
                # Read backwards, the least edits are those of the runs by their first word.
                back = edit_row(item_words[::-1], around[near, ::-1])
                start = np.argmin(back[:, ::-1], axis=1)
                for r, e, s in zip(which[near].tolist(), edits.tolist(), np.maximum(left[near] + start - begin[near], 0).tolist()):
                    found[r, item] = min(found.get((r, item), (e, s)), (e, s))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[list, list[str]]]:
    """The benchmark in blocks of about ``MAX_BLOCK_WORDS`` words: (ids, texts). Each is small
    enough for every task; a benchmark of many blocks is searched in as many passes."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-size // (5 * MAX_BLOCK_WORDS)))
    for i in range(count):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == i).collect()
        rows.sort(key=lambda r: (r.id is None, r.id, r.text))
        yield [r.id for r in rows], [r.text for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, min_words: int = MIN_WORDS,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row and item found in it: ``doc_id, item_id, edits, start_word, n_words``.

    ``edits`` are the least of any passage, ``start_word`` where the first such starts (in words),
    ``n_words`` the item's length; ``edits <= share * n_words``. A passage is missed with a
    chance of 1 - ``RECALL`` at most if it has all the edits allowed, less otherwise; exact copies
    never. Items of fewer than
    ``min_words`` words are never found; null and empty texts hold nothing; whole texts of any
    length are searched; repeated documents and repeated items are reported alike; an empty
    table on either side gives an empty result.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType),
                           T.StructField("edits", T.IntegerType()), T.StructField("start_word", T.IntegerType()), T.StructField("n_words", T.IntegerType())])
    source, result = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("__text")), None
    for ids, texts in blocks(benchmark, item_col, item_text_col):
        found = source.mapInArrow(_finder(Index(texts, share, min_words), ids, schema), schema)
        result = found if result is None else result.unionAll(found)
    return result


def _finder(index: Index, ids: list, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, "__text"):
                hits = index.find(hasher, batch.column(1))
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([h[0] for h in hits])), pa.array([ids[h[1]] for h in hits]),
                         pa.array([h[2] for h in hits], pa.int32()), pa.array([h[3] for h in hits], pa.int32()),
                         pa.array([len(index.words[h[1]]) for h in hits], pa.int32())], [f.name for f in schema])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, min_words: int = MIN_WORDS,
                      text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, in which no item is found."""
    for _, texts in blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_dropper(Index(texts, share, min_words), text_col), docs.schema)
    return docs


def _dropper(index: Index, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, text_col):
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in index.find(hasher, batch.column(batch.schema.get_field_index(text_col)))]] = False
                yield batch.filter(pa.array(keep))

    return run
