"""Alignment of two tokenizers' tokens over the bytes of each text.

Both token sequences cover the same bytes (a space and the text). Every token points to
the farthest-right token of the other sequence that overlaps it, unless none reaches
beyond its own end: then it is the terminal token of its group. Doubling the successors
(``step = step[step]``, all tokens of a batch at once) makes every token point to the
terminal token of its component, which is the label of its group. A group ends where
both sequences end a token; the two tokens that end there are linked.

Two linked tokens end at the same byte, so the shorter one is a suffix of the longer:
the pairs that can ever occur are bounded by the two vocabularies alone
(``possible_pairs``), whatever the corpus. That table of counts is what is sent to tasks.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.llm.common import slices
from modeleval.llm.tokens import PRE_TOKEN, byte_alphabet
from modeleval.session import materialize

# Working arrays take 50 times the bytes of the texts and more: so much text, and so many links, at a time.
SLICE = 256 << 10
LINKS_AT_A_TIME = 1 << 16
# What a writer of links holds back before it writes a row group.
ROW_GROUP_BYTES = 16 << 20
LINKS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("times", T.LongType())]))


class ByteLevel:
    """A byte-level BPE file (``.json``); special strings in a text are plain text."""

    leads_with_space = False

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        back = {c: b for b, c in enumerate(byte_alphabet())}
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.pieces = [b""] * size
        for t in spec["added_tokens"]:
            self.pieces[t["id"]] = t["content"].encode("utf-8")
        for token, i in vocab.items():
            if all(c in back for c in token):
                self.pieces[i] = bytes(back[c] for c in token)
        self.path, self.spec = path, spec

    def load(self) -> "ByteLevel":
        if self.spec is not None:  # tens of MB, read once
            self.fast, self.library, self.spec = self._ranked(), None, None
        return self

    def _ranked(self):
        """The same encoding from ranks, where ids follow the order of the merges; else None."""
        spec, vocab = self.spec, self.spec["model"]["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if spec.get("normalizer") or spec["pre_tokenizer"] != plain or any(vocab.get("".join(p)) != 256 + i for i, p in enumerate(pairs)):
            return None
        import tiktoken

        added = {t["id"] for t in spec["added_tokens"]}
        ranks = {self.pieces[i]: i for i in vocab.values() if i not in added}
        return tiktoken.Encoding("ranked", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [" " + t for t in texts]
        if self.fast is not None:
            try:
                return [self.fast.encode_ordinary(t) for t in texts]
            except (RuntimeError, ValueError):  # the pattern matcher's limits on an extreme text
                pass
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.encode_special_tokens = True
        return [self.library.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """A sentencepiece model (``.model``), which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.path = path
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode("utf-8")
                       for i in range(model.get_piece_size())]
        self.model = model

    def load(self) -> "Pieces":
        return self

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def tokenizer(path: str) -> ByteLevel | Pieces:
    """The tokenizer of a vocabulary file, with the bytes of every id in ``pieces``."""
    if path.endswith(".json"):
        return ByteLevel(path)
    if path.endswith(".model"):
        return Pieces(path)
    raise ValueError(f"not a .json or .model file: {path}")


@lru_cache(maxsize=4)
def possible_pairs(path_a: str, path_b: str) -> int:
    """How many (a, b) exist of which one's bytes are a suffix of the other's: the most
    different pairs that any corpus can link."""
    a, b = Counter(tokenizer(path_a).pieces), Counter(tokenizer(path_b).pieces)
    a.pop(b"", None)
    b.pop(b"", None)
    longer_a = sum(n * b[p[k:]] for p, n in a.items() for k in range(len(p)))
    longer_b = sum(n * a[p[k:]] for p, n in b.items() for k in range(1, len(p)))
    return longer_a + longer_b


def terminals(end_a: np.ndarray, end_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(step, to_a): the terminal token of every token, b's first and then a's, and the
    farthest-right a token that overlaps each b token. Terminal tokens are b's."""
    n_b = len(end_b)
    to_a = np.searchsorted(start_a, end_b) - 1
    to_b = np.searchsorted(start_b, end_a) - 1
    step = np.concatenate([np.where(end_a[to_a] > end_b, n_b + to_a, np.arange(n_b)), to_b])
    while True:
        further = step[step]
        if np.array_equal(further, step):
            return step, to_a
        step = further


class Aligner:
    """Aligns lists of texts; one per task."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizer(path_a).load(), tokenizer(path_b).load()
        self.len_a = np.array([len(p) for p in self.a.pieces], np.int64)
        self.len_b = np.array([len(p) for p in self.b.pieces], np.int64)
        names = [str(i) for i in range(max(len(self.len_a), len(self.len_b)))]
        self.more, self.bar, self.semicolon = (np.array([n + s for n in names], object) for s in ",|;")

    def align(self, texts: list[str | None]) -> pa.StructArray:
        """``n_a, n_b, n_groups, groups, links`` of each text."""
        n = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        words = [texts[i] for i in some]
        ids_a, ids_b = (self.a.encode(words), self.b.encode(words)) if words else ([], [])
        same = [k for k, t in enumerate(words) if self._covers(t, ids_a[k], ids_b[k])]
        ids_a, ids_b, row = [ids_a[k] for k in same], [ids_b[k] for k in same], np.array([some[k] for k in same], np.int64)
        n_a, n_b, n_groups = (np.zeros(n, np.int64) for _ in range(3))
        n_a[row], n_b[row] = [len(x) for x in ids_a], [len(x) for x in ids_b]
        flat_a = np.fromiter(chain.from_iterable(ids_a), np.int32, int(n_a.sum()))
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int32, int(n_b.sum()))
        del ids_a, ids_b
        groups, links = [""] * n, (np.zeros(n + 1, np.int32), *(np.zeros(0, np.int64) for _ in range(3)))
        if len(row):
            len_a, len_b = self.len_a[flat_a], self.len_b[flat_b]
            end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
            step, to_a = terminals(end_a, end_b, end_a - len_a, end_b - len_b)
            last = np.flatnonzero(step[:len(flat_b)] == np.arange(len(flat_b)))
            label = np.zeros(len(flat_b), np.int64)
            label[last] = np.arange(len(last))
            group_b, group_a = label[step[:len(flat_b)]], label[step[len(flat_b):]]
            doc = np.repeat(np.arange(n), n_b)[last]
            n_groups = np.bincount(doc, minlength=n)
            text = self._write(flat_a, flat_b, group_a, group_b)
            ends = np.cumsum(n_a + n_b)
            for i in row.tolist():
                groups[i] = "".join(text[ends[i] - n_a[i] - n_b[i]:ends[i]].tolist())[:-1]
            links = self._links(doc, flat_a[to_a[last]], flat_b[last], n)
        offsets, a, b, times = links
        pairs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(times, pa.int64())], ["a", "b", "times"]))
        return pa.StructArray.from_arrays([pa.array(n_a), pa.array(n_b), pa.array(n_groups, pa.int64()), pa.array(groups, pa.string()), pairs],
                                          ["n_a", "n_b", "n_groups", "groups", "links"])

    def _covers(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        body = b" " + text.encode("utf-8")
        return b"".join(map(self.a.pieces.__getitem__, ids_a)) == body and b"".join(map(self.b.pieces.__getitem__, ids_b)) == body

    def _write(self, flat_a, flat_b, group_a, group_b) -> np.ndarray:
        """The ids of all groups in order, each with the sign that follows it."""
        out = np.empty(len(flat_a) + len(flat_b), object)
        close_a = np.append(group_a[1:] != group_a[:-1], True)
        close_b = np.append(group_b[1:] != group_b[:-1], True)
        first_b = np.searchsorted(group_b, group_a)
        after_a = np.searchsorted(group_a, group_b, "right")
        out[np.arange(len(flat_a)) + first_b] = np.where(close_a, self.bar[flat_a], self.more[flat_a])
        out[np.arange(len(flat_b)) + after_a] = np.where(close_b, self.semicolon[flat_b], self.more[flat_b])
        return out

    def _links(self, doc, a, b, n) -> tuple[np.ndarray, ...]:
        """Offsets by document, and its distinct (a, b) in order with how often each is linked."""
        key = a.astype(np.int64) * len(self.len_b) + b
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
        times = np.diff(np.append(first, len(key)))
        offsets = np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)
        return offsets, key[first] // len(self.len_b), key[first] % len(self.len_b), times


def aligned_batches(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``align`` for batches of ``doc_id, __text``; one call per task."""
    aligner = None
    for whole in batches:
        aligner = aligner or Aligner(path_a, path_b)
        for batch in slices(whole, "__text", SLICE):
            found = aligner.align(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.flatten()], ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])


def align(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, links`` for every row of ``docs``.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3``: the ids of each group in order. ``links``
    holds each (a, b) whose tokens end together, with the number of ``times`` in the text.
    Both vocabulary paths are those of files on every executor. Texts that are null or
    empty, or that either tokenizer does not give back byte for byte, have zeros, an empty
    ``groups`` and no links. Whole texts are aligned: a task works on about ``SLICE`` bytes of
    texts, or one longer text, at a time. Repeated rows give repeated results; a null id stays
    null; other columns are not read; an empty table gives no rows. No shuffle.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")] + [T.StructField("groups", T.StringType()), T.StructField("links", LINKS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return aligned_batches(batches, vocabulary_a, vocabulary_b)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("__text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: how many links of the corpus hold a pair, and whether no other
    pair of its b has more. At most ``possible_pairs`` rows, combined in each task."""
    counts = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("times").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def link_totals(links: pa.ListArray, per_link: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """For each array that ``per_link(a, b)`` gives, its sum over every row's links, times included.

    Rows are taken in runs of about ``LINKS_AT_A_TIME`` links (one row at least).
    """
    ends, lo, parts = np.cumsum(links.value_lengths().to_numpy(zero_copy_only=False)), 0, []
    while lo < len(links):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + LINKS_AT_A_TIME, "right")))
        run = links.slice(lo, hi - lo)
        row = np.repeat(np.arange(hi - lo), run.value_lengths().to_numpy(zero_copy_only=False))
        a, b, times = (x.to_numpy() for x in run.flatten().flatten())
        sums = []
        for values in per_link(a, b):
            total = np.zeros(hi - lo, np.int64)
            np.add.at(total, row, values * times)
            sums.append(total)
        parts.append(sums)
        lo = hi
    return [np.concatenate(x) for x in zip(*parts)]


def alignment_report(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    Texts are tokenized once: links and digests are written, the counts of all pairs come
    from that table, and a last scan adds them up per document. Edge cases as in ``align``.
    """
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = materialize(align(docs, vocabulary_a, vocabulary_b, id_col, text_col).withColumn("groups", digest), "alignment",
                          {"parquet.block.size": str(ROW_GROUP_BYTES)})
    counts = pair_counts(aligned).toArrow()
    if counts.num_rows > possible_pairs(vocabulary_a, vocabulary_b):
        raise RuntimeError("more linked pairs than the vocabularies allow")
    a, b = counts["a"].to_numpy().astype(np.int64), counts["b"].to_numpy().astype(np.int64)
    keys = a << 32 | b
    order = np.argsort(keys)
    keys, count, best = keys[order], counts["count"].to_numpy()[order], counts["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    schema = T.StructType([aligned.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType())])

    def per_link(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        place = np.searchsorted(keys, a.astype(np.int64) << 32 | b.astype(np.int64))
        return [np.ones(len(a), np.int64), best[place], count[place]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = [pa.array(x) for x in link_totals(batch.column(5), per_link)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *sums, batch.column(4)], schema.names)

    return aligned.mapInArrow(run, schema)
