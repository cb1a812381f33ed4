"""Token counts of a byte-level BPE with a whole-token shortcut.

Offline, once per vocabulary: a vocabulary string that is a single pre-token and that
the merges turn back into one token needs no merging ever again. Those strings are the
shortcut set. A text is split into pre-tokens; those in the set count one each, only
the others are merged, each distinct one once per task as far as the cache reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from modeleval.llm.common import slices

#: Fixed value: the pre-token pattern of this family of vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: bytes that are
    printable stand for themselves, the others get characters from 256 on, in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class Counter:
    """Counts the tokens of texts with the vocabulary file at ``path``."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("a byte-level BPE without normalizer is needed")
        self.merge = Tokenizer.from_file(path).model.tokenize
        self.split = regex.compile(PRE_TOKEN).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        alphabet = byte_alphabet()
        self.table = {b: c for b, c in enumerate(alphabet)}
        back = {c: b for b, c in enumerate(alphabet)}
        self.whole = set(self._proved(spec["model"]["vocab"], back))
        self.cache: dict[str, int] = {}

    def _proved(self, vocab, back) -> Iterator[str]:
        """The offline proof: strings that are one pre-token and merge into one token."""
        for token in vocab:
            if any(c not in back for c in token):
                continue
            try:
                text = bytes(back[c] for c in token).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if self.split(text) == [text] and len(self.merge(token)) == 1:
                yield text

    def merged(self, piece: str) -> int:
        n = self.cache.get(piece)
        if n is None:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            n = self.cache[piece] = len(self.merge(piece.encode("utf-8").decode("latin-1").translate(self.table)))
        return n

    def count(self, text: str) -> int:
        total, whole, cache, merged = 0, self.whole, self.cache, self.merged
        parts = [text]
        if self.special is not None and "<" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            for piece in self.split(part):
                total += 1 if piece in whole else cache.get(piece) or merged(piece)
        return total


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``vocabulary`` is the path of the file on every executor. Special strings inside a
    text are one token each, as the library has it; none are added. Null and empty texts
    have 0 bytes and tokens; whole texts are counted, whatever their length; repeated
    rows are counted alike; an empty table gives an empty result. No shuffle; a task
    holds the vocabulary and a cache of at most ``CACHE_ENTRIES`` merged pre-tokens.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for whole in batches:
            counter = counter or Counter(vocabulary)
            for batch in slices(whole, "__text"):
                texts = batch.column(1)
                n = [counter.count(t) if t else 0 for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("__text")).mapInArrow(run, schema)
