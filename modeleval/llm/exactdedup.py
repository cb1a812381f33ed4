"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each hash.

Texts are normalised (A-Z lowered) and hashed once; rows are grouped by the first 128 bits
of their SHA-256. The distinct texts of each hash are counted over their whole bytes, so
two different texts that share a hash are seen and get groups of their own. Copies are
combined in each task before any shuffle, and the groups that hold more than 1 / ``HOT``
of all rows, fewer than ``HOT`` by that definition, are broadcast back; only the rows of
the other groups are joined by their hash. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeleval.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT = 4096
HASH_BYTES = 16


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def exact_duplicates(docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] = ascii_lower,
                     id_col: str = "doc_id", text_col: str = "text", hash_bytes: int = HASH_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row for every row of ``docs``.

    Rows are a group when their normalised texts are the same bytes; the row with the
    ``keep`` (``smallest`` or ``largest``) id stays. A null text counts as empty, and so
    equals an empty one. A null id is chosen only if the group has no other. Of repeated
    rows with the chosen id exactly one stays. Texts are hashed and compared whole,
    whatever their length; other columns are not read; an empty table gives no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    own = docs.select(docs[id_col].alias("doc_id"), normalise(F.coalesce(docs[text_col], F.lit(""))).alias("body"))
    own = own.withColumn("sha", F.unhex(F.sha2("body", 256))).withColumn("hash", F.substring("sha", 1, hash_bytes))
    rows = _with_group(own).withColumn("rid", F.monotonically_increasing_id())
    # Written, so that the row numbers stay the same for all that follows.
    rows = materialize(rows, "dedup-rows")
    if keep == "largest":
        best = F.max(F.struct("doc_id", "rid"))
    else:
        best = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "rid"))
    groups = materialize(rows.groupBy("hash", "sub").agg(best.alias("best"), F.count(F.lit(1)).alias("n")), "dedup-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    facts = F.struct("best", "n")
    # Groups of more than total / HOT rows: fewer than HOT of them, at any size of the input.
    hot = F.broadcast(groups.filter(F.col("n") * F.lit(HOT) > F.lit(total)).select("hash", "sub", facts.alias("hot")))
    rest = groups.filter(F.col("n") * F.lit(HOT) <= F.lit(total)).select(F.col("hash").alias("key"), F.col("sub").alias("key_sub"), facts.alias("rest"))
    known = rows.join(hot, ["hash", "sub"], "left")
    # Rows of hot groups need no partner: a key of their own spreads them over all tasks.
    known = known.withColumn("key", F.when(F.col("hot").isNull(), F.col("hash")).otherwise(F.unhex(F.md5(F.col("rid").cast("string")))))
    joined = known.join(rest, (known["key"] == rest["key"]) & (known["sub"] == rest["key_sub"]), "left")
    group = F.coalesce("hot", "rest")
    return joined.select(
        "doc_id", group["best"]["doc_id"].alias("keep_id"), group["n"].alias("group_size"),
        (group["best"]["rid"] == F.col("rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def _with_group(own: DataFrame) -> DataFrame:
    """``doc_id, sha, hash, sub``: rows of one (hash, sub) have the same bytes.

    ``sub`` is 0 unless different texts share a hash; those are numbered in order.
    """
    texts = own.select("hash", "body").distinct()
    clash = materialize(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("hash"), "dedup-clash")
    if clash.isEmpty():
        return own.select("doc_id", "sha", "hash", F.lit(0).alias("sub"))
    numbered = own.join(clash, "hash", "left_semi").select("hash", "body").distinct().withColumn(
        "sub", F.row_number().over(Window.partitionBy("hash").orderBy("body")))
    return own.join(numbered, ["hash", "body"], "left").select("doc_id", "sha", "hash", F.coalesce("sub", F.lit(0)).alias("sub"))


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] = ascii_lower,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; edge cases as in ``exact_duplicates``.

    Where the chosen id has several rows of that text, one of them stays.
    """
    own = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_col].alias("doc_id"),
                      F.sha2(normalise(F.coalesce(docs[text_col], F.lit(""))), 256).alias("sha"))
    kept = exact_duplicates(docs, keep, normalise, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    own = own.join(kept, own["doc_id"].eqNullSafe(kept["kept_id"]) & (own["sha"] == kept["kept_sha"]), "left_semi")
    return own.dropDuplicates(["doc_id", "sha"]).select("row.*")
