"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. Dividing it by the source's size gives the whole copies
that every document is certain of; the words left are the source's quota. Documents have an
inclusion probability p for one copy more that rises with their size: p = min(1, c * size class),
with c such that the words expected are the quota. A document of p = 1 is certain of it. The
others are ranked by Pareto's quotient, random odds u / (1 - u) over inclusion odds p / (1 - p),
and taken in that order until the quota is reached: a sample of fixed size in words with unequal
probabilities. u is a digest of the document and, for repeated rows, of its number among them,
so reruns agree and repeated rows are drawn one by one.

No source is ever sorted as a whole: quotients are ranked by q / (1 + q) as a 52-bit number,
words are summed per (source, bin of it), the bin in which the quota is reached is split
again, and only what is left there is ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modeleval.llm.common import free_prefix
from modeleval.session import materialize

#: Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
U_BITS, BIN_BITS = 52, 12
#: Sizes in one class agree in their leading bits, so they differ by less than an eighth.
CLASS_BITS = 4
#: Runs in which the copies of a repeated row are numbered.
SALTS = 1024
MAX_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """The size with all but its leading ``CLASS_BITS`` bits cleared, at least 1."""
    low = F.greatest(F.length(F.bin(size)) - CLASS_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), low).cast("long")
    return F.greatest(size - F.pmod(size, step), F.lit(1).cast("long"))


def draw_key(doc_id: Column, source: Column, text: Column, seed: str) -> Column:
    """What the random number of a document is made of: repeated rows agree in it."""
    def marked(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))

    return F.md5(F.concat_ws("\x1f", F.lit(seed), marked(doc_id), marked(source), F.md5(F.coalesce(text, F.lit("")))))


def random_bits(draw: Column, number: Column) -> Column:
    """52 random bits of the row that is ``number`` among those of its draw key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", draw, number.cast("string"))), 1, U_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target``.

    Sources in code point order, null last, have the ``weights`` in turn. The targets
    share ``share`` of all words by weight; none exceeds ``cap`` times its source, and
    what is cut is shared again among the others. That is one level ``lambda`` with
    target = min(cap * size, lambda * weight), found from running sums of the sources
    in order of cap * size / weight. Windows here are over one row per source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                   (rank - 1) % len(weights) + 1))
    full = F.col("source_size") * F.lit(float(cap))
    by_ratio = W.orderBy("__ratio", F.col("source").asc_nulls_last())
    level = weighed.withColumn("__ratio", full / F.col("__w")).select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(W.partitionBy())
         - (F.sum(full).over(by_ratio) - full)).alias("__left"),
        F.sum("__w").over(by_ratio.rowsBetween(0, W.unboundedFollowing)).alias("__rest"))
    level = level.withColumn("__level", F.col("__left") / F.col("__rest"))
    found = F.min_by(F.when(F.col("__level") <= F.col("__ratio"), F.col("__level")),
                     F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", F.col("source").isNull(), "source")))
    return level.withColumn("__lambda", found.over(W.partitionBy())).select(
        "source", "source_size", F.least(full, F.coalesce(F.col("__lambda") * F.col("__w"), full)).alias("target"))


def repeated(rows: DataFrame) -> DataFrame | None:
    """The draw keys that several rows share, as column ``again``; None if there are none."""
    many = materialize(rows.groupBy("draw").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("draw").alias("again")), "mix-again")
    count = many.count()
    return None if count == 0 else F.broadcast(many) if count <= MAX_BROADCAST_SOURCES else many


def numbered(df: DataFrame, again: DataFrame | None, draw: str, number: str) -> DataFrame:
    """``df`` with the ``number`` of each row (0, 1, ...) among those of its ``draw`` key.

    Rows of their own are 0 and are not shuffled. Copies are numbered in ``SALTS`` runs, and the
    counts of the runs before are added, so however many there are no task has them all."""
    zero = F.lit(0).cast("long")
    if again is None:
        return df.withColumn(number, zero)
    salt, low = f"{number}_salt", f"{number}_low"
    same = F.col(draw) == F.col("again")
    alone = df.join(again, same, "left_anti").withColumn(number, zero)
    again_rows = materialize(df.join(again, same, "left_semi").withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))), "mix-copies")
    runs = again_rows.groupBy(F.col(draw).alias("again"), F.col(salt).alias("run")).agg(F.count(F.lit(1)).alias("n"))
    before = runs.select("again", "run", (F.sum("n").over(W.partitionBy("again").orderBy("run")) - F.col("n")).alias(low))
    placed = again_rows.withColumn(number, F.row_number().over(W.partitionBy(draw, salt).orderBy(draw)) - 1)
    placed = placed.join(before, (F.col(draw) == F.col("again")) & (F.col(salt) == F.col("run")))
    return alone.unionByName(placed.withColumn(number, F.col(number) + F.col(low)).select(*df.columns, number))


def chance(level: Column, size: Column) -> Column:
    """Inclusion probability of a document of a source whose level is c."""
    return F.least(F.lit(1.0), level * size_class(size))


def pareto_rank(bits: Column, p: Column) -> Column:
    """Pareto's quotient q = (u / (1 - u)) / (p / (1 - p)) as the whole number of 52 bits of
    q / (1 + q), which orders alike and needs no division by zero."""
    u = (bits + 0.5) / F.lit(2.0**U_BITS)
    over, under = u * (1 - p), p * (1 - u)
    return F.least(F.floor(over / (over + under) * F.lit(2.0**U_BITS)), F.lit(2**U_BITS - 1)).cast("long")


def levels(classes: DataFrame, goals: DataFrame, same) -> DataFrame:
    """``source, level, sure``: each source's c, and the words of its documents of p = 1.

    From ``source, class, words``. If the classes above k are certain, c is the quota less their
    words over the sum of class times words of the others; the right k is the largest class
    for which c * k is at most 1. Windows are over a source's size classes, a few hundred.
    """
    upward = W.partitionBy("s.source").orderBy("class")
    mass = F.col("class").cast("decimal(38,0)") * F.col("words")
    downward = W.partitionBy("s.source").orderBy(F.col("class").desc())
    steps = classes.alias("s").join(goals.alias("g"), same("s", "g")).filter("quota > 0").select(
        "s.source", "class", "words", "quota", (F.sum("words").over(downward) - F.col("words")).alias("above"),
        F.sum(mass).over(upward).cast("double").alias("mass")).filter("mass > 0")
    tried = steps.withColumn("level", (F.col("quota") - F.col("above")) / F.col("mass"))
    fits = F.when(F.col("level") * F.col("class") <= 1, F.col("class"))
    return tried.withColumn("level", F.max_by("level", fits).over(W.partitionBy("source"))).groupBy("source").agg(
        F.max("level").alias("level"), F.sum(F.when(F.col("level") * F.col("class") >= 1, F.col("words")).otherwise(0)).alias("sure"))


def plan(rows: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source from rows of ``source, size, bits``: its ``source_size``, ``target``,
    ``certain`` copies, ``level`` c of the inclusion probabilities and ``cut``: the largest Pareto
    rank that is still taken (-1: none). Ends within half a document's words of the target."""
    classes = materialize(rows.groupBy("source", size_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words")), "mix-classes")
    goals = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("certain", F.floor(ratio)).withColumn("quota", F.col("target") - F.col("certain") * F.col("source_size"))
    goals = materialize(goals, "mix-goals")
    size_bound = goals.count() <= MAX_BROADCAST_SOURCES

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if size_bound else df

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))

    drawn = materialize(levels(classes, small(goals), same), "mix-levels")
    p = chance(F.col("l.level"), F.col("size"))
    ranked = rows.alias("r").join(small(drawn.alias("l")), same("r", "l")).filter(p < 1).select(
        "r.source", "size", pareto_rank(F.col("bits"), p).alias("rank"))
    coarse, fine = F.shiftright("rank", U_BITS - BIN_BITS), F.shiftright("rank", U_BITS - 2 * BIN_BITS)
    bins = materialize(ranked.groupBy("source", coarse.alias("bin")).agg(F.sum("size").alias("words")), "mix-bins")

    def boundary(summed: DataFrame, start: DataFrame) -> DataFrame:
        """The bin of each source in which its quota is reached, and the words before it."""
        run = F.sum("words").over(W.partitionBy("s.source").orderBy("bin"))
        seen = summed.alias("s").join(small(start.select("source", "quota", "before").alias("g")), same("s", "g")).select(
            "s.source", "bin", "quota", (F.col("before") + run - F.col("words")).alias("before"), (F.col("before") + run).alias("after"))
        return seen.filter((F.col("before") <= F.col("quota")) & (F.col("quota") < F.col("after"))).select("source", "bin", "quota", "before")

    wanted = goals.alias("g").join(drawn.alias("l"), same("g", "l")).select(
        "g.source", (F.col("quota") - F.col("sure")).alias("quota"), F.lit(0).cast("long").alias("before"))
    first = materialize(boundary(bins, wanted), "mix-first")
    inside = ranked.alias("r").join(small(first.alias("f")), same("r", "f") & (coarse == F.col("f.bin"))).select("r.source", "size", "rank")
    second = materialize(boundary(inside.groupBy("source", fine.alias("bin")).agg(F.sum("size").alias("words")), first), "mix-second")
    units = (ranked.alias("r").join(small(second.alias("f")), same("r", "f") & (fine == F.col("f.bin")))
             .groupBy("r.source", "rank", "bin", "quota", "before").agg(F.sum("size").alias("words")))
    order = W.partitionBy("source").orderBy("rank")
    placed = units.withColumn("middle", F.col("before") + F.sum("words").over(order) - F.col("words") / 2)
    edge = F.shiftleft(F.col("bin"), U_BITS - 2 * BIN_BITS) - 1
    cuts = placed.groupBy("source").agg(F.coalesce(
        F.max(F.when(F.col("middle") <= F.col("quota"), F.col("rank"))), F.max(edge)).alias("cut"))
    return goals.alias("g").join(drawn.alias("l"), same("g", "l"), "left").join(cuts.alias("c"), same("g", "c"), "left").select(
        "g.source", "source_size", "target", "certain", F.coalesce("level", F.lit(0.0)).alias("level"),
        F.coalesce("cut", F.lit(-1).cast("long")).alias("cut"))


def copies(size: Column, bits: Column, own: Column) -> Column:
    """Whole copies of a document under its source's plan: the certain ones, and one more if its
    p is 1 or its Pareto rank is at most the cut."""
    p = chance(own["level"], size)
    return own["certain"] + F.when((p >= 1) | (pareto_rank(bits, p) <= own["cut"]), 1).otherwise(0)


def _planned(rows: DataFrame, sources: DataFrame, source: str, size: str, bits: str, out: str) -> DataFrame:
    """``rows`` with the plan of their source as the struct ``out`` and their copies in it."""
    known = materialize(sources, "mix-plan")
    side = known.select(F.struct(*known.columns).alias(out))
    side = F.broadcast(side) if known.count() <= MAX_BROADCAST_SOURCES else side
    joined = rows.join(side, F.col(f"`{source}`").eqNullSafe(F.col(f"{out}.source")), "left")
    return joined.withColumn(out, F.col(out).withField("copies", copies(F.col(size), F.col(bits), F.col(out))))


def _rows(docs: DataFrame, seed: str, source_col: str, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """``doc_id, source, size, bits`` of every document, written, and the draw keys of repeated ones."""
    keyed = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        draw_key(F.col(id_col), F.col(source_col), F.col(text_col), seed).alias("draw")), "mix-rows")
    again = repeated(keyed)
    return numbered(keyed, again, "draw", "number").select("doc_id", "source", "size", random_bits(F.col("draw"), F.col("number")).alias("bits")), again


def mix_report(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
               source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``.

    Null or empty texts have size 0 and are taken as 0 words; null is a source of its own,
    the last. Rows alike in id, source and text are drawn one by one, so how many of them are
    taken does not change between reruns. An empty table gives an empty result.
    """
    rows, _ = _rows(docs, seed, source_col, text_col, id_col)
    joined = _planned(rows, plan(rows, weights, share, cap), "source", "size", "bits", "plan")
    return joined.select("doc_id", "size", "plan.source_size", "plan.target", (F.col("size") * F.col("plan.copies")).alias("taken"), "plan.copies")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: each row of ``docs``, all its columns, as often as it is taken."""
    rows, again = _rows(docs, seed, source_col, text_col, id_col)
    own = free_prefix(docs, "__mix_")
    keyed = docs.withColumn(f"{own}draw", draw_key(F.col(id_col), F.col(source_col), F.col(text_col), seed))
    drawn = numbered(keyed, again, f"{own}draw", f"{own}number").select(
        *[f"`{c}`" for c in docs.columns], word_count(F.col(text_col)).alias(f"{own}size"),
        random_bits(F.col(f"{own}draw"), F.col(f"{own}number")).alias(f"{own}bits"))
    joined = _planned(drawn, plan(rows, weights, share, cap), source_col, f"{own}size", f"{own}bits", f"{own}plan")
    each = F.explode(F.array_repeat(F.lit(1), F.col(f"{own}plan.copies").cast("int")))
    return joined.select(*[f"`{c}`" for c in docs.columns], each.alias(f"{own}n")).drop(f"{own}n")
