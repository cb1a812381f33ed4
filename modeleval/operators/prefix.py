"""Exclusive running sums per series in (score, row key) order.

For every row of a series, in ascending (score, row key) order, we need the
records, positives, weight and positive weight of all rows *before* it, the
scores of its neighbours, and the series totals. Both plans cut every series
into range partitions first, so no task ever holds a whole series:

1. ``repartitionByRange(P, place, score, *key, tag, weight)``: Spark samples the
   composite key, so a score tied on a third of all rows is still cut across many
   tasks by the row key. ``place`` is one BIGINT that rises with (series, score), so
   that nearly all comparisons end at the first column; tag and weight make the
   order total for repeated keys (rows equal in all of these are interchangeable). Whole
   numbers move in halves put together by twos (``Packed``), and a weight that a column of
   the row key gives (``weight_from``) is neither moved nor written;
2. local running sums inside each (partition, series) run:

   ``range``  (default) ``sortWithinPartitions`` + an iterator Arrow UDF: vectorised
              numpy cumulative sums over Arrow batches, state carried between
              batches, row keys left in the JVM; one shuffle in all;
   ``window`` the rows tagged with their partition id are written first, in buckets by
              it; ``Window.partitionBy(series, partition).orderBy(score, key, ..)``
              gives the local sums: all JVM, one more sort but no more shuffle;

3. the partition-tagged table is written once under the shared checkpoint
   folder; that cuts the lineage and pins the layout for what follows, and the
   shuffle's files are removed;
4. per (partition, series) totals - at most P x S rows - give the offsets with
   a window over that tiny table;
5. readers add the offsets to the local sums (``prefix_sums`` joins them; the
   performance step takes them along, see there).

Weights are whole numbers and never negative. Local weight sums are two BIGINT limbs
(``functions.wide``) and the sums over partitions DECIMAL(38,0), so nothing is rounded
and no partition overflows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeleval.functions import wide
from modeleval.functions.safe import running_weight, to_int, weight_sum
from modeleval.functions.tags import likely_weight
from modeleval.session import materialize, scratch_path, shuffles_removed
from modeleval.spec import DEFAULT_MAX_BROADCAST_ROWS

# Compressed bytes of the score table that one range partition should hold.
TARGET_PARTITION_BYTES = 64 << 20

SUM_COLS = ("cum_records", "cum_tag", "cum_weight", "cum_weight_tag")
TOTAL_COLS = ("total_records", "total_pos", "total_weight", "total_weight_pos")
LOCAL_COLS = ("loc_records", "loc_tag", "loc_weight_high", "loc_weight_low", "loc_weight_tag_high", "loc_weight_tag_low")
VALUES = ("tag", "weight", "weight_tag")
SUM_INPUTS = ("series", "score", *VALUES)


def _out_columns(keys: Sequence[str]) -> list[str]:
    return ["series", "score", *keys, "tag", "weight", "weight_tag", *SUM_COLS,
            "prev_score", "next_score", *TOTAL_COLS, "_pid"]


@dataclass(frozen=True)
class Running:
    """Written local sums, their offsets and what is known about them.

    ``names`` are the series names if the tables hold positions; ``bound`` is the most
    rows that ``offsets`` can have (None if the number of series is not known).
    """

    table: DataFrame
    offsets: DataFrame
    names: list[str] | None
    bound: int | None


def prefix_sums(long: DataFrame, keys: Sequence[str], method: str = "range",
                partitions: int | None = None, series_count: int | None = None,
                series_names: Sequence[str] | None = None,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                weight_from: tuple[str, int] | None = None) -> DataFrame:
    """Running sums for the long ``series, score, key.., tag, weight, weight_tag`` table.

    ``series_names`` (when known) lets the range plan shuffle and sort a small
    integer id instead of the name. For ``weight_from`` see ``local_sums_table``.
    """
    found = running_sums(long, keys, method, partitions, series_count, series_names, weight_from)
    return with_sums(found, keys, max_broadcast_rows)


def encode_series(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the series name by its position in ``names`` (unknown names fail)."""
    if isinstance(long.schema["series"].dataType, T.IntegerType):
        return long
    pairs = []
    for i, n in enumerate(names):
        pairs += [F.lit(n), F.lit(i)]
    sid = F.element_at(F.create_map(*pairs), F.col("series"))
    return long.withColumn("series", F.when(sid.isNull(), F.raise_error(
        F.concat(F.lit("unknown series "), F.col("series")))).otherwise(sid).cast("int"))


def decode_series(col: Column, names: Sequence[str] | None) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), col + F.lit(1)) if names else col


# One series takes 2^44 places; scores are told apart there in steps of 2^-20 up to +-2^23.
PLACES, STEPS = 1 << 44, float(1 << 20)


def place_of(series: Column, score: Column) -> Column:
    """One BIGINT that never falls as (series number, score) rises: NULL first, NaN last."""
    edge = float(PLACES // 2 - 1)
    scaled = F.nanvl(score, F.lit(float("inf"))) * F.lit(STEPS)
    near = F.floor(F.least(F.greatest(scaled, F.lit(-edge)), F.lit(edge)))
    return series.cast("bigint") * F.lit(PLACES) + F.when(score.isNull(), F.lit(-PLACES // 2)).otherwise(near)


def _local_sums(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Per task: exclusive running sums inside each series run, plus neighbour scores.

    Batches of ``SUM_INPUTS`` arrive sorted by (series, score, key). State carried from
    batch to batch: the current series, its running sums and its last score.
    The last row of a batch waits for the next batch to learn its successor.
    """
    carry_series = None
    carry = [0, 0, 0, 0]
    last_score = 0.0
    pending = None

    def emit(item):
        sums, prev, prev_null, nxt, nxt_null = item
        arrays = [pa.array(s, type=pa.int64()) for s in sums] + [
            pa.array(prev, type=pa.float64(), mask=prev_null),
            pa.array(nxt, type=pa.float64(), mask=nxt_null),
        ]
        return pa.StructArray.from_arrays(arrays, names=[*LOCAL_COLS, "prev_score", "next_score"])

    def run_sums(x, starts, run, carried):
        """Exclusive sums since the start of each row's run, and the sum up to the batch's end."""
        before = wide.running(x)
        end = (int(before[0][-1]) << wide.BITS) + int(before[1][-1]) + int(x[-1])
        if run[-1] < 0:
            end += carried
        elif len(starts):
            end -= (int(before[0][starts[-1]]) << wide.BITS) + int(before[1][starts[-1]])
        if len(starts):
            # Rows before the first new run continue the carried one.
            at = starts[np.maximum(run, 0)]
            before = wide.subtract(before, (np.where(run < 0, 0, before[0][at]), np.where(run < 0, 0, before[1][at])))
        if carried and run[0] < 0:
            high, low = wide.wide([carried])
            before = wide.add(before, (np.where(run < 0, high[0], 0), np.where(run < 0, low[0], 0)))
        return before, end

    for columns in batches:
        n = len(columns[0])
        if n == 0:
            continue
        series, score, *own = (c.to_numpy(zero_copy_only=False) for c in columns)
        score = score.astype(np.float64)
        values = [np.ones(n, dtype=np.int64)] + [x.astype(np.int64) for x in own]
        if min(int(x.min()) for x in values) < 0:
            raise ValueError("weights must not be negative")
        new_run = np.empty(n, dtype=bool)
        new_run[0] = series[0] != carry_series
        new_run[1:] = series[1:] != series[:-1]
        run = np.cumsum(new_run) - 1          # -1: rows continuing the carried run
        starts = np.flatnonzero(new_run)
        sums = []
        for j, x in enumerate(values):
            (high, low), carry[j] = run_sums(x, starts, run, carry[j])
            sums += [low] if j < 2 else [high, low]
        prev = np.empty(n, dtype=np.float64)
        prev[1:] = score[:-1]
        prev[0] = last_score
        prev_null = new_run.copy()
        nxt = np.empty(n, dtype=np.float64)
        nxt[:-1] = score[1:]
        nxt[-1] = 0.0
        nxt_null = np.zeros(n, dtype=bool)
        nxt_null[:-1] = new_run[1:]
        nxt_null[-1] = True
        if pending is not None:
            if not new_run[0]:
                pending[3][-1] = score[0]
                pending[4][-1] = False
            yield emit(pending)
        pending = (sums, prev, prev_null, nxt, nxt_null)
        carry_series = series[-1]
        last_score = float(score[-1])
    if pending is not None:
        yield emit(pending)


def plan_bytes(df: DataFrame) -> int:
    """Size of ``df`` as its plan states it; for a scan of written files, their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(table_bytes: int, series_count: int, least: int) -> int:
    """Range partitions for a written score table that is unpivoted into ``series_count`` series."""
    return max(int(least), -(-table_bytes * max(1, series_count) // TARGET_PARTITION_BYTES))


def _range_partitions(long: DataFrame, partitions: int | None, series_count: int | None) -> int:
    """As asked for; else by the bytes of the files the rows come from, so that a task can sort its
    rows in memory, and at least the shuffle partitions.

    A join's own estimate is the product of its sides, so no more than the files' sum is taken.
    Rows that come from no files have an unknown size.
    """
    if partitions:
        return int(partitions)
    spark = long.sparkSession
    leaves = long._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    known = files < int(spark._jsparkSession.sessionState().conf().defaultSizeInBytes())
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return partitions_for(min(files, plan_bytes(long)), series_count or 1, least) if known else least


HALF = 32
_LOW = (1 << HALF) - 1
_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


class Packed:
    """``rows`` with their whole numbers in halves of 32 bits, two to a BIGINT.

    A shuffle's row has eight bytes for each column, and upper halves hardly ever change. Here
    these lie together and in front, with the lower halves of the columns named in ``steady``, and
    compress to a few bytes a row. ``columns`` gives every value back as it was, NULL too.
    """

    def __init__(self, rows: DataFrame, steady: Sequence[str] = ()):
        fields = {f.name: f for f in rows.schema.fields}
        whole = [n for n, f in fields.items() if isinstance(f.dataType, _WHOLE)]
        nullable = [n for n in whole if fields[n].nullable]
        # A bit of one BIGINT tells that a value is NULL; columns beyond its bits move as they are.
        bits = {n: F.lit(1 << i).cast("bigint") for i, n in enumerate(nullable[:63])}
        whole = [n for n in whole if n in bits or n not in nullable]
        low, zero = F.lit(_LOW).cast("bigint"), F.lit(0).cast("bigint")
        value = {n: F.coalesce(F.col(n).cast("bigint"), zero) for n in whole}
        high = [(n, True) for n in whole if isinstance(fields[n].dataType, T.LongType)]
        parts = high + [(n, False) for n in whole if n in steady] + [(n, False) for n in whole if n not in steady]
        self.place = {part: divmod(i, 2) for i, part in enumerate(parts)}
        slots = []
        for i in range(0, len(parts), 2):
            left, *right = [F.shiftright(value[n], HALF) if upper else value[n] for n, upper in parts[i:i + 2]]
            slot = F.shiftleft(left, HALF)
            slots.append((slot.bitwiseOR(right[0].bitwiseAND(low)) if right else slot).alias(f"_p{i // 2}"))
        front = sum(upper or n in steady for n, upper in parts) // 2
        others = [F.col(n) for n in fields if n not in value]
        nulls = [F.when(F.col(n).isNull(), b).otherwise(zero) for n, b in bits.items()]
        mask = [reduce(Column.bitwiseOR, nulls).alias("_nulls")] if nulls else []
        self.rows = rows.select(*mask, *slots[:front], *others, *slots[front:])
        self.columns: dict[str, Column] = {}
        for n, f in fields.items():
            if n not in value:
                self.columns[n] = F.col(n)
                continue
            back = self._half(n, False)
            if (n, True) in self.place:
                back = F.shiftleft(self._half(n, True), HALF).bitwiseOR(back.bitwiseAND(low))
            back = back.cast(f.dataType)
            self.columns[n] = F.when(F.col("_nulls").bitwiseAND(bits[n]) == 0, back) if n in bits else back

    def _half(self, name: str, upper: bool) -> Column:
        slot, right = self.place[name, upper]
        return F.shiftright(F.shiftleft(f"_p{slot}", HALF) if right else F.col(f"_p{slot}"), HALF)


def _usual(tag: Column, weight: Column) -> Column:
    return F.when(tag == 1, weight).otherwise(F.lit(0)).cast("bigint")


def _given(weight_from: tuple[str, int] | None, values: Mapping[str, Column] | None = None) -> Column:
    """The weight that the row key gives (``values`` has its columns if they have other names)."""
    if weight_from is None:
        return F.lit(0).cast("bigint")
    name, scale = weight_from
    return likely_weight(values[name] if values else F.col(name), scale)


def local_sums_table(long: DataFrame, keys: Sequence[str], partitions: int | None = None,
                     series_names: Sequence[str] | None = None, local: str = "arrow",
                     weight_from: tuple[str, int] | None = None, whole_scores: bool = False) -> DataFrame:
    """Steps 1-3: rows tagged with their range partition ``_pid``, written once,
    with the local sums of their (partition, series) run.

    With ``series_names`` the table holds the series as its integer position. ``weight_from`` is a
    column of the row key and a scale that give the weight of rows, as a rule; other weights
    stay exact too. With ``whole_scores`` the neighbours' scores are cut to integers, which
    is what curves compare (the window plan has them in full).
    """
    if series_names:
        long = encode_series(long, series_names)
    p = _range_partitions(long, partitions, len(series_names) if series_names else None)
    # Through the shuffle go no place, which both sides compute, of the weight only what the key does not
    # give, and of the positive weight only what differs from the tag's (for equal tag and weight it
    # rises alike): nothing, as a rule.
    odd = [F.col("weight").bitwiseXOR(_given(weight_from)).alias("_odd"), (F.col("weight_tag") - _usual(F.col("tag"), F.col("weight"))).alias("_differs")]
    moved = Packed(long.select(*odd, "series", "tag", "score", *keys), ["_odd", "_differs", "series", "tag"])
    back = dict(moved.columns)
    back["weight"] = back["_odd"].bitwiseXOR(_given(weight_from, back))
    place = place_of(back["series"], back["score"]) if series_names else back["series"]
    order = ["score", *keys, "tag", "weight", "_differs"]
    ranged = moved.rows.repartitionByRange(p, place, *[back[c] for c in order])
    written = ["series", "score", *keys, "tag", "_odd", "_differs"]
    pid = F.spark_partition_id().alias("_pid")
    if local == "window":
        table = _bucketed(ranged.select(*[back[c].alias(c) for c in written], pid), 4 * p)
        return _window_local_sums(_weights_back(table, weight_from), keys)
    staged = ranged.select(place.alias("_place"), *[back[c].alias(c) for c in dict.fromkeys([*written, "weight"])], pid)
    staged = staged.sortWithinPartitions("_place", *order).drop("_place")
    staged = staged.withColumn("weight_tag", F.col("_differs") + _usual(F.col("tag"), F.col("weight")))
    kind = ",".join([*(f"{n}:bigint" for n in LOCAL_COLS), "prev_score:double", "next_score:double"])
    # One call for each task, its batches in order. Row keys take no part and stay in the JVM.
    sums = F.arrow_udf(_local_sums, f"struct<{kind}>").asNondeterministic()
    summed = staged.withColumn("_sums", sums(*SUM_INPUTS)).select(*written, "_pid", "_sums.*")
    if whole_scores:
        summed = summed.withColumns({c: F.when(F.col(c).isNotNull(), to_int(F.col(c))) for c in ("prev_score", "next_score")})
    with shuffles_removed(long.sparkSession):
        table = materialize(summed, "prefix", dict(PACKING))
    return _weights_back(table, weight_from)


# Nearly all of a written table is running sums and row keys: differences pack well, dictionaries do not.
PACKING = {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2", "maxRecordsPerFile": "0"}


def _weights_back(table: DataFrame, weight_from: tuple[str, int] | None) -> DataFrame:
    """A written table with weight and positive weight in place of what was written of them."""
    weight = F.col("_odd").bitwiseXOR(_given(weight_from))
    back = {"_odd": weight.alias("weight"), "_differs": (F.col("_differs") + _usual(F.col("tag"), weight)).alias("weight_tag")}
    return table.select(*[back.get(c, F.col(c)) for c in table.columns])


def _bucketed(tagged: DataFrame, buckets: int) -> DataFrame:
    """``tagged`` written once, in buckets by ``_pid``: what groups by it needs no shuffle then.

    Each task has one ``_pid``, so it writes one file. Only tables have buckets; the name is
    dropped as soon as the plan is made, the files stay as those of ``materialize`` do.
    """
    spark = tagged.sparkSession
    path = scratch_path(spark, "ranged")
    name = "spark_catalog.default." + os.path.basename(path).replace("-", "_")
    with shuffles_removed(spark):
        (tagged.write.format("parquet").option("compression", "zstd").options(**PACKING).option("path", path)
         .bucketBy(buckets, "_pid").saveAsTable(name))
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def _halves(weight: str) -> dict[str, Column]:
    """A weight in two parts whose BIGINT sums 2^31 rows of a run cannot overflow."""
    half = wide.BITS // 2
    return {"upper": F.shiftright(weight, half), "lower": F.col(weight).bitwiseAND(F.lit((1 << half) - 1).cast("bigint"))}


def _window_local_sums(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Local sums of each (series, partition) run with built-in window functions.

    Weights are summed in halves (``_halves``) and put together as limbs.
    """
    w = Window.partitionBy("series", "_pid").orderBy("score", *keys, *VALUES)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    half = wide.BITS // 2
    mask = F.lit((1 << half) - 1).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c).over(before), zero)

    halves = {f"_{c}_{h}": total(v) for c in ("weight", "weight_tag") for h, v in _halves(c).items()}
    summed = tagged.select(
        "*",
        (F.row_number().over(w) - 1).cast("bigint").alias("loc_records"),
        total(F.col("tag").cast("bigint")).alias("loc_tag"),
        F.lag("score").over(w).alias("prev_score"),
        F.lead("score").over(w).alias("next_score"),
        *[v.alias(n) for n, v in halves.items()])
    out = {}
    for c in ("weight", "weight_tag"):
        low = F.shiftleft(F.col(f"_{c}_upper").bitwiseAND(mask), half) + F.col(f"_{c}_lower")
        out[f"loc_{c}_high"] = F.shiftright(f"_{c}_upper", half) + F.shiftright(low, wide.BITS)
        out[f"loc_{c}_low"] = low.bitwiseAND(F.lit(wide.MASK).cast("bigint"))
    return summed.withColumns(out).drop(*halves)


def offsets_of(table: DataFrame) -> DataFrame:
    """Step 4: per (partition, series) the sums before it, the scores around it, and the series totals."""
    seg = table.groupBy("_pid", "series").agg(
        F.count(F.lit(1)).alias("seg_records"),
        F.sum("tag").cast("bigint").alias("seg_tag"),
        *[F.sum(v).alias(f"seg_{c}_{h}") for c in ("weight", "weight_tag") for h, v in _halves(c).items()],
        F.min("score").alias("seg_first"),
        F.max("score").alias("seg_last"),
    ).withColumns({f"seg_{c}": wide.joined_halves(F.col(f"seg_{c}_upper"), F.col(f"seg_{c}_lower")) for c in ("weight", "weight_tag")})
    w = Window.partitionBy("series").orderBy("_pid")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("series")
    zero = F.lit(0)
    return seg.select(
        "_pid", "series",
        F.coalesce(F.sum("seg_records").over(before), zero).cast("bigint").alias("off_records"),
        F.coalesce(F.sum("seg_tag").over(before), zero).cast("bigint").alias("off_tag"),
        running_weight(F.coalesce(F.sum("seg_weight").over(before), zero)).alias("off_weight"),
        running_weight(F.coalesce(F.sum("seg_weight_tag").over(before), zero))
        .alias("off_weight_tag"),
        F.lag("seg_last").over(w).alias("prev_run_last"),
        F.lead("seg_first").over(w).alias("next_run_first"),
        F.sum("seg_records").over(whole).cast("bigint").alias("total_records"),
        F.sum("seg_tag").over(whole).cast("bigint").alias("total_pos"),
        running_weight(F.sum("seg_weight").over(whole)).alias("total_weight"),
        running_weight(F.sum("seg_weight_tag").over(whole)).alias("total_weight_pos"),
    )


def running_sums(long: DataFrame, keys: Sequence[str], method: str = "range", partitions: int | None = None,
                 series_count: int | None = None, series_names: Sequence[str] | None = None,
                 weight_from: tuple[str, int] | None = None, whole_scores: bool = False) -> Running:
    """Steps 1-4: the local sums, written, and the plan of their offsets."""
    if method not in ("range", "window"):
        raise ValueError(f"unknown prefix method {method!r}")
    names = list(series_names) if series_names else None
    count = len(names) if names else series_count
    p = _range_partitions(long, partitions, count)
    table = local_sums_table(long, keys, p, names, "arrow" if method == "range" else "window", weight_from, whole_scores)
    return Running(table, offsets_of(table), names, p * count if count else None)


def with_offsets(found: Running, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Step 5: rows with the offsets of their partition (broadcast if the bound allows)."""
    offsets = found.offsets
    if found.bound is not None and found.bound <= max_broadcast_rows:
        offsets = F.broadcast(offsets)
    return found.table.join(offsets, ["_pid", "series"])


def with_sums(found: Running, keys: Sequence[str], max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """The finished running sums of every row, weights as DECIMAL(38,0)."""
    rows = with_offsets(found, max_broadcast_rows)

    def weight(c: str) -> Column:
        return running_weight(F.col(f"off_{c}") + wide.joined(F.col(f"loc_{c}_high"), F.col(f"loc_{c}_low"))).alias(f"cum_{c}")

    return rows.select(
        decode_series(F.col("series"), found.names).alias("series"), "score", *keys, *VALUES,
        (F.col("off_records") + F.col("loc_records")).alias("cum_records"),
        (F.col("off_tag") + F.col("loc_tag")).alias("cum_tag"),
        weight("weight"), weight("weight_tag"),
        F.coalesce("prev_score", "prev_run_last").alias("prev_score"),
        F.coalesce("next_score", "next_run_first").alias("next_score"),
        *TOTAL_COLS, "_pid",
    )


def merged_partitions(table: DataFrame, keys: Sequence[str], series_names: Sequence[str] | None = None) -> DataFrame:
    """Per series: the partitions' sums merged, and how many partitions overlap the one before
    them in (score, key) order, which must be none."""
    place = F.struct("score", *keys)
    series = decode_series(F.col("series"), series_names)
    parts = table.groupBy("_pid", "series").agg(F.min(place).alias("low"), F.max(place).alias("high")).withColumn(
        "overlap", F.lag("high").over(Window.partitionBy("series").orderBy("_pid")) >= F.col("low"))
    overlaps = parts.groupBy(series.alias("series")).agg(F.count_if("overlap").alias("overlaps"))
    sums = partition_totals(table, series_names).groupBy("series").agg(
        F.sum("records").alias("records"), F.sum("pos").alias("pos"),
        F.sum("weight_sum").alias("weight_sum"), F.sum("weight_pos").alias("weight_pos"))
    return sums.join(overlaps, "series")


def partition_totals(table: DataFrame, series_names: Sequence[str] | None = None) -> DataFrame:
    """Per (partition, series) sums of a written local-sums table."""
    series = decode_series(F.col("series"), series_names)
    return table.groupBy(F.col("_pid").alias("part"), series.alias("series")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("tag").cast("bigint").alias("pos"),
        weight_sum(F.col("weight")).cast("double").alias("weight_sum"),
        weight_sum(F.col("weight_tag")).cast("double").alias("weight_pos"),
    )
