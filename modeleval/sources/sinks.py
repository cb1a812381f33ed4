"""Writers for score rows, performance rows, sorted rows, filtered lines and curve CSVs.

Every writer is a distributed ``DataFrameWriter`` call; nothing is gathered on
the driver. Paths should sit on shared storage (see ``session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeleval.functions.stats import format_rate

# The header and column order of the curve CSV files.
CSV_HEADER = ("ActionRate", "WeightedActionRate", "Recall", "WeightedRecall", "Precision",
              "WeightedPrecision", "FPR", "WeightedFPR", "BinLowestScore")
CSV_SOURCES = ("action_rate", "weight_action_rate", "recall", "weight_recall", "precision",
               "weight_precision", "fpr", "weight_fpr")


def save_scores(scored: DataFrame, path: str, fmt: str = "parquet", mode: str = "error",
                by: Sequence[str] = ()) -> str:
    """Score rows, one file set per task (and per value of the ``by`` columns)."""
    scored.write.mode(mode).format(fmt).partitionBy(*by).save(path)
    return path


# A task meets few series: its range of rows holds one or two, and a scan task some such ranges.
SERIES_WRITERS = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def save_perf(perf: DataFrame, path: str, mode: str = "error") -> str:
    """Performance rows as Parquet, one folder per series.

    A task keeps a file open for each series it meets, so its rows are not sorted by series
    first (beyond ``SERIES_WRITERS`` the rest of its rows are). Counts of neighbouring rows
    differ little and pack well as differences; rates share their leading bytes only.
    """
    conf = perf.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, SERIES_WRITERS)
    try:
        (perf.write.mode(mode).partitionBy("series").option("compression", "zstd").option("parquet.enable.dictionary", "false")
         .option("parquet.writer.version", "v2").parquet(path))
    finally:
        conf.set(_WRITERS, before)
    return path


_SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


def save_sorted(ranked: DataFrame, path: str, partitions: int | None = None, mode: str = "error",
                ranges: str | None = None) -> str:
    """Optional dump of the per-series sorted rows (debug output), with their rank.

    ``ranked`` has ``series`` and ``current_record``. Files of a series follow each other
    in rank, and so do the rows in each file; ties of score are spread over files.

    ``ranges`` names a column of whole numbers from 0 that never falls as the rank in a series
    rises, such as the range partition ``_pid``. If files are read whole, each range of a series
    is in one task as a rule; then rows are not shuffled, and each range has a folder of its own.
    """
    conf = ranked.sparkSession.conf
    before = {name: conf.get(name) for name in _SPLITS}
    order = ["series", "current_record"]
    try:
        if ranges is not None:
            for name in _SPLITS:
                conf.set(name, 1 << 50)
        if ranges is not None and _in_one_task(ranked, ranges):
            folder = F.format_string("%010d", F.col(ranges).cast("bigint"))
            by = ["series", ranges]
            sorted_rows = ranked.withColumn(ranges, folder).sortWithinPartitions(*by, "current_record")
        else:
            rows = ranked if ranges is None else ranked.drop(ranges)
            ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
            sorted_rows, by = ranged.sortWithinPartitions(*order), ["series"]
        # Neighbouring rows differ little: differences and byte streams pack well, dictionaries do not.
        (sorted_rows.write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", 0).option("compression", "zstd")
         .option("parquet.enable.dictionary", "false").option("parquet.writer.version", "v2")
         .option("parquet.enable.bytestreamsplit", "true").parquet(path))
    finally:
        for name, value in before.items():
            conf.set(name, value)
    return path


def _in_one_task(ranked: DataFrame, ranges: str) -> bool:
    """Whether no range of a series is spread over several tasks. Reads these two columns only."""
    tasks = ranked.select("series", ranges, F.spark_partition_id().alias("_task")).groupBy("series", ranges)
    return tasks.agg(F.min("_task").alias("low"), F.max("_task").alias("high")).filter("low <> high").isEmpty()


def save_filtered(lines: DataFrame, path: str, value_col: str = "value",
                  mode: str = "error") -> str:
    """Filtered text lines, unchanged."""
    lines.select(F.col(value_col).alias("value")).write.mode(mode).text(path)
    return path


def csv_columns(points: DataFrame) -> DataFrame:
    """The nine text columns of a curve CSV, plus series, curve and seq."""
    cols = [format_rate(F.col(src)).alias(dst) for src, dst in zip(CSV_SOURCES, CSV_HEADER)]
    cols.append(F.col("score").cast("string").alias(CSV_HEADER[-1]))
    return points.select("series", "curve", "seq", *cols)


def points_csv(points: DataFrame, path: str, mode: str = "error") -> str:
    """Write each (series, curve) as CSV, rows in ``seq`` order, one folder per curve.

    A rate curve holds at most B+1 rows per series, since weights are not negative, so
    clustering each into one task is bounded by the bucket count, not by the data.
    """
    table = csv_columns(points)
    (table.repartition("series", "curve")
     .sortWithinPartitions("series", "curve", "seq")
     .drop("seq")
     .write.mode(mode).partitionBy("series", "curve")
     .option("header", True).option("quote", "").option("escapeQuotes", False)
     .csv(path))
    return path
