"""Delimited text input: read lines, drop headers, cut lines into named fields."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def check_headers(headers: Sequence[str]) -> list[str]:
    """Reject empty or repeated header names (a driver-side schema check)."""
    names = [str(h) if h is not None else "" for h in headers]
    for h in names:
        if not h.strip():
            raise ValueError("Empty column name in the header; check the header of the input")
    seen: set[str] = set()
    dups = sorted({h for h in names if h in seen or seen.add(h)})
    if dups:
        raise ValueError(f"Repeated column names in the header: {dups}")
    return names


def scan_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per text line, column ``value``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def _literal_regex(delimiter: str) -> str:
    """A Java regex that matches ``delimiter`` literally (like Pattern.quote)."""
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    if "\\E" not in delimiter:
        return "\\Q" + delimiter + "\\E"
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in delimiter)


def split_line(value: Column, delimiter: str) -> Column:
    """Cut a line on a literal delimiter; empty tokens, trailing ones included, are kept."""
    return F.split(value, _literal_regex(delimiter), -1)


def skip_header(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop the first line of every file, whatever it says; an equal line further down stays.

    ``lines`` is a scan of text files (``scan_text``), possibly filtered by file. The place
    of a line comes from the scan: rows of a file block follow each other in a task, and
    the block at offset 0 starts with the header. One pass without a shuffle; batches
    without a first block pass through uncopied.
    """
    try:
        placed = lines.select(value_col, "_metadata.file_path", "_metadata.file_block_start")
    except AnalysisException as e:
        raise ValueError("the place of a line is only known in a scan of text files") from e
    return placed.mapInArrow(_without_first_lines, lines.select(value_col).schema)


def _without_first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of (line, file, block start) rows, without the first of each block at offset 0."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        line, path, start = batch.columns
        # Runs of equal (file, block start): few in a batch, so only their bounds are looked at.
        runs = [pc.run_end_encode(c) for c in (path, start)]
        ends = sorted({e for r in runs for e in r.run_ends.to_pylist()})
        first, keep = 0, []
        for end in ends:
            here = (path[first].as_py(), start[first].as_py())
            skip = here != before and here[1] == 0
            keep.append(line.slice(first + skip, end - first - skip))
            before, first = here, end
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(keep)], [batch.schema.names[0]])


def split_fields(lines: DataFrame, headers: Sequence[str], delimiter: str,
                 on_short_row: str = "error", value_col: str = "value",
                 keep_line: bool = False) -> DataFrame:
    """Name the fields of each line after ``headers`` (all STRING).

    Extra trailing fields are ignored. A line with fewer fields than headers
    fails the job (``error``, as the original job did), gets NULLs for the
    missing fields (``null``), or is left out (``drop``).
    """
    names = check_headers(headers)
    arr = split_line(F.col(value_col), delimiter)
    n = len(names)
    staged = lines.select(*( [F.col(value_col)] if keep_line else [] ), arr.alias("_fields"))
    size = F.size(F.col("_fields"))
    if on_short_row == "drop":
        staged = staged.filter(size >= n)
    elif on_short_row == "error":
        staged = staged.withColumn(
            "_fields",
            F.when(size < n, F.raise_error(F.concat(
                F.lit(f"row has fewer than {n} fields: "), F.col("_fields").cast("string"))))
            .otherwise(F.col("_fields")))
    elif on_short_row != "null":
        raise ValueError(f"unknown short-row policy {on_short_row!r}")
    cols = [F.get(F.col("_fields"), i).alias(name) for i, name in enumerate(names)]
    keep = [F.col(value_col)] if keep_line else []
    return staged.select(*keep, *cols)


def read_delimited(spark: SparkSession, path: str | Sequence[str], headers: Sequence[str],
                   delimiter: str, has_header: bool = False, on_short_row: str = "error",
                   keep_line: bool = False) -> DataFrame:
    """Text file(s) -> typed-as-text columns named after ``headers``."""
    lines = scan_text(spark, path)
    if has_header:
        lines = skip_header(lines)
    return split_fields(lines, headers, delimiter, on_short_row=on_short_row, keep_line=keep_line)


def header_of(spark: SparkSession, path: str | Sequence[str], delimiter: str,
              header_line: str | None = None) -> list[str]:
    """Header names from a given header line, else from the first line of the input.

    Reads a single line through ``limit(1)``; nothing else reaches the driver.
    """
    if header_line is None:
        first = scan_text(spark, path).limit(1).collect()
        if not first:
            raise ValueError("cannot read a header from empty input")
        header_line = first[0][0]
    return check_headers(header_line.split(delimiter))
