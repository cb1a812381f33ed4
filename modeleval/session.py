"""Session helpers: a local session for tests and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(shared storage every executor can reach). Only a ``local[...]`` session without
that setting, as in tests, gets a folder of our own; any other master raises.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_CONF_CHECKPOINT = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  app: str = "modeleval") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_local_root: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; only a local master may go without one set."""
    global _local_root
    root = spark.sparkContext.getConf().get(_CONF_CHECKPOINT, None)
    if not root:
        # A folder set with setCheckpointDir is shared storage too.
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set and the master is {master!r}: intermediate tables "
                "need a folder that the driver and all executors share. Set spark.checkpoint.dir.")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="modeleval-ckpt-")
        root = _local_root
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


_owner: ContextVar[list[str] | None] = ContextVar("modeleval_scratch_owner", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "modeleval", f"{label}-{uuid.uuid4().hex[:12]}")
    owned = _owner.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch_owner() -> Iterator[list[str]]:
    """Collects the scratch paths handed out inside, also those of an owner further in."""
    outer, paths = _owner.get(), []
    token = _owner.set(paths)
    try:
        yield paths
    finally:
        _owner.reset(token)
        if outer is not None:
            outer.extend(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables, wherever the shared folder is. Only paths of ``scratch_path``."""
    root = os.path.join(ensure_checkpoint_dir(spark), "modeleval") + os.sep
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"not a scratch path: {path}")
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


class Run(dict):
    """The outputs of an evaluation by name, and the scratch tables that back them.

    ``close`` (or leaving a ``with`` block) deletes those tables; outputs that were written
    elsewhere stay, and the DataFrames of this run can no longer be read.
    """

    def __init__(self, spark: SparkSession, outputs: dict, paths: list[str]):
        super().__init__(outputs)
        self.spark, self.paths = spark, list(paths)

    def close(self) -> None:
        paths, self.paths = self.paths, []
        release(self.spark, paths)

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, *_) -> None:
        self.close()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files: Spark removes those of a write as soon as it is done,
    not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df, label: str, options: dict[str, str] | None = None):
    """Write ``df`` once under the shared checkpoint root and read it back.

    Cuts the lineage: later readers share the written rows instead of
    recomputing them, and a lost executor costs a re-read, not a recompute.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    return df.sparkSession.read.parquet(path)
