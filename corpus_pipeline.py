"""A training-corpus pipeline of five stages, each one operator of ``modeleval.llm``.

    quality -> near-duplicates -> decontamination -> mixing -> sharding

Each stage reads what the stage before it wrote, as Parquet; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modeleval.llm.common import table
from modeleval.llm.decontam import drop_contaminated
from modeleval.llm.minhash import drop_near_duplicates
from modeleval.llm.mixing import mix
from modeleval.llm.quality import fit, keep_quality
from modeleval.llm.queries import SHARDS, SLOTS
from modeleval.llm.sharding import shard
from modeleval.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores at 0.3 or more."""
    return keep_quality(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of least doc_id."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage near a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the sources' target weights takes it."""
    return mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their slot and shard."""
    return shard(docs, SHARDS, SLOTS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("assign_shards", assign_shards)]

#: SQL can express neither the classifier nor the edit search; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
