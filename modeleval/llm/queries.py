"""The corpus operators as registered queries with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeleval.llm import oracle as O
from modeleval.llm.alignment import alignment_report
from modeleval.llm.ann import nearest
from modeleval.llm.centroids import cluster, inertia_report
from modeleval.llm.common import table
from modeleval.llm.decontam import contaminated
from modeleval.llm.exactdedup import exact_duplicates
from modeleval.llm.minhash import near_duplicates
from modeleval.llm.mixing import mix_report
from modeleval.llm.pii import report, train
from modeleval.llm.quality import fit, score_quality
from modeleval.llm.sharding import shard
from modeleval.llm.suffixdedup import digest_kept, remove_repeats
from modeleval.llm.tokens import count_tokens
from modeleval.llm.urlfilter import filter_urls, rules_frame

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 4099
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
CENTROIDS, ROUNDS, DIMENSIONS = 40, 5, 64

#: The URL rules.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_kept(remove_repeats(table(spark, sf_dir, "documents")))


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id"), SHARDS, SLOTS)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules_frame(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return report(docs, train(docs))


def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inertia_report(cluster(table(spark, sf_dir, "embeddings"), CENTROIDS, ROUNDS, DIMENSIONS))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path(PIECES))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_decontaminate, op2_quality, op3_repeats, op4_shard, op5_mix, op6_tokens, op7_urls, op8_nearest, op9_pii, op10_near,
             op11_centroids, op12_exact, op13_align)
    import corpus_pipeline  # here, since the pipeline imports this module

    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle() -> dict[str, str]:
    return {k: v for k, v in O.sql(SHARDS, SLOTS, URL_RULES, CENTROIDS, ROUNDS, DIMENSIONS).items() if k in registry()}
