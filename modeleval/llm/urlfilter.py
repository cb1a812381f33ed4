"""URL filter lists by host-suffix and path-prefix expressions.

A URL becomes expressions "host suffix + path prefix". Both the URL's and the rules'
expressions are digested; short digest prefixes are joined by equality, the full
digests are then compared, and the longest fitting rule wins. URLs are judged once per
distinct (host, path) pair, so a hot URL costs one look-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8
MAX_BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs such as ``("allow", "example.com/en/")`` as a table."""
    pairs = [F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Each distinct (host, path) of ``pages`` with ``rule`` and ``verdict``.

    A rule ``host/path`` fits its host and every subdomain when the URL's path starts
    with the rule's path; the longest rule wins, of equally long ones the first by text.
    No fitting rule: ``rule`` is null and the verdict is ``default``. A null URL and one
    without ``://`` have empty host and path. A rule without a slash fits any path of
    its host; null rules are ignored.

    The rules' shapes (labels in the host, characters in the path) decide which
    expressions a URL gets, so very long hosts or paths cost no more than short ones.
    The rules are broadcast only up to ``MAX_BROADCAST_RULES``, else shuffled.
    """
    rules = rules.filter(F.col("rule").isNotNull()).select(
        F.col("verdict"), F.col("rule"),
        F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("__host"),
        F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)").alias("__path"),
    ).withColumn("__digest", _digest(F.col("__host"), F.col("__path"))).withColumn(
        "__prefix", F.substring("__digest", 1, PREFIX_HEX))
    shape = F.struct(F.size(F.split("__host", r"\.")).alias("labels"), F.length("__path").alias("chars"))
    # At most labels x path lengths, both bounded by the longest URL a rule may name.
    shapes, n_rules = rules.agg(F.collect_set(shape), F.count(F.lit(1))).first()
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    if not shapes:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = F.split("host", r"\.")
    made = F.transform(
        F.filter(F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars")) for s in sorted(shapes)]),
                 lambda s: (s.labels <= F.size(labels)) & (s.chars <= F.length("path"))),
        lambda s: _digest(F.array_join(F.slice(labels, F.size(labels) - s.labels + 1, s.labels), "."),
                          F.substring(F.col("path"), F.lit(1), s.chars)))
    made = urls.select("host", "path", F.explode(made).alias("__made")).withColumn(
        "__prefix", F.substring("__made", 1, PREFIX_HEX))
    side = F.broadcast(rules) if n_rules <= MAX_BROADCAST_RULES else rules
    fits = (made.join(side, "__prefix").filter(F.col("__made") == F.col("__digest"))
            .groupBy("host", "path")
            .agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), F.col("rule"), F.col("verdict"))).alias("__best")))
    return fits.select("host", "path", "__best.rule", "__best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (input columns of
    these names are replaced). Repeated rows stay; an empty table gives an empty result."""
    own = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c not in own]
    fits = judge_urls(pages, rules, url_col, default)
    rows = pages.select(*[f"`{c}`" for c in keep], host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    joined = rows.alias("u").join(fits.alias("f"), (F.col("u.host") == F.col("f.host")) & (F.col("u.path") == F.col("f.path")), "left")
    return joined.select(*[f"u.`{c}`" for c in keep], "u.host", "u.path", "f.rule",
                         F.coalesce("f.verdict", F.lit(default)).alias("verdict"))
