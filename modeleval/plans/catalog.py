"""Eval sets over the driver's test tables, and text inputs derived from them.

Every set reads whole tables; the text sets are written by Spark from
``orders`` into the shared scratch folder, so they grow with the data.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeleval.operators.scoring import ExprScorer, LogitScorer, PandasScorer
from modeleval.session import scratch_path
from modeleval.spec import EvalSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- eval set LI
LI_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
LI_MODELS = ("l_quantity * 20", "l_discount * 10000", "l_extendedprice / 105")

LI = EvalSpec(
    target="l_returnflag", pos_tags=("R",), neg_tags=("N",),
    row_key=LI_KEY,
    scorers=tuple(ExprScorer(m) for m in LI_MODELS),
    weight_col="l_extendedprice",
    meta_cols=("l_linestatus",),
    score_meta_cols=("l_tax",),
    buckets=10,
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


# The same set with row keys that many rows share.
LI_TIES = LI.with_(row_key=("l_linenumber", "l_suppkey"))


# ---------------------------------------------------------------- eval set EV
EV = EvalSpec(
    target="event_type", pos_tags=("purchase",), neg_tags=("view", "signup", "click", "error"),
    row_key=("event_id",),
    scorers=(ExprScorer("value"),),
    buckets=10,
)


# ---------------------------------------------------------------- eval set LB
LB = EvalSpec(
    target="quality", pos_tags=("1",), neg_tags=("0",),
    row_key=("doc_id",),
    scorers=(ExprScorer("n_chars"),),
    buckets=10,
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels (inner join on doc_id; Catalyst picks the strategy)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id")


# ---------------------------------------------------------------- eval set EM
EMB_DIM = 64


def lr_weights(dim: int = EMB_DIM) -> tuple[float, ...]:
    """Weights of the embedding LR scorer, from a rule: ((7 i) mod 11 - 5) / 10."""
    return tuple(((7 * i) % 11 - 5) / 10.0 for i in range(dim))


LR_INTERCEPT = 0.25
EM_SCORER = LogitScorer(weights=lr_weights(), intercept=LR_INTERCEPT, array_col="embedding",
                        scale=1000.0, digits=6)
EM = EvalSpec(
    target="label", pos_tags=("0",), neg_tags=tuple(str(i) for i in range(1, 10)),
    row_key=("vec_id",),
    scorers=(EM_SCORER,),
    buckets=10,
)


# ---------------------------------------------------------------- multi-class OR
OR_MODELS = ("o_totalprice / 500", "1000 - o_totalprice / 500", "abs(o_totalprice - 250000) / 250")
OR = EvalSpec(
    target="o_orderstatus", pos_tags=("F", "O", "P"), neg_tags=(),
    row_key=("o_orderkey",),
    scorers=tuple(ExprScorer(m) for m in OR_MODELS),
    meta_cols=("o_orderpriority",),
    multiclass=True,
)


# ---------------------------------------------------------------- pandas scorer
def _linear_predict(model, frame):
    return frame["l_quantity"] * 10 + frame["l_discount"] * 1000


PANDAS_SCORER = PandasScorer(inputs=("l_quantity", "l_discount"), predict=_linear_predict)


def _ratio_predict(model, frame):
    return frame["l_extendedprice"] / model


PYTHON_SCORERS = (PANDAS_SCORER, PandasScorer(inputs=("l_extendedprice",), predict=_ratio_predict, load=lambda: 128.0),
                  PandasScorer(inputs=("l_discount", "l_tax"), predict=lambda model, frame: (frame["l_discount"] + frame["l_tax"]) * 1000))


# ---------------------------------------------------------------- text sets
TEXT_HEADERS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ODD_HEADERS = ("key", "status", "price", "date", "priority")
DELIM = "|"


def order_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as five text fields; the priority is empty for status 'P'."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_orderstatus"),
        F.format_string("%.2f", F.col("o_totalprice")).alias("o_totalprice"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
    )


# ---------------------------------------------------------------- eval set OT (text)
OT = EvalSpec(
    target="o_orderstatus", pos_tags=("F",), neg_tags=("O",),
    row_key=("o_orderkey",),
    scorers=(ExprScorer("double(o_totalprice) / 600"), ExprScorer("length(o_orderpriority) * 50")),
    condition="double(o_totalprice) > 1000", on_row_error="drop", on_short_row="drop",
    buckets=10,
)


_text_cache: dict[tuple[str, str, str], str] = {}
_text_lock = threading.Lock()


def text_set(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of a text set written from ``orders`` (written once per session).

    ``plain``   one line per order, no header;
    ``header``  the same lines as CSV-style files, each starting with the header line;
    ``short``   like ``plain`` but lines of status 'F' lack the last field;
    ``bad``     like ``header``, but every seventh order's price is ``n/a``;
    ``odd``     files that start with the names ``key|status|price|date|priority``, with a line
                equal to that and one equal to the joined headers for every 50th order.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _text_lock:
        if key in _text_cache:
            return _text_cache[key]
        fields = order_fields(spark, sf_dir)
        path = scratch_path(spark, f"text-{kind}")
        if kind == "plain":
            fields.select(F.concat_ws(DELIM, *TEXT_HEADERS).alias("value")).write.text(path)
        elif kind == "short":
            full = F.concat_ws(DELIM, *TEXT_HEADERS)
            short = F.concat_ws(DELIM, *TEXT_HEADERS[:-1])
            fields.select(F.when(F.col("o_orderstatus") == "F", short).otherwise(full)
                          .alias("value")).write.text(path)
        elif kind == "odd":
            names = ODD_HEADERS
            twice = fields.filter(F.col("o_orderkey").cast("long") % 50 == 0).select(
                F.explode(F.array(*[F.struct(*[F.lit(n).alias(c) for n, c in zip(line, names)]) for line in (ODD_HEADERS, TEXT_HEADERS)])).alias("l")).select("l.*")
            (fields.toDF(*names).unionByName(twice).repartition(5).write.option("header", True).option("sep", DELIM)
             .option("quote", "").option("escapeQuotes", False).option("emptyValue", "").option("nullValue", "").csv(path))
        elif kind in ("header", "bad"):
            if kind == "bad":
                fields = fields.withColumn("o_totalprice", F.when(F.col("o_orderkey").cast("long") % 7 == 0, F.lit("n/a"))
                                           .otherwise(F.col("o_totalprice")))
            (fields.write.option("header", True).option("sep", DELIM)
             .option("quote", "").option("escapeQuotes", False)
             .option("emptyValue", "").option("nullValue", "")
             .csv(path))
        else:
            raise ValueError(f"unknown text set {kind!r}")
        _text_cache[key] = path
        return path
