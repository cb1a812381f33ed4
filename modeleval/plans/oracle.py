"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain window functions over the
whole tables (``lag``/``lead`` and frames), no shared code path. Shared rules
for equal values: integer truncation with ``trunc`` (a DuckDB cast rounds),
explicit NaN for empty denominators, integer sums cast before division.
"""

from __future__ import annotations

from collections.abc import Sequence

from modeleval.plans import catalog as K

LI_KEYS = list(K.LI_KEY)
RATES = ("action_rate", "weight_action_rate", "recall", "weight_recall", "precision",
         "weight_precision", "fpr", "weight_fpr")
POINT_COLS_TAIL = ("current_record", "tp", "tn", "fn", "fp", "weight_tp", "weight_tn",
                   "weight_fn", "weight_fp", *RATES)


def _k(keys: Sequence[str]) -> str:
    return ", ".join(keys)


def _ratio(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) = 0 THEN CAST('NaN' AS DOUBLE) "
            f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END")


def _ratio1(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) = 0 THEN CAST(1.0 AS DOUBLE) "
            f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END")


def _bucket(x: str, b: int) -> str:
    return f"(CASE WHEN isnan({x}) THEN 0 ELSE CAST(trunc(({x}) * CAST({b} AS DOUBLE)) AS INTEGER) END)"


def _itrunc(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN 0 ELSE CAST(trunc({x}) AS INTEGER) END)"


# ------------------------------------------------------------------ eval set LI
LI_SCORED = """li_all AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus,
         coalesce(trim(CAST(l_returnflag AS VARCHAR)), '') AS tag,
         CAST(trunc(CAST(l_extendedprice AS DOUBLE) * CAST(1000 AS DOUBLE)) AS BIGINT) AS weight,
         CAST(l_quantity * 20 AS DOUBLE) AS model0,
         CAST(l_discount * 10000 AS DOUBLE) AS model1,
         CAST(l_extendedprice / 105 AS DOUBLE) AS model2,
         TRY_CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) AS meta_l_tax
  FROM lineitem),
li_lab AS (
  SELECT *, tag IN ('R') AS is_pos, tag IN ('N') AS is_neg,
         CASE WHEN tag IN ('R') THEN weight ELSE CAST(0 AS BIGINT) END AS weight_tag,
         greatest(model0, model1, model2) AS score_max,
         least(model0, model1, model2) AS score_min,
         (model0 + model1 + model2) / 3 AS score_avg,
         list_sort([model0, model1, model2])[2] AS score_median
  FROM li_all)"""


def _long_union(src: str, keys: Sequence[str], series: Sequence[tuple[str, str]],
                where: str = "is_pos OR is_neg") -> str:
    parts = [
        f"SELECT '{name}' AS series, CAST({col} AS DOUBLE) AS score, {_k(keys)}, "
        f"CAST(is_pos AS INTEGER) AS tag, weight, weight_tag FROM {src} WHERE {where}"
        for name, col in series
    ]
    return "\n  UNION ALL ".join(parts)


LI_SERIES = (("model0", "model0"), ("model1", "model1"), ("model2", "model2"),
             ("avg", "score_avg"), ("l_tax", "meta_l_tax"))
LI_LONG = f"""{LI_SCORED},
li_long AS (
  {_long_union('li_lab', LI_KEYS, LI_SERIES)})"""


def perf_ctes(src: str, keys: Sequence[str]) -> str:
    """CTEs ``sums`` and ``perf`` over a long table ``src``."""
    w = f"PARTITION BY series ORDER BY score, {_k(keys)}"
    before = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = "(PARTITION BY series)"
    tp, tn, fn, fp = "(p - ct)", "(cr - ct)", "ct", "((n - p) - (cr - ct))"
    wtp, wtn, wfn, wfp = "(wp - cwt)", "(cw - cwt)", "cwt", "((w - wp) - (cw - cwt))"
    return f"""sums AS (
  SELECT *,
         row_number() OVER ({w}) - 1 AS cr,
         coalesce(sum(tag) OVER {before}, 0) AS ct,
         coalesce(sum(weight) OVER {before}, 0) AS cw,
         coalesce(sum(weight_tag) OVER {before}, 0) AS cwt,
         lag(score) OVER ({w}) AS prev_score,
         lead(score) OVER ({w}) AS next_score,
         count(*) OVER {whole} AS n,
         sum(tag) OVER {whole} AS p,
         sum(weight) OVER {whole} AS w,
         sum(weight_tag) OVER {whole} AS wp
  FROM {src}),
perf AS (
  SELECT series, score, {_k(keys)}, prev_score, next_score, tag, weight, weight_tag,
         cr, ct, cw, cwt,
         CAST(cr + 1 AS BIGINT) AS current_record,
         CAST({tp} AS BIGINT) AS tp, CAST({tn} AS BIGINT) AS tn,
         CAST({fn} AS BIGINT) AS fn, CAST({fp} AS BIGINT) AS fp,
         CAST({wtp} AS DOUBLE) AS weight_tp, CAST({wtn} AS DOUBLE) AS weight_tn,
         CAST({wfn} AS DOUBLE) AS weight_fn, CAST({wfp} AS DOUBLE) AS weight_fp,
         {_ratio(f'{tp} + {fp}', 'n')} AS action_rate,
         {_ratio(f'{wtp} + {wfp}', 'w')} AS weight_action_rate,
         {_ratio(tp, f'{tp} + {fn}')} AS recall,
         {_ratio(wtp, f'{wtp} + {wfn}')} AS weight_recall,
         {_ratio1(tp, f'{tp} + {fp}')} AS precision,
         {_ratio1(wtp, f'{wtp} + {wfp}')} AS weight_precision,
         {_ratio(fp, f'{fp} + {tn}')} AS fpr,
         {_ratio(wfp, f'{wfp} + {wtn}')} AS weight_fpr
  FROM sums)"""


def _perf_cols(keys: Sequence[str]) -> str:
    return f"series, score, {_k(keys)}, " + ", ".join(POINT_COLS_TAIL)


def curve_cte(name: str, curve: str, metric: str, buckets: int, keys: Sequence[str]) -> str:
    order = f"score, {_k(keys)}"
    desc = ", ".join(["score DESC"] + [f"{k} DESC" for k in keys])
    return f"""{name}_m AS (
  SELECT *, lead({metric}) OVER (PARTITION BY series ORDER BY {order}) AS m_next FROM perf),
{name} AS (
  SELECT series, '{curve}' AS curve,
         CAST(row_number() OVER (PARTITION BY series ORDER BY {desc}) AS INTEGER) AS seq,
         score, {_k(keys)}, {', '.join(POINT_COLS_TAIL)}
  FROM {name}_m
  WHERE m_next IS NULL OR {_bucket(metric, buckets)} <> {_bucket('m_next', buckets)})"""


def score_curve_cte(keys: Sequence[str], name: str = "c_score") -> str:
    cols = f"series, score, {_k(keys)}, {', '.join(POINT_COLS_TAIL)}"
    return f"""{name}_u AS (
  SELECT {cols}, 0 AS tail FROM perf
  WHERE prev_score IS NULL OR {_itrunc('score')} <> {_itrunc('prev_score')}
  UNION ALL
  SELECT {cols}, 1 AS tail FROM perf WHERE next_score IS NULL),
{name} AS (
  SELECT series, 'score' AS curve,
         CAST(row_number() OVER (PARTITION BY series ORDER BY tail, score, {_k(keys)}) AS INTEGER) AS seq,
         score, {_k(keys)}, {', '.join(POINT_COLS_TAIL)}
  FROM {name}_u)"""


# Curve names and the rate each is thinned on.
CURVES = (("weight_gain", "weight_action_rate"), ("gain", "action_rate"),
          ("weight_recall", "weight_recall"), ("recall", "recall"),
          ("weight_roc", "weight_fpr"), ("roc", "fpr"))


def all_curves_ctes(keys: Sequence[str], buckets: int, with_score: bool = True) -> str:
    parts = [curve_cte(f"c_{c}", c, m, buckets, keys) for c, m in CURVES]
    if with_score:
        parts.append(score_curve_cte(keys))
    names = [f"c_{c}" for c, _ in CURVES] + (["c_score"] if with_score else [])
    union = "\n  UNION ALL ".join(f"SELECT * FROM {n}" for n in names)
    return ",\n".join(parts) + f",\npoints AS (\n  {union})"


def li_perf_sql(select: str) -> str:
    return f"WITH {LI_LONG},\n{perf_ctes('li_long', LI_KEYS)}\n{select}"


# ------------------------------------------------------------------ panels
# Which curve and which columns each chart panel shows.
GAIN_PANELS = (
    (0, "weight_gain", ("weight_recall", "weight_action_rate", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (1, "weight_gain", ("recall", "weight_action_rate", "weight_action_rate", "precision", "action_rate", "score")),
    (2, "gain", ("weight_recall", "action_rate", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (3, "gain", ("recall", "action_rate", "weight_action_rate", "precision", "action_rate", "score")),
    (4, "score", ("weight_recall", "score", "weight_action_rate", "weight_precision", "action_rate", "score")),
    (5, "score", ("recall", "score", "weight_action_rate", "weight_precision", "action_rate", "score")),
)
PR_ROC_PANELS = (
    (0, "weight_recall", ("weight_precision", "weight_recall", "weight_precision", "weight_recall", "weight_fpr", "weight_action_rate", "score")),
    (1, "weight_recall", ("precision", "weight_recall", "precision", "weight_recall", "weight_fpr", "weight_action_rate", "score")),
    (2, "recall", ("weight_precision", "recall", "weight_precision", "recall", "fpr", "action_rate", "score")),
    (3, "recall", ("precision", "recall", "precision", "recall", "fpr", "action_rate", "score")),
    (4, "weight_roc", ("weight_recall", "weight_fpr", "weight_recall", "weight_fpr", "weight_precision", "weight_recall", "score")),
    (5, "weight_roc", ("recall", "weight_fpr", "weight_precision", "recall", "weight_fpr", "weight_action_rate", "score")),
    (6, "roc", ("weight_recall", "fpr", "precision", "weight_recall", "fpr", "action_rate", "score")),
    (7, "roc", ("recall", "fpr", "precision", "recall", "fpr", "action_rate", "score")),
)


def _panel_select(chart: str, panel: int, curve: str, keys: Sequence[str]) -> str:
    def v(name: str) -> str:
        return f"CAST({name} AS DOUBLE)" if name == "score" else f"CAST({name} AS DOUBLE) * 100.0"
    vals = [v(k) for k in keys[:-1]]
    while len(vals) < 6:
        vals.append("CAST(NULL AS DOUBLE)")
    names = ("y", "x", "tip1", "tip2", "tip3", "tip4")
    cols = ", ".join(f"{e} AS {n}" for e, n in zip(vals, names))
    return (f"SELECT '{chart}' AS chart, {panel} AS panel, series, seq, {cols}, "
            f"CAST({keys[-1]} AS DOUBLE) AS score FROM points WHERE curve = '{curve}'")


def panels_sql(chart: str, table: Sequence) -> str:
    body = "\nUNION ALL ".join(_panel_select(chart, p, c, k) for p, c, k in table)
    return li_perf_sql(f",\n{all_curves_ctes(LI_KEYS, 10)}\n{body}")


# ------------------------------------------------------------------ text sets
ORDER_FIELDS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       printf('%.2f', o_totalprice) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority
FROM orders"""
LINE = "concat_ws('|', o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)"
PLAIN_LINES = f"WITH f AS ({ORDER_FIELDS}) SELECT {LINE} AS value FROM f"
PURIFIED = (f"WITH f AS ({ORDER_FIELDS}) SELECT {LINE} AS value FROM f "
            "WHERE TRY_CAST(o_totalprice AS DOUBLE) > 250000 AND o_orderstatus <> 'F'")


def _fmt(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN 'NaN' ELSE rtrim(rtrim(printf('%.8f', {x}), '0'), '.') END)"


def _csv_sql() -> str:
    names = ("ActionRate", "WeightedActionRate", "Recall", "WeightedRecall", "Precision",
             "WeightedPrecision", "FPR", "WeightedFPR")
    cols = ", ".join(f"{_fmt(src)} AS {dst}" for src, dst in zip(RATES, names))
    return li_perf_sql(f",\n{all_curves_ctes(LI_KEYS, 10, with_score=False)}\n"
                       f"SELECT series, curve, {cols}, CAST(score AS VARCHAR) AS BinLowestScore FROM points")


# ------------------------------------------------------------------ other eval sets
def _simple_perf_sql(base: str, key: str) -> str:
    long = f"""base AS ({base}),
long AS (
  SELECT 'model0' AS series, CAST(model0 AS DOUBLE) AS score, {key},
         CAST(is_pos AS INTEGER) AS tag, weight, weight_tag
  FROM base WHERE is_pos OR is_neg)"""
    return f"WITH {long},\n{perf_ctes('long', [key])}\nSELECT {_perf_cols([key])} FROM perf"


def _labelled(tag_expr: str, pos: Sequence[str], neg: Sequence[str]) -> str:
    p = ", ".join(f"'{t}'" for t in pos)
    n = ", ".join(f"'{t}'" for t in neg)
    return (f"coalesce(trim(CAST({tag_expr} AS VARCHAR)), '') IN ({p}) AS is_pos, "
            f"coalesce(trim(CAST({tag_expr} AS VARCHAR)), '') IN ({n}) AS is_neg, "
            f"CAST(1000 AS BIGINT) AS weight, "
            f"CASE WHEN coalesce(trim(CAST({tag_expr} AS VARCHAR)), '') IN ({p}) "
            f"THEN CAST(1000 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS weight_tag")


def lr_sql() -> str:
    z = repr(float(K.LR_INTERCEPT))
    expr = f"CAST({z} AS DOUBLE)"
    for i, w in enumerate(K.lr_weights()):
        expr = f"({expr} + CAST(embedding[{i + 1}] AS DOUBLE) * CAST({w!r} AS DOUBLE))"
    return f"round(CAST(1000.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{expr})), 6)"


EV_BASE = ("SELECT event_id, CAST(value AS DOUBLE) AS model0, "
           + _labelled("event_type", K.EV.pos_tags, K.EV.neg_tags) + " FROM events")
LB_BASE = ("SELECT d.doc_id AS doc_id, CAST(d.n_chars AS DOUBLE) AS model0, "
           + _labelled("l.quality", K.LB.pos_tags, K.LB.neg_tags)
           + " FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
EM_BASE = (f"SELECT vec_id, {lr_sql()} AS model0, "
           + _labelled("label", K.EM.pos_tags, K.EM.neg_tags) + " FROM embeddings")

OR_SCORES = ("[CAST(o_totalprice / 500 AS DOUBLE), CAST(1000 - o_totalprice / 500 AS DOUBLE), "
             "CAST(abs(o_totalprice - 250000) / 250 AS DOUBLE)]")


def oracle() -> dict[str, str]:
    keys = _k(LI_KEYS)
    pc = _perf_cols(LI_KEYS)
    sums_cols = (f"series, score, {keys}, CAST(cr AS BIGINT) AS cum_records, CAST(ct AS BIGINT) AS cum_tag, "
                 "CAST(cw AS DOUBLE) AS cum_weight, CAST(cwt AS DOUBLE) AS cum_weight_tag")
    q: dict[str, str] = {
        "scan_text": PLAIN_LINES,
        "split_fields": ORDER_FIELDS,
        "skip_header": PLAIN_LINES,
        "skip_header_by_place": (PLAIN_LINES + " UNION ALL SELECT unnest(['key|status|price|date|priority', "
                                 "'o_orderkey|o_orderstatus|o_totalprice|o_orderdate|o_orderpriority']) AS value FROM f WHERE o_orderkey::BIGINT % 50 = 0"),
        "check_headers": (f"WITH f AS ({ORDER_FIELDS}) " + " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS name, count(*) FILTER (WHERE {c} <> '') AS filled FROM f"
            for i, c in enumerate(("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))),
        "short_row_policy": (f"WITH f AS ({ORDER_FIELDS}) SELECT o_orderkey, o_orderstatus, o_totalprice, "
                             "o_orderdate, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END "
                             "AS o_orderpriority FROM f"),
        "null_to_empty": (f"WITH f AS ({ORDER_FIELDS}) SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' "
                          "THEN '' ELSE o_orderpriority END AS o_orderpriority FROM f"),
        "save_scores": (f"WITH {LI_SCORED} SELECT {keys}, tag, weight, weight_tag, model0, model1, model2, "
                        "score_max, score_min, score_avg, score_median, meta_l_tax, "
                        "TRY_CAST(l_linestatus AS DOUBLE) AS meta_l_linestatus "
                        "FROM li_lab WHERE is_pos OR is_neg"),
        "save_perf": li_perf_sql(f"SELECT {pc} FROM perf"),
        "save_sorted": li_perf_sql(f"SELECT series, {keys}, current_record, current_record AS written_rank FROM perf"),
        "save_filtered": PURIFIED,
        "points_csv": _csv_sql(),
        "purify": PURIFIED.replace("WHERE", "WHERE o_orderkey::BIGINT % 7 <> 0 AND"),
        "purify_row_errors": ("WITH v AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 3 THEN '9223372036854775807' WHEN 5 THEN 'n/a' "
                              "ELSE o_orderkey::VARCHAR END AS value, CASE o_orderkey % 10 WHEN 7 THEN '0' ELSE (o_orderkey % 3 + 1)::VARCHAR END AS divisor FROM orders) "
                              "SELECT * FROM v WHERE o_orderkey % 10 NOT IN (3, 5, 7) AND o_orderkey + 1 > 100 AND o_orderkey % (o_orderkey % 3 + 1) < 2"),
        "purify_invalid": PLAIN_LINES,
        "purifier_api": f"SELECT {keys} FROM lineitem WHERE l_quantity > 25 AND l_linestatus = 'O'",
        "labelled_only": f"WITH {LI_SCORED} SELECT {keys}, tag FROM li_lab WHERE is_pos OR is_neg",
        "perf_label_filter": (f"WITH {LI_SCORED} SELECT {keys}, model0 AS score, CAST(is_pos AS INTEGER) AS tag "
                              "FROM li_lab WHERE (is_pos OR is_neg) AND l_linenumber <> 7"),
        "row_weight": f"WITH {LI_SCORED} SELECT {keys}, weight FROM li_lab",
        "weight_tag": f"WITH {LI_SCORED} SELECT {keys}, weight_tag FROM li_lab",
        "binary_tag": (f"WITH {LI_SCORED} SELECT {keys}, CAST(is_pos AS INTEGER) AS binary_tag "
                       "FROM li_lab WHERE is_pos OR is_neg"),
        "trim_tag": f"SELECT {keys}, coalesce(trim('  ' || l_returnflag || ' '), '') AS tag FROM lineitem",
        "meta_numeric": (f"SELECT {keys}, TRY_CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) AS meta_l_tax, "
                         "TRY_CAST(l_linestatus AS DOUBLE) AS meta_l_linestatus FROM lineitem"),
        "meta_string": "SELECT o_orderkey, CAST(o_orderpriority AS VARCHAR) AS meta_o_orderpriority FROM orders",
        "score_models": f"WITH {LI_SCORED} SELECT {keys}, model0, model1, model2 FROM li_lab",
        "score_models_python": (f"SELECT {keys}, CAST(l_quantity * 10 + l_discount * 1000 AS DOUBLE) AS model0, "
                                "l_extendedprice / 128::DOUBLE AS model1, (l_discount + l_tax) * 1000 AS model2 FROM lineitem"),
        "score_models_clash": (f"SELECT {keys}, l_returnflag AS tag, CAST(trunc(l_quantity * 2 * 1000) AS BIGINT) AS weight, "
                               "CAST(l_linenumber * 10 AS DOUBLE) AS model0, l_quantity + 0.5::DOUBLE AS model1, l_quantity * 2 AS model2, "
                               "greatest(CAST(l_linenumber * 10 AS DOUBLE), l_quantity + 0.5::DOUBLE, l_quantity * 2) AS score_max, "
                               "l_tax AS meta_score_max FROM lineitem"),
        "partition_totals": (f"WITH {LI_LONG} SELECT series, count(*) AS records, CAST(sum(tag) AS BIGINT) AS pos, "
                             "CAST(sum(weight) AS DOUBLE) AS weight_sum, CAST(sum(weight_tag) AS DOUBLE) AS weight_pos, "
                             "CAST(0 AS BIGINT) AS overlaps FROM li_long GROUP BY series"),
        "score_stats": (f"WITH {LI_SCORED} SELECT {keys}, score_max, score_min, score_avg, score_median "
                        "FROM li_lab"),
        "score_lr": f"SELECT vec_id, {lr_sql()} AS model0 FROM embeddings",
        "scorer_api": f"SELECT {keys}, CAST(l_quantity * 10 + l_discount * 1000 AS DOUBLE) AS model0 FROM lineitem",
        "score_multiclass": (f"SELECT o_orderkey, {OR_SCORES} AS scores, "
                             "coalesce(trim(o_orderstatus), '') AS tag FROM orders"),
        "mode_dispatch": ("SELECT 'multiclass' AS mode, count(*) AS records FROM orders "
                          "UNION ALL SELECT 'binary' AS mode, count(*) AS records FROM lineitem"),
        "run_counters": (f"WITH {LI_SCORED} SELECT count(*) AS records, "
                         "count(*) FILTER (WHERE is_pos) AS pos, count(*) FILTER (WHERE is_neg) AS neg, "
                         "CAST(coalesce(sum(CASE WHEN is_pos THEN weight ELSE 0 END), 0) AS DOUBLE) AS weighted_pos, "
                         "CAST(coalesce(sum(CASE WHEN is_neg THEN weight ELSE 0 END), 0) AS DOUBLE) AS weighted_neg "
                         "FROM li_lab"),
        "population_totals": (f"WITH {LI_LONG} SELECT series, count(*) AS records, "
                              "CAST(sum(tag) AS BIGINT) AS pos, CAST(count(*) - sum(tag) AS BIGINT) AS neg, "
                              "CAST(sum(weight) AS DOUBLE) AS weight_sum, "
                              "CAST(sum(weight_tag) AS DOUBLE) AS weight_pos, "
                              "CAST(sum(weight) - sum(weight_tag) AS DOUBLE) AS weight_neg "
                              "FROM li_long GROUP BY series"),
        "score_range": (f"WITH {LI_LONG} SELECT series, min(score) AS min_score, max(score) AS max_score "
                        "FROM li_long GROUP BY series"),
        "missing_score_check": _missing_sql(),
        "sort_by_score": li_perf_sql(f"SELECT series, score, {keys}, current_record FROM perf"),
        "sort_by_score_ties": (f"WITH {LI_LONG},\n{perf_ctes('li_long', (*K.LI_TIES.row_key, 'tag', 'weight'))}\n"
                               f"SELECT series, score, {_k(K.LI_TIES.row_key)}, tag, weight, current_record, CAST(ct AS BIGINT) AS cum_tag, "
                               "CAST(cw AS DOUBLE) AS cum_weight, CAST(cwt AS DOUBLE) AS cum_weight_tag FROM perf"),
        "prefix_sums": li_perf_sql(f"SELECT {sums_cols} FROM perf"),
        "prefix_sums_distributed": li_perf_sql(f"SELECT {sums_cols} FROM perf"),
        "record_rank": li_perf_sql(f"SELECT series, {keys}, current_record FROM perf"),
        "confusion_counts": li_perf_sql(f"SELECT series, {keys}, tp, tn, fn, fp FROM perf"),
        "weighted_confusion": li_perf_sql(
            f"SELECT series, {keys}, weight_tp, weight_tn, weight_fn, weight_fp FROM perf"),
        "action_rate": li_perf_sql(f"SELECT series, {keys}, action_rate, weight_action_rate FROM perf"),
        "recall": li_perf_sql(f"SELECT series, {keys}, recall, weight_recall FROM perf"),
        "precision": li_perf_sql(f"SELECT series, {keys}, precision, weight_precision FROM perf"),
        "fpr": li_perf_sql(f"SELECT series, {keys}, fpr, weight_fpr FROM perf"),
        "perf_single": (f"WITH {LI_SCORED},\nli_long AS (\n  "
                        f"{_long_union('li_lab', LI_KEYS, LI_SERIES[:1])}),\n"
                        f"{perf_ctes('li_long', LI_KEYS)}\nSELECT {pc} FROM perf"),
        "perf_all": li_perf_sql(f"SELECT {pc} FROM perf"),
        "perf_window": li_perf_sql(f"SELECT {pc} FROM perf"),
        "thin_any_metric": li_perf_sql(_thin_select()),
        "point_thin": li_perf_sql(",\n" + curve_cte("pt", "weight_gain_20", "weight_action_rate", 20, LI_KEYS)
                                  + "\nSELECT * FROM pt"),
        "score_points": li_perf_sql(",\n" + score_curve_cte(LI_KEYS) + "\nSELECT * FROM c_score"),
        "top_row": li_perf_sql(f"SELECT {pc} FROM perf WHERE next_score IS NULL"),
        "bottom_row": li_perf_sql(f"SELECT {pc} FROM perf WHERE prev_score IS NULL"),
        "series_unpivot": f"WITH {LI_LONG} SELECT * FROM li_long",
        "prune_for_series": f"WITH {LI_LONG} SELECT series, score, tag, weight, weight_tag FROM li_long",
        "to_double": (f"WITH {LI_LONG} SELECT series, score, {keys}, CAST(tag AS DOUBLE) AS tag, "
                      "CAST(weight AS DOUBLE) AS weight, CAST(weight_tag AS DOUBLE) AS weight_tag FROM li_long"),
        "curve_score": li_perf_sql(",\n" + score_curve_cte(LI_KEYS) + "\nSELECT * FROM c_score"),
        "gain_panels": panels_sql("gain", GAIN_PANELS),
        "pr_roc_panels": panels_sql("pr_roc", PR_ROC_PANELS),
        "score_histogram": (f"WITH {LI_LONG} SELECT series, {_itrunc('score')} AS score_bin, "
                            "count(*) AS records FROM li_long GROUP BY ALL"),
        "evaluate": li_perf_sql(f",\n{all_curves_ctes(LI_KEYS, 10)}\nSELECT * FROM points"),
        "evaluate_text": _text_points_sql(),
        "perf_events": _simple_perf_sql(EV_BASE, "event_id"),
        "perf_labels": _simple_perf_sql(LB_BASE, "doc_id"),
        "perf_embeddings": _simple_perf_sql(EM_BASE, "vec_id"),
        "curves_events": _curves_events_sql(),
    }
    q["evaluate_counters"] = q["run_counters"]
    for curve, metric in CURVES:
        q[f"curve_{curve}"] = li_perf_sql(",\n" + curve_cte("cv", curve, metric, 10, LI_KEYS)
                                          + "\nSELECT * FROM cv")
    return q


def _text_points_sql() -> str:
    base = (f"SELECT o_orderkey, o_orderstatus = 'F' AS is_pos, o_orderstatus = 'O' AS is_neg, CAST(1000 AS BIGINT) AS weight, "
            "CASE WHEN o_orderstatus = 'F' THEN CAST(1000 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS weight_tag, "
            "CAST(o_totalprice AS DOUBLE) / 600 AS model0, CAST(length(o_orderpriority) * 50 AS DOUBLE) AS model1, "
            "(CAST(o_totalprice AS DOUBLE) / 600 + length(o_orderpriority) * 50) / 2 AS score_avg "
            f"FROM ({ORDER_FIELDS}) WHERE o_orderkey::BIGINT % 7 <> 0 AND CAST(o_totalprice AS DOUBLE) > 1000")
    long = _long_union("base", ["o_orderkey"], (("model0", "model0"), ("model1", "model1"), ("avg", "score_avg")))
    return (f"WITH base AS ({base}),\nlong AS (\n  {long}),\n{perf_ctes('long', ['o_orderkey'])},\n"
            f"{all_curves_ctes(['o_orderkey'], K.OT.buckets)}\nSELECT * FROM points")


def _thin_select() -> str:
    w = f"PARTITION BY series ORDER BY score, {_k(LI_KEYS)}"
    leads = ", ".join(f"lead({r}) OVER ({w}) AS n_{r}" for r in RATES)
    changed = " OR ".join(f"{_bucket(r, 10)} <> {_bucket('n_' + r, 10)}" for r in RATES)
    return (f",\nthin AS (SELECT *, {leads} FROM perf)\n"
            f"SELECT {_perf_cols(LI_KEYS)} FROM thin WHERE next_score IS NULL OR {changed} "
            f"OR {_itrunc('score')} <> {_itrunc('next_score')}")


def _missing_sql() -> str:
    return f"""WITH base AS (
  SELECT coalesce(trim(CAST(l_returnflag AS VARCHAR)), '') IN ('R', 'N') AS labelled,
         CAST(l_quantity * 20 AS DOUBLE) AS m0,
         CAST(NULLIF(l_discount, 0) * 10000 AS DOUBLE) AS m1,
         CAST(l_extendedprice / 105 AS DOUBLE) AS m2,
         TRY_CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) AS mt
  FROM lineitem),
s AS (
  SELECT 'model0' AS series, m0 AS score FROM base WHERE labelled
  UNION ALL SELECT 'model1', m1 FROM base WHERE labelled
  UNION ALL SELECT 'model2', m2 FROM base WHERE labelled
  UNION ALL SELECT 'avg', CASE WHEN (m0 IS NOT NULL)::INT + (m1 IS NOT NULL)::INT + (m2 IS NOT NULL)::INT = 0
                     THEN NULL ELSE 0.0 END FROM base WHERE labelled
  UNION ALL SELECT 'l_tax', mt FROM base WHERE labelled)
SELECT series, count(*) AS rows, count(*) FILTER (WHERE score IS NULL) AS missing FROM s GROUP BY series"""


def _curves_events_sql() -> str:
    long = f"""base AS ({EV_BASE}),
long AS (
  SELECT 'model0' AS series, CAST(model0 AS DOUBLE) AS score, event_id,
         CAST(is_pos AS INTEGER) AS tag, weight, weight_tag
  FROM base WHERE is_pos OR is_neg)"""
    return (f"WITH {long},\n{perf_ctes('long', ['event_id'])},\n"
            f"{all_curves_ctes(['event_id'], K.EV.buckets)}\nSELECT * FROM points")
