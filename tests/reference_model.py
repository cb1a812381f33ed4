"""Plain-Python statement of the evaluation rules, used only as a test oracle.

Rows are sorted ascending by (score, key); sums are exclusive, the rank inclusive;
curves are the greedy folds from the highest score down.
"""

from __future__ import annotations

import math


def _div(a, b):
    return float("nan") if b == 0 else a / b


def perf_rows(rows, pos_tags, neg_tags, scale=1000):
    """rows: (key, score, tag, weight or None) -> list of perf dicts in ascending order."""
    lab = []
    for key, score, tag, w in rows:
        tag = "" if tag is None else str(tag).strip()
        if tag in pos_tags or tag in neg_tags:
            wt = scale if w is None else int(float(w) * scale)
            lab.append((score, key, 1 if tag in pos_tags else 0, wt))
    lab.sort(key=lambda r: (r[0], r[1]))
    n = len(lab)
    p = sum(r[2] for r in lab)
    W = sum(r[3] for r in lab)
    WP = sum(r[3] for r in lab if r[2])
    N, WN = n - p, W - WP
    out = []
    cr = ct = cw = cwt = 0
    for score, key, t, w in lab:
        tp, tn, fn = p - ct, cr - ct, ct
        fp = N - tn
        wtp, wtn, wfn = WP - cwt, cw - cwt, cwt
        wfp = WN - wtn
        out.append(dict(
            key=key, score=score, current_record=cr + 1, tp=tp, tn=tn, fn=fn, fp=fp,
            weight_tp=float(wtp), weight_tn=float(wtn), weight_fn=float(wfn), weight_fp=float(wfp),
            action_rate=_div(tp + fp, n), weight_action_rate=_div(wtp + wfp, W),
            recall=_div(tp, tp + fn), weight_recall=_div(wtp, wtp + wfn),
            precision=1.0 if tp + fp == 0 else tp / (tp + fp),
            weight_precision=1.0 if wtp + wfp == 0 else wtp / (wtp + wfp),
            fpr=_div(fp, fp + tn), weight_fpr=_div(wfp, wfp + wtn)))
        cr += 1
        ct += t
        cw += w
        cwt += w if t else 0
    return out


def _to_int(x):
    if math.isnan(x):
        return 0
    return max(min(int(x), 2147483647), -2147483648)


def fold_points(perf_asc, metric, buckets):
    desc = list(reversed(perf_asc))
    if not desc:
        return []
    kept = [desc[0]]
    for row in desc:
        if _to_int(row[metric] * buckets) - _to_int(kept[-1][metric] * buckets) != 0:
            kept.append(row)
    return [r["key"] for r in kept]


def fold_score_points(perf_asc):
    if not perf_asc:
        return []
    kept = [perf_asc[0]]
    for row in perf_asc:
        if _to_int(row["score"]) - _to_int(kept[-1]["score"]) != 0:
            kept.append(row)
    return [r["key"] for r in kept] + [perf_asc[-1]["key"]]
