"""Benchmark: the headline queries at one scale, one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each query is run once to warm up, then BENCH_RUNS
times; the median is reported. Every output is fully computed through the
``noop`` sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modeleval.plans import catalog as K  # noqa: E402
from modeleval.plans import queries as Q  # noqa: E402
from modeleval.plans.evaluate import evaluate  # noqa: E402
from modeleval.session import local_session  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def q_evaluate_full(spark, sf):
    out = evaluate(K.lineitem(spark, sf), K.LI)
    for name in ("counters", "scores", "perf", "points", "gain_panels", "pr_roc_panels",
                 "score_histogram"):
        force(out[name])


def single(fn):
    def run(spark, sf):
        force(fn(spark, sf))
    return run


# evaluate_full covers the flagship curve points (the ``evaluate`` query) and more.
HEADLINE = {
    "evaluate_full": q_evaluate_full,
    "perf_all_range": single(Q.q_perf_all),
    "perf_all_window": single(Q.q_perf_window),
    "thin_any_metric": single(Q.q_thin_any_metric),
    "run_counters": single(Q.q_run_counters),
    "score_stats": single(Q.q_score_stats),
    "purify": single(Q.q_purify),
    "perf_events": single(Q.q_perf_events),
    "perf_labels": single(Q.q_perf_labels),
    "perf_embeddings": single(Q.q_perf_embeddings),
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), memory="16g", app="modeleval-bench")
    times: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        fn(spark, sf)  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf)
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s {[round(s, 2) for s in samples]}", file=sys.stderr)
    sf_name = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_name, "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
