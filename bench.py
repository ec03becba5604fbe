"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is executed to completion with the
``noop`` sink (full computation, nothing collected).  Per query: one warm-up
run, then $BENCH_REPEATS timed runs (default 3); the median is reported
is cleared, so no run reuses another run's intermediate results.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidalrec.plans import catalog  # noqa: E402
from tidalrec.plans.catalog import QUERIES  # noqa: E402
from tidalrec.session import get_session  # noqa: E402

HEADLINE = [
    "time_split_rows",            # split
    "vocab_fit_tail",             # vocabulary fit
    "dense_fit",                  # scaler fit
    "encode_items",               # encoded store build
    "encode_users",
    "train_rows_labeled",         # training rows with 2 negatives
    "tower_embed",                # tower embedding
    "popularity_topk_unseen",     # all-user top-k without seen items
    "score_all_topk",             # all-user exact top-k by tower scores
    "ranking_metrics_macro",      # ranking metrics at 5/10/20
    "two_stage_recommend",        # retrieve -> re-rank
    "latest_interaction_orders",
    "vector_topk",
    "end_to_end_train_pass",      # split -> fit -> encode -> train rows -> one training pass
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    def run(name: str) -> float:
        spark.catalog.clearCache()
        t0 = time.time()
        fn = QUERIES.get(name) or getattr(catalog, name)
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    times, failed = {}, {}
    for name in only or HEADLINE:
        try:
            run(name)  # warm-up
            times[name] = round(statistics.median(run(name) for _ in range(max(1, repeats))), 3)
        except Exception as e:  # noqa: BLE001 - keep measuring the other queries
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "repeats": repeats}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
