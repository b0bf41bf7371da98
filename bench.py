"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full through the no-op sink (every row is produced,
nothing is collected to the driver). The reported value is the sum of the
per-query wall times; session start-up and a warm-up pass on the smallest tables
are excluded and reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "batch_similarity",
    "hit_rate_at_k",
    "recall_at_k",
    "vector_topk_l2",
    "search_interactive",
    "found_not_found",
    "ticket_base",
    "fan_out_sources",
    "summarize_map_reduce",
    "ticket_keywords",
    "chunk_windows",
    "normalize_text",
    "embed_hashed",
    "sync_diff",
    "sync_apply",
    "flag_sync",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    t0 = time.time()
    from simtrail.plans.queries import REGISTRY
    from simtrail.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="simtrail-bench")
    startup = time.time() - t0
    # untimed warm-up on the smallest tables: JIT, Python workers, Arrow paths
    t1 = time.time()
    small = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name in ("batch_similarity", "summarize_stuff"):
        if os.path.isdir(small):
            REGISTRY[name](spark, small).write.format("noop").mode("overwrite").save()
    warmup = time.time() - t1
    times: dict[str, float] = {}
    for name in HEADLINE:
        t = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "startup_sec": round(startup, 3),
        "warmup_sec": round(warmup, 3),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
