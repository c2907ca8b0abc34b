"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query's result is fully materialised (collected) inside the timing.

Before timing, every headline query runs once, untimed, on the smallest data
set (BENCH_WARMUP_DIR, default /root/testdata/sf0.001, skipped if absent) so
that JVM code generation and JIT compilation are not charged to the first
timed query. Set BENCH_WARMUP_DIR to an empty string to time cold runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.registry import queries  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = [
    "top_ngrams",            # n-gram job over all document sentences
    "top_tokens_per_group",  # tweet job: parse, group, tokenize, popularity
    "scalar_quantiles",
    "value_histogram",
    "series_pca",
    "reconstruction_error",
    "linreg_ablation",
    "kmeans_multi",
    "depth_sweep",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    qs = queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:   # untimed warm-up on the smallest data
            qs[name](spark, warm_dir).collect()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
