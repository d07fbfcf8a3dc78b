"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 2, after one warm-up). Results go to the no-op sink, so every row is computed
and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from candleworks.catalog.queries import QUERIES
from candleworks.session import local_session

HEADLINE = [
    "ana_summary",
    "ana_summary_by_supplier",
    "ana_volatility",
    "ana_drawdown",
    "ana_weekly_return",
    "ana_volume_stats",
    "ana_correlation",
    "ft_sma",
    "ft_ema",
    "ft_all",
    "vr_price_nonpositive",
    "vr_iqr_outlier",
    "vr_issues",
    "vr_summary",
    "fix_interpolate",
    "set_merge_upsert",
    "dq_orig_vs_corrected",
    "fm_all",
    "fc_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cores": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
