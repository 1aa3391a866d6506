"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how
often each query runs (the median counts, after one untimed warm-up), and
``BENCH_QUERIES`` a comma-separated list or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wagerscope.catalog import QUERIES
from wagerscope.session import build_session

HEADLINE = [
    "daily_game_aggregate",
    "daily_features",
    "streak_lengths",
    "training_features",
    "summary_features",
    "player_segments",
    "kmeans_segments",
    "weekly_by_segment",
    "risk_indicators",
    "bet_spread_by_persona",
    "pareto_curve",
    "net_histogram",
    "monthly_acquisition",
    "cohort_matrix",
    "retention_by_segment",
    "churn_status",
    "pre_churn_behaviour",
    "cohort_ltv",
    "net_growth",
    "month_export_reload",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if picked == "all" else picked.split(",") if picked else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cores": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
