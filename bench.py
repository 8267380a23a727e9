"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs once to warm up and then BENCH_RUNS times (default 3); the
median counts. Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickspark.plans.catalog import catalog  # noqa: E402
from clickspark.settings import spark_session  # noqa: E402

HEADLINE = [
    "session_gaps",
    "session_starts",
    "sessionize_compat",
    "sessionize_strict",
    "sessions_total",
    "sessions_per_file",
    "sessions_by_dim",
    "median_gap_by_dim",
    "median_gap_exact",
    "median_gap_by_session",
    "median_session_duration_by_dim",
    "fold_counts",
    "fold_median_compat",
    "top_users",
    "application_run",
    "stream_counts",
    "stream_session_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = spark_session(
        "bench", f"local[{cpus}]", int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()

    def once(name: str) -> float:
        begun = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    events = queries["event_count"](spark, sf_dir).first()[0]
    # Sessions under the limit that sessions_by_dim is timed with, each once.
    by_dim = queries["sessions_by_dim"](spark, sf_dir).where("what = 'device_family'")
    starts = by_dim.groupBy().sum("qtd_session").first()[0] or 0
    counted = seconds.get("sessions_by_dim")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": events,
                "sessions_per_sec": round(starts / counted) if counted else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
