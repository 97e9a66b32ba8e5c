"""Time the headline queries; print one JSON line.

Each query writes its whole result to the ``noop`` sink, so nothing is pruned
away. One untimed pass warms the JVM, then the median of ``BENCH_RUNS`` counts
(streams, which run much longer, are timed once).
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewatch.plans.catalog import QUERIES  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

BATCH = (
    "score_transactions",
    "rule_high_value",
    "rule_rapid_fire",
    "rule_location",
    "rapid_fire_windows",
    "rapid_fire_user_flag",
    "parse_transactions",
    "route_rejects",
    "sink_alert_parquet",
    "sink_alert_csv",
    "report_kpis",
    "report_latest_alerts",
    "report_reason_counts",
    "report_volume_by_minute",
)
STREAMS = ("stream_foreach_batch", "stream_location", "stream_rapid_fire")


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    seconds = {}
    for name in BATCH + STREAMS:
        if only and name not in only:
            continue
        repeats = 1 if name in STREAMS else RUNS
        runs = [timed(spark, name) for _ in range(1 + repeats)][1:]
        seconds[name] = round(statistics.median(runs), 3)
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    spark.stop()
    line = {
        "metric": "headline query time, median of warm runs, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "rows": rows,
        "cpus": int(CPUS),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
