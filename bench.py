"""Time the named queries at one scale factor; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected); its time is the best of ``BENCH_REPEAT``
runs (default 2) after one warm-up query. ``BENCH_QUERIES`` (comma list)
restricts the set; ``BENCH_EVENT_LOG=<folder>`` writes Spark's event log there.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Headline queries first: the flagship alert query and its building blocks.
HEADLINE = [
    "alerts",
    "window_avg",
    "alerts_hourly",
    "alerts_by_sensor",
    "window_avg_by_sensor",
    "window_avg_hourly",
    "alert_routing",
    "alert_messages",
    "decode_readings",
    "decode_event_time",
    "encode_readings",
    "stream_window_avg_update",
    "stream_alerts_update",
    "stream_alerts_append",
    "stream_alerts_by_sensor",
    "supplier_rule_hits",
    "part_rule_hits",
    "supplier_rules_csv",
    "decode_quarantine",
]
# Not timed by default: `stream_late_data` and `stream_alerts_emitted` run one
# availableNow query per 5-day period (six or seven runs here); their time
# is per-run overhead, not throughput. Add it through BENCH_QUERIES.


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from pyspark import __version__ as spark_version

    from sensorwatch.plans.queries import QUERIES
    from sensorwatch.session import local_session

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # folder for Spark's event log (stage and task times), no UI needed
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(
        cores=cpus, app="sensorwatch-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8, **extra
    )

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("window_avg")  # warm-up: JVM, code generation, file listing caches
    times = {}
    for name in names:
        times[name] = round(min(run(name) for _ in range(max(repeat, 1))), 3)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # untimed: input size for context
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "events": events,
                "events_per_sec": {k: round(events / v) for k, v in times.items() if v > 0},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "spark": spark_version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
