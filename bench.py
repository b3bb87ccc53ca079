"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
(default 3) timed runs. A run executes the whole plan into Spark's ``noop``
sink (nothing is collected to the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "filter_and_or", "summarize_sum", "distinct_fields", "sort_desc", "limit_first", "facets",
    "chunk_fixed", "vector_search", "bm25_search", "hybrid_search", "bucket_context",
    "memory_window", "usage_meter",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    event_dir = os.environ.get("BENCH_EVENTLOG_DIR")  # e.g. a fresh mktemp -d folder
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
             "spark.eventLog.compress": "false"} if event_dir else None

    from tessera.queries.all import REGISTRY
    from tessera.session import get_session

    spark = get_session(cpus, app="tessera-bench", shuffle_partitions=max(int(cpus), 8), extra_conf=extra)
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = REGISTRY[name]

        def once(tag: str) -> float:
            spark.sparkContext.setJobGroup(f"{name}:{tag}", name)
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once("warm")
        times[name] = round(statistics.median(once(f"run{i}") for i in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": int(cpus), "runs": runs}
    if event_dir:
        spark.stop()
        out["shuffle_mb"] = shuffle_mb(event_dir)
    print(json.dumps(out))


def shuffle_mb(event_dir: str) -> dict[str, float]:
    """Shuffle bytes written per query in its last timed run, from the event log."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    files = sorted(os.path.join(root, f) for root, _, fs in os.walk(event_dir) for f in fs if f.startswith("events"))
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    b = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if group:
                        written[group] = written.get(group, 0) + b
    last: dict[str, float] = {}
    for group, b in written.items():
        name, tag = group.split(":")
        if tag.startswith("run"):
            last[name] = round(b / 1e6, 3)
    return last


if __name__ == "__main__":
    main()
