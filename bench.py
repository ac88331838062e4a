"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from partura.plans.queries import all_queries  # noqa: E402

HEADLINE = (
    "raw_events",
    "event_timeline",
    "valid_outcomes",
    "revised_timeline",
    "term_marker_counts",
    "episode_all_starts",
    "pregnancy_episodes",
)
WARM_RUNS = 2


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("partura-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # Per-person work is bound by CPU and not by bytes: keep a partition per core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of columns are for debugging and cost a round trip per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, query, sf_dir: str) -> float:
    """Build, plan and run; every row is produced and dropped."""
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    first = {name: round(timed(spark, queries[name], sf_dir), 3) for name in HEADLINE}
    warm = {
        name: round(min(timed(spark, queries[name], sf_dir) for _ in range(WARM_RUNS)), 3)
        for name in HEADLINE
    }
    spark.stop()
    report = {
        "metric": "total seconds over headline queries, best warm run of each",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "first_run": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
