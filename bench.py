"""Benchmark: prints one JSON line with the seconds of every registered query.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Every query runs as registered, completely, into the no-op sink; the time is the
better of two runs, after one warm-up of the JVM on the flagship query. Queries that are whole
jobs (they stage, compute and store several times) run once. The text operators are measured
by the check tool, not here.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import facts, registry
from idlewatch.session import local_session

# Whole pipelines come last: the JVM has compiled the shared code by then.
LAST = ("hourly_utilization", "wastage_all", "wastage_units", "monthly_job")

JOBS = (
    "refresh_run", "refresh_outcomes", "late_files", "streaming_facts", "streaming_intake", "run_counts",
    "stored_units", "emptied_slice",
)


def seconds(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    queries = {name: query for name, (query, _) in registry().items()}
    seconds(facts, spark, sf_dir)
    times = {
        name: round(min(seconds(queries[name], spark, sf_dir) for _ in range(1 if name in JOBS else 2)), 3)
        for name in [n for n in queries if n not in LAST] + list(LAST)
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
