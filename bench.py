"""Time the headline reports: one warm-up, then the mean of two runs each.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores.
Prints one line of JSON.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from skuloom.session import local_session

REPORTS = [*(name for name in QUERIES if name.startswith("q")), "f15_elapsed_days"]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or REPORTS
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.mean(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_report_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
