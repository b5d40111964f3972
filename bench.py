"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (folder of the tables) and ``BENCH_CPUS`` (local cores).
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. The
result is consumed in full by a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from daybook.plans.queries import QUERIES
from daybook.session import local_session

#: Not timed: their time is that of starting streams or of writing a file per page.
UNTIMED = {"page_files", "folded_choice_stream", "active_choice_stream", "observed_stream"}
HEADLINE = [name for name in QUERIES if name not in UNTIMED]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = QUERIES[name]
        times = [timed(lambda: query(spark, sf_dir)) for _ in range(runs + 1)]
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
