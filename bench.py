"""Times the headline queries and prints one JSON line.

Every query runs over whole tables of ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``;
its rows go to a sink that discards them. One run warms up, the best of the next
ones counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.plans.queries import registered  # noqa: E402
from tidelog.session import build_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidelog-bench-"),
            "spark.log.level": "ERROR",
        },
    )
    seconds = {}
    for name, query in registered().items():
        if only and name not in only:
            continue
        took = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(min(took[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_seconds_all_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
