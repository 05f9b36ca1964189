"""Times every query and prints one JSON line.

Each query is run once to warm up and then ``BENCH_RUNS`` times with its whole
result materialised (``noop`` sink); the median counts. Reads
``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_RUNS`` and ``BENCH_QUERIES``
(comma-separated names, default all).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from stratamill.catalogue.queries import QUERIES
from stratamill.session import build_session


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name in names:
        seconds(QUERIES[name], spark, sf_dir)
        timed[name] = round(statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
