"""Times every registered query; prints one JSON line.

BENCH_SF_DIR is the folder with the tables, BENCH_CPUS the number of local cores.
The silver tables are built, and timed as ``silver_build``, before the queries that
read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from funnelspark.queries import QUERIES, silver_of


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # Without recording the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def run(job) -> float:
        start = time.perf_counter()
        job(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    registered = dict(QUERIES)
    times = {"silver_build": run(registered.pop("silver_build"))}
    silver_of(spark, sf_dir)
    for name, job in registered.items():
        times[name] = run(job)
        print(f"{name}: {times[name]}", file=sys.stderr)
    total = round(sum(times.values()), 3)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    result = {"metric": "total_query_time", "value": total, "unit": "sec"}
    print(json.dumps(result | {"queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
