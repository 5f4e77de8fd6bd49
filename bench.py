"""Time every registered query and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs
after one warm-up; BENCH_QUERIES (comma-separated) limits the run to some queries. Each
query is timed from building its plan to the last row, and written to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyworks.plans import registry
from tallyworks.settings import MEGABYTE, session_settings

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Queries that load several batches each; timed once and beside the total.
COMPOSITE = ("merged_profile", "sales_batches", "cached_rates")


def session() -> SparkSession:
    """A session with the settings that fit the tables, in parts of which each core has one at least."""
    cores = int(CPUS)
    size = sum(file.stat().st_size for file in Path(SF_DIR).rglob("*.parquet") if file.is_file())
    fitting = session_settings(size, cores, max(MEGABYTE, size // cores))
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallyworks-bench")
        .config("spark.driver.memory", "8g")
        .config(map=fitting)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(step) -> float:
    started = time.monotonic()
    step()
    return time.monotonic() - started


def main() -> None:
    spark = session()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    prepare = {"derive_raw": timed(lambda: registry.raw(spark, SF_DIR))}
    jobs_before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    prepare["pipeline_first_run"] = timed(lambda: registry.loaded_run(spark, SF_DIR))
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - jobs_before
    times = {"pipeline": statistics.median(timed(lambda: registry.load(spark, SF_DIR)) for _ in range(RUNS))}
    composite = {}
    for name, query in registry.queries().items():
        if wanted and name not in wanted:
            continue
        if name in COMPOSITE:
            composite[name] = timed(lambda: consume(query(spark, SF_DIR)))
            continue
        consume(query(spark, SF_DIR))
        times[name] = statistics.median(timed(lambda: consume(query(spark, SF_DIR))) for _ in range(RUNS))
    result = {
        "metric": "total time of the pipeline and all queries, median per query",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "composite": {name: round(seconds, 3) for name, seconds in composite.items()},
        "prepare": {name: round(seconds, 3) for name, seconds in prepare.items()},
        "pipeline_jobs": jobs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
