"""Times the layer jobs and every registered query; prints one JSON line.

Environment: BENCH_SF_DIR (input tables), BENCH_CPUS (local threads),
BENCH_RUNS (timed runs per query after one warm-up; the median counts) and
BENCH_ONLY (comma-separated query names).  Results go to a sink that computes
every row and column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from kerbside.operators.settle import settled
from kerbside.plans.jobs import bronze_load, gold_refresh, load_file, silver_refresh
from kerbside.plans.registry import all_queries
from kerbside.schemas import SOURCE_COLUMNS
from kerbside.session import SPREAD_CONF, build_session
from kerbside.sources.ride_csv import stamp
from kerbside.sources.ride_star import raw_rides, ride_source
from kerbside.sources.warehouse import Warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(work) -> float:
    started = time.monotonic()
    work()
    return time.monotonic() - started


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def job_times(spark) -> dict[str, float]:
    """Bronze from CSV files, and Bronze, Silver and Gold from the input tables, into empty warehouses."""
    warehouse = Warehouse(spark, tempfile.mkdtemp(prefix="bench-"))

    texts = tempfile.mkdtemp(prefix="bench-csv-")
    raw_rides(spark, SF_DIR).select(*[header for header, _, _ in SOURCE_COLUMNS]).write.mode("overwrite").option(
        "header", True).option("escape", '"').csv(texts)
    from_files = Warehouse(spark, tempfile.mkdtemp(prefix="bench-"))

    def load() -> None:
        with settled(stamp(ride_source(spark, SF_DIR), None), "prepared") as prepared:
            bronze_load(warehouse, prepared)

    return {
        "job_csv_load": seconds(lambda: load_file(from_files, texts, None)),
        "job_bronze_load": seconds(load),
        "job_silver_refresh": seconds(lambda: silver_refresh(warehouse)),
        "job_gold_refresh": seconds(lambda: gold_refresh(warehouse)),
    }


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", SPREAD_CONF: CPUS,
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    times: dict[str, float] = {}
    if not only:
        job_times(spark)  # warm-up
        times |= job_times(spark)
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        # The warm-up also builds the stored tables the query reads.
        compute(query(spark, SF_DIR))
        times[name] = statistics.median(seconds(lambda: compute(query(spark, SF_DIR))) for _ in range(RUNS))
        print(f"{name:44} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS), "runs": RUNS}))


if __name__ == "__main__":
    main()
