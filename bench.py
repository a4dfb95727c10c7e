"""Time the headline queries: one JSON line.

Each query runs from the parquet files to its full result, which is written to
a sink that keeps nothing. `BENCH_SF_DIR` and `BENCH_CPUS` choose data and cores.
The first run of a fresh session, which loads classes and starts the Python
workers, is reported apart as `first_run_seconds`; every query is then timed
once, from the parquet files on, with nothing kept from the query before.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from haulwright.plans.queries import QUERIES
from haulwright.session import local_session

HEADLINE = [
    "cycles_final",
    "cycle_change_log",
    "cycles_current",
    "cycles_final_reprocess",
    "cycles_from_payloads",
    "nearest_loader",
    "nearest_load_region",
    "dump_region_hit",
    "stop_class",
    "state_transitions",
    "telemetry_typed",
    "cycle_kpis",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores if cores.isdigit() else "8"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()  # nothing is carried from one query to the next
        return seconds

    first = timed(HEADLINE[0])
    seconds = {name: timed(name) for name in HEADLINE}
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "first_run_seconds": first,
                "telemetry_rows": events,
                "rows_per_second_full_path": round(events / seconds["cycle_change_log"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
