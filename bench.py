"""Time the headline queries and a whole merge; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Every query is run once on the tables of ``WARM_DIR`` first, where they exist,
so that times are of the work and not of class loading.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame

from logtrail.plans import derived_logs, views
from logtrail.plans.merge import merge, unmerge
from logtrail.plans.store import LogStore
from logtrail.plans.table_queries import QUERIES
from logtrail.session import build_session, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = "/root/testdata/sf0.001"

# These make their own stores; the same work is timed step by step below.
WHOLE_RUNS = (
    "merge_logs",
    "merge_report",
    "unmerge_logs",
    "unmerge_and_purge",
    "unmerge_log_folders",
    "merge_by_row_month",
    "folder_scan_merge",
    "blob_and_text_cells",
    "merge_outcomes",
    "merge_preview",
    "follow_equals_merge",
    "catalog_changes",
)


def drain(df: DataFrame) -> None:
    """Compute all rows and columns, keep none."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    """Seconds that an action takes."""
    begun = time.perf_counter()
    action()
    return round(time.perf_counter() - begun, 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [name for name in QUERIES if name not in WHOLE_RUNS]
    seconds: dict[str, float] = {}
    for folder in [f for f in (WARM_DIR, SF_DIR) if Path(f).exists()]:
        for name in names:
            seconds[name] = timed(lambda name=name, folder=folder: drain(QUERIES[name].run(spark, folder)))
        steps, rates = merge_steps(spark, folder)
    queries = {**seconds, **steps}
    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                **rates,
            }
        )
    )
    spark.stop()


def merge_steps(spark, folder: str) -> tuple[dict[str, float], dict[str, float]]:
    """Times of merge, views and unmerge on log files made from the events."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    packed = scratch_path(spark, "bench-logs")
    derived_logs.log_files_from(events).write.parquet(packed)
    files = spark.read.parquet(packed)
    store = LogStore(spark, scratch_path(spark, "bench-store"))
    single = LogStore(spark, scratch_path(spark, "bench-single"))
    first = files.orderBy("path").limit(1)
    steps = {"step_merge_one_log": timed(lambda: merge(single, first))}
    steps["step_merge"] = timed(lambda: merge(store, files))
    logs = store.active_logs().count()
    rows = store.metrics().where("operation = 'write'").agg({"rows": "sum"}).first()[0]
    kpi, location = store.table("kpi"), store.table("location")
    steps["step_kpi_with_position"] = timed(lambda: drain(views.kpi_with_position(kpi, "rsrp", location)))
    steps["step_kpi_bundle"] = timed(lambda: drain(views.kpi_bundle(kpi, ["rsrp", "x_duration"], location)))
    steps["step_l3_messages"] = timed(lambda: drain(views.l3_messages(store.table("signalling"))))
    one = store.active_logs().select("log_hash").limit(1)
    steps["step_unmerge_one"] = timed(lambda: unmerge(store, one))
    steps["step_purge"] = timed(store.purge)
    rates = {
        "merged_logs": logs,
        "merged_rows": rows,
        "merge_rows_per_sec": round(rows / steps["step_merge"], 1),
        "merge_seconds_per_log": round(steps["step_merge"] / logs, 4),
    }
    return steps, rates


if __name__ == "__main__":
    main()
