"""Command line: ``spark-submit`` this package, or ``python -m logtrail``."""

from __future__ import annotations

import argparse
import importlib.util
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.operators.aggregates import run_summary, schema_drift, schema_fingerprints
from logtrail.operators.filters import TableFilter, parse_table_list
from logtrail.plans import merge as merging
from logtrail.plans import store as stores
from logtrail.plans import views
from logtrail.session import build_session
from logtrail.sources import log_files
from logtrail.streaming.follow import follow

GOOD = (merging.MERGED, merging.UNMERGED)


def parser() -> argparse.ArgumentParser:
    """The options."""
    p = argparse.ArgumentParser(prog="logtrail", description="Merge drive-test log files into partitioned tables.")
    p.add_argument("--azm_file", required=True, help="a log file, or a folder with log files at any depth")
    p.add_argument("--store", required=True, help="folder of the merged tables, in any Hadoop file system")
    p.add_argument("--namespace", default="public", help="all tables go under this name")
    p.add_argument("--unmerge", action="store_true", help="remove these logs from all tables")
    p.add_argument("--dry", action="store_true", help="show what a merge would do, write nothing")
    p.add_argument("--only_tables", default="", help="import only these tables, and logs")
    p.add_argument("--exclude_tables", default="", help="leave out these tables")
    p.add_argument("--import_geom_column_in_location_table_only", action="store_true")
    p.add_argument("--add_imei_id_to_all_tables", action="store_true")
    p.add_argument("--check_and_dont_create_if_empty", action="store_true")
    p.add_argument("--folder_mode_stop_on_first_failure", action="store_true")
    p.add_argument("--call_preprocess_func_in_module_before_import", help="file with preprocess(df, table)")
    p.add_argument("--move_imported_azm_files_to_folder")
    p.add_argument("--move_failed_import_azm_files_to_folder")
    p.add_argument("--daemon_mode_rerun_on_folder_after_seconds", type=int)
    p.add_argument("--checkpoint", help="checkpoint folder of the daemon mode")
    p.add_argument("--get_schema_shasum_and_exit", action="store_true")
    p.add_argument("--folder_per_log", action="store_true", help="one folder per log instead of one per batch")
    p.add_argument("--partition_by_row_month", action="store_true", help="month folders by row time")
    p.add_argument("--purge", action="store_true", help="give back the space of removed logs at the end")
    return p


def load_preprocess(path: str | None) -> Callable | None:
    """The user's ``preprocess`` from a file."""
    if not path:
        return None
    spec = importlib.util.spec_from_file_location(Path(path).stem, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.preprocess


def options_from(args: argparse.Namespace) -> merging.MergeOptions:
    """Merge options of a command line."""
    return merging.MergeOptions(
        tables=TableFilter(parse_table_list(args.only_tables), parse_table_list(args.exclude_tables)),
        location_geometry_only=args.import_geom_column_in_location_table_only,
        add_imei=args.add_imei_id_to_all_tables,
        skip_empty_tables=args.check_and_dont_create_if_empty,
        fail_fast=args.folder_mode_stop_on_first_failure,
        preprocess=load_preprocess(args.call_preprocess_func_in_module_before_import),
        move_imported_to=args.move_imported_azm_files_to_folder,
        move_failed_to=args.move_failed_import_azm_files_to_folder,
        input_root=args.azm_file,
    )


def put_out(rows: DataFrame) -> None:
    """Print all rows, a partition at a time, as tab-separated text."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def main(argv: list[str] | None = None) -> int:
    """Run; 0 when every file came through, else 1."""
    args = parser().parse_args(argv)
    if args.daemon_mode_rerun_on_folder_after_seconds is not None and (args.dry or args.unmerge):
        parser().error("the daemon mode merges: it takes neither --dry nor --unmerge")
    spark = build_session()
    layout = stores.PER_LOG if args.folder_per_log else stores.PER_BATCH
    month = stores.BY_ROW_MONTH if args.partition_by_row_month else stores.BY_LOG_MONTH
    store = stores.LogStore(spark, args.store, args.namespace, layout, month)
    if args.daemon_mode_rerun_on_folder_after_seconds is not None:
        checkpoint = args.checkpoint or f"{store.root}/checkpoint"
        seconds = args.daemon_mode_rerun_on_folder_after_seconds
        follow(store, args.azm_file, checkpoint, options_from(args), seconds).awaitTermination()
        return 0
    inputs = log_files.read_log_files(spark, args.azm_file)
    if args.get_schema_shasum_and_exit:
        prints = schema_fingerprints(log_files.schema_statements(inputs), "path")
        put_out(prints)
        put_out(schema_drift(prints))
        return 0
    if args.dry:
        outcomes, counts = merging.plan_merge(store, inputs, options_from(args))
        put_out(outcomes)
        put_out(counts.groupBy("table").agg(F.sum("rows").alias("rows")).orderBy("table"))
        return 0
    report = merging.unmerge(store, inputs) if args.unmerge else merging.merge(store, inputs, options_from(args))
    if args.purge:
        store.purge()
    put_out(run_summary(report))
    if not args.unmerge:
        put_out(views.slowest_operations(store))
    return 0 if report.where(~F.col("status").isin(*GOOD)).isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
