"""Merge and unmerge of logs: M1–M13, T2, T3, U1.

A merge runs in four steps, each ending in a table on the shared file system,
so a lost executor costs tasks and not the batch:

1. decode every file once into staging, one folder per source table;
2. decide per file what happens to it. All files that could be merged, copies of
   one log too, are checked for bad cells at once, in one scan of the rows that
   decoding left in doubt; then the first good file of each log is taken;
3. per source table: type, clamp and write the rows of accepted logs. Types and
   columns of the store follow from accepted files alone;
4. publish the logs, and with them their schema changes, by one ledger append.

Facts are joined with the accepted files by (file, chunk). A chunk holds a
bounded number of rows, so one huge log is many keys.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail.functions import cleaning, identity
from logtrail.functions.types import unused
from logtrail.operators import aggregates, filters, joins
from logtrail.operators.evolution import conform
from logtrail import files as folders
from logtrail.plans import store as stores
from logtrail.plans.store import LogStore
from logtrail.session import scratch_path
from logtrail.sources import log_files, typed_rows
from logtrail.sources.typed_rows import TableColumns

# Outcomes of a file.
MERGED, ALREADY_MERGED, UNMERGED = "merged", "already_merged", "unmerged"
NOT_PRESENT, EMPTY_TARGET, FAILED = "not_present", "empty_target", "failed"
UNREADABLE, INVALID_IDENTITY = "unreadable", "invalid_identity"
NO_START_TIME, NO_END_TIME, NOT_ATTEMPTED = "no_start_time", "no_end_time", "not_attempted"

IMEI_COLUMN = "imei_id"
# What rows carry of their file, in one struct column beside the source's.
OWN = "_own"
# Columns that the store adds itself; a source that has one of them fails.
RESERVED = (stores.BY_LOG_MONTH, stores.BY_ROW_MONTH, "batch_id")


class MergeFailed(RuntimeError):
    """A file failed and the caller asked to stop there."""


@dataclass(frozen=True)
class MergeOptions:
    """What to import and how.

    ``preprocess(df, table)`` gets the rows of one table as text columns, blob
    columns as bytes, with ``log_hash`` and a struct column ``_own`` (with more
    underscores where the source has one), both of which it has to keep. It
    gives back the rows to import, with columns of its own where it adds some
    (U1). Inputs that are moved keep their place below ``input_root``.
    """

    tables: filters.TableFilter = field(default_factory=filters.TableFilter)
    location_geometry_only: bool = False
    margin_hours: int = fixed.CLAMP_MARGIN_HOURS
    strip_band: bool = False
    keep_tables_without_time: bool = False
    skip_empty_tables: bool = False
    add_imei: bool = False
    bad_cells_fail_log: bool = True
    preprocess: Callable[[DataFrame, str], DataFrame] | None = None
    fail_fast: bool = False
    move_imported_to: str | None = None
    move_failed_to: str | None = None
    input_root: str | None = None
    parallel_tables: int = 8
    keep_staging: bool = False


# Step 1: staging --------------------------------------------------------


def _spread(files: DataFrame) -> DataFrame:
    """Files over at least as many tasks as can run at once; where there are as many, nothing moves."""
    at_once = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(at_once, "path") if files.rdd.getNumPartitions() < at_once else files


def _decoded(files: DataFrame, options: MergeOptions) -> DataFrame:
    also = (fixed.LOGS_TABLE, fixed.HEARTBEAT_TABLE)
    if options.add_imei:
        also += (fixed.LOG_INFO_TABLE,)
    return log_files.decode(_spread(files), options.tables, options.location_geometry_only, also)


def stage(store: LogStore, files: DataFrame, options: MergeOptions, path: str) -> DataFrame:
    """Decode files into a written staging table, one folder per source table.

    Every decode task writes its own files: the decoded rows are not shuffled.
    """
    _decoded(files, options).write.mode("overwrite").partitionBy("table_name").parquet(path)
    return store.spark.read.schema(log_files.DECODED_SCHEMA).parquet(path)


def of_table(rows: DataFrame, table: str) -> DataFrame:
    """Decoded rows of one table; prunes to its folder on staging."""
    return rows.where(F.col("table_name") == table)


# Step 2: identity and outcome -------------------------------------------


def read_identity(rows: DataFrame, add_imei: bool = False) -> DataFrame:
    """One row per file: identity, time range, version, size and what is wrong with it.

    One scan of a few small tables and one pre-aggregated shuffle on the file.
    The decoder numbers rows, so the first row of ``logs`` (G7) is row 0.
    """
    kinds = (log_files.FILE_ROWS, log_files.SUMMARY_ROWS, log_files.COLUMN_ROWS, fixed.LOGS_TABLE, fixed.HEARTBEAT_TABLE)
    kind, note = F.col("table_name"), F.col("note")
    is_log = (kind == fixed.LOGS_TABLE) & (F.col("row_no") == 0)
    found = (
        rows.where(kind.isin(*kinds))
        .groupBy("path")
        .agg(
            F.max(F.when(kind == log_files.FILE_ROWS, log_files.cell("error"))).alias("error"),
            F.max(F.when(kind == log_files.SUMMARY_ROWS, log_files.cell("rows").cast("bigint"))).alias("rows"),
            F.max(F.when(kind == log_files.SUMMARY_ROWS, log_files.cell("doubt").cast("bigint"))).alias("doubt"),
            F.max(F.when(kind == fixed.HEARTBEAT_TABLE, cleaning.to_time(F.col("time_text")))).alias("last_heartbeat"),
            F.max(F.when(_unfit(), F.concat(log_files.cell("table"), F.lit(": "), log_files.cell("column")))).alias("unfit"),
            F.any_value(F.when(is_log, note), F.lit(True)).alias("log"),
        )
    )
    offset = log_files.cell("log_timezone_offset", "log").try_cast("bigint")
    log_hash = log_files.cell("log_hash", "log").try_cast("bigint")
    result = found.select(
        "path",
        F.coalesce("error", F.concat(F.lit("reserved column name in "), "unfit")).alias("error"),
        "rows",
        "doubt",
        log_hash.alias("log_hash"),
        identity.log_month(log_hash, offset).alias("log_ym"),
        cleaning.to_time(log_files.cell("log_start_time", "log")).alias("start"),
        F.coalesce(cleaning.to_time(log_files.cell("log_end_time", "log")), F.col("last_heartbeat")).alias("end"),
        identity.app_version(log_files.cell("log_app_version", "log")).alias("app_version"),
    )
    if add_imei:
        result = result.join(_imei_per_file(rows), "path", "left")
    lacking = _without_symbol(rows).withColumn("_lacks", F.lit("signalling: no symbol column"))
    result = result.join(lacking, "path", "left").withColumn("error", F.coalesce("error", "_lacks")).drop("_lacks")
    return result.withColumn("problem", identity_problem())


def _unfit() -> Column:
    """Whether a catalog row names a column that only the store may have."""
    return (F.col("table_name") == log_files.COLUMN_ROWS) & log_files.cell("column").isin(*RESERVED)


def _without_symbol(rows: DataFrame) -> DataFrame:
    """Files whose signalling table lacks the column that tells the direction."""
    found = of_table(rows, log_files.COLUMN_ROWS).where(log_files.cell("table") == fixed.SIGNALLING_TABLE)
    has = F.max((log_files.cell("column") == "symbol").cast("int"))
    return found.groupBy("path").agg(has.alias("_symbol")).where(F.col("_symbol") == 0).drop("_symbol")


def _imei_per_file(rows: DataFrame) -> DataFrame:
    info = of_table(rows, fixed.LOG_INFO_TABLE)
    flat = info.select("path", "row_no", log_files.cell("imei").alias("IMEI"), log_files.cell("seqid").try_cast("bigint").alias("seqid"))
    return aggregates.latest_nonempty(flat, "IMEI", ["seqid", "row_no"], "path").withColumnRenamed("IMEI", IMEI_COLUMN)


def identity_problem() -> Column:
    """Outcome of a file that cannot be merged, null when it can."""
    return (
        F.when(F.col("error").isNotNull(), UNREADABLE)
        .when(F.coalesce("log_hash", F.lit(0)) == 0, INVALID_IDENTITY)
        .when(F.col("log_ym").isNull(), INVALID_IDENTITY)
        .when(F.col("start").isNull(), NO_START_TIME)
        .when(F.col("end").isNull(), NO_END_TIME)
    )


def outcome(present: Column, target_exists: Column, unmerge: bool) -> Column:
    """Decision for a log with a good identity (M1)."""
    if unmerge:
        return F.when(~target_exists, EMPTY_TARGET).when(present, UNMERGED).otherwise(NOT_PRESENT)
    return F.when(target_exists & present, ALREADY_MERGED).otherwise(MERGED)


def decide(files: DataFrame, active: DataFrame, target_exists: bool, fail_fast: bool = False) -> DataFrame:
    """Every file with its ``status``.

    Only the first good file of a log is looked up in the ledger, and the
    verdict comes back by file name: copies of one log never pile up on its key.
    """
    first = joins.first_files(files.where(F.col("problem").isNull()))
    known = active.select("log_hash", F.lit(True).alias("_present"))
    looked_up = first.join(known, "log_hash", "left")
    verdict = looked_up.select("path", F.coalesce("_present", F.lit(False)).alias("_present"))
    status = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("_present").isNull(), ALREADY_MERGED)
        .otherwise(outcome(F.col("_present"), F.lit(target_exists), unmerge=False))
    )
    decided = files.join(verdict, "path", "left").withColumn("status", status).drop("_present")
    if not fail_fast:
        return decided
    stop = decided.where(F.col("status") != MERGED).agg(F.min("path")).first()[0]
    if stop is None:
        return decided
    return decided.withColumn("status", F.when(F.col("path") > stop, NOT_ATTEMPTED).otherwise(F.col("status")))


# Step 3: typed facts ----------------------------------------------------


def source_columns(rows: DataFrame, accepted: DataFrame) -> dict[str, TableColumns]:
    """Columns of all tables of the accepted files.

    What comes back is one row per column of each distinct table layout, not per file.
    """
    names = ("table", "layout", "column", "declared", "ordinal")
    catalog = (
        of_table(rows, log_files.COLUMN_ROWS)
        .join(accepted.select("path"), "path", "left_semi")
        .select(*[log_files.cell(n).alias(n) for n in names])
        .distinct()
    )
    layouts: dict[tuple[str, str], list[tuple[int, str, str]]] = {}
    for row in catalog.collect():
        layouts.setdefault((row.table, row.layout), []).append((int(row.ordinal), row.column, row.declared))
    tables: dict[str, TableColumns] = {}
    # Columns that most files have come first, whatever the order of files.
    for (table, layout), listed in sorted(layouts.items(), key=lambda item: (item[0][0], len(item[1]), item[1])):
        tables.setdefault(table, TableColumns(table)).add_layout(layout, [(c, d) for _, c, d in sorted(listed)])
    return tables


def table_summaries(rows: DataFrame) -> DataFrame:
    """Rows read per file and table, rows in doubt, odd storage classes and read errors."""
    cells = {n: log_files.cell(n) for n in ("table", "rows", "doubt", "odd", "error")}
    return of_table(rows, log_files.SUMMARY_ROWS).select("path", *[(c.cast("bigint") if n in ("rows", "doubt") else c).alias(n) for n, c in cells.items()])


def _chunk_count() -> Column:
    return F.floor(F.coalesce("rows", F.lit(0)) / log_files.CHUNK_ROWS).cast("int") + 1


def chunks_of(accepted: DataFrame, hours: int) -> DataFrame:
    """Accepted files with their time bounds, one row per chunk that their largest table can have."""
    chunks = F.explode(F.sequence(F.lit(0), _chunk_count() - 1)).alias("chunk")
    low, high = filters.log_bounds(F.col("start"), F.col("end"), hours)
    kept = [c for c in accepted.columns if c not in ("status", "problem", "error", "rows", "doubt", "end")]
    return accepted.select(*kept, low.alias("low"), high.alias("high"), chunks)


def facts(rows: DataFrame, chunks: DataFrame, columns: TableColumns, options: MergeOptions) -> tuple[DataFrame, str]:
    """Rows of one table that are imported, source columns as text, and the name of the struct with all else."""
    table = columns.table
    joined = of_table(rows, table).drop("table_name", "note", "doubt").join(chunks, ["path", "chunk"], "inner")
    clamped = table != fixed.LOGS_TABLE
    if clamped and options.preprocess is None:
        joined = joined.where(_kept(cleaning.to_time(F.col("time_text")), F.struct("has_time", "low", "high"), options))
    joined = joined.where(filters.version_gate(F.lit(table), F.col("app_version")))
    own = unused(list(columns.declared), OWN)
    carried = [c for c in joined.columns if c not in ("log_hash", "cells")]
    text = typed_rows.parse_cells(joined.select("log_hash", F.struct(*carried).alias(own), "cells", "layout"), columns)
    if options.preprocess is not None:
        text = text.transform(options.preprocess, table)
        if clamped:
            kept = F.col(own)
            if "time" in text.columns:
                # The hook may have made the time: then the row has one, whatever the source had.
                kept = kept.withField("has_time", F.lit(True))
            text = text.where(_kept(_time_of(text), kept, options))
    return text, own


def typed_facts(
    rows: DataFrame, chunks: DataFrame, columns: TableColumns, target: dict[str, str], options: MergeOptions, month: str
) -> tuple[DataFrame, str]:
    """Rows of one table, clean and typed, with log and month, and the name of their chunk column."""
    text, own = facts(rows, chunks, columns, options)
    if options.add_imei and IMEI_COLUMN not in columns.declared:
        text = text.withColumn(IMEI_COLUMN, F.col(own)[IMEI_COLUMN])
    when = F.col(own)["log_ym"]
    if month == stores.BY_ROW_MONTH:
        when = identity.month_of(F.coalesce(_time_of(text), F.col(own)["start"]))
    kept = text.withColumn(own, F.struct(when.alias("month"), F.col(own)["chunk"].alias("chunk")))
    typed = typed_rows.type_columns(kept, columns, target, ["log_hash", own], options.strip_band, errors=None)
    chunk = unused(typed.columns, "_chunk")
    return typed.withColumns({month: F.col(own)["month"], chunk: F.col(own)["chunk"]}).drop(own), chunk


def bad_cells(rows: DataFrame, chunks: DataFrame, tables: dict[str, TableColumns], options: MergeOptions) -> DataFrame:
    """``(path, table)`` of files with cells that do not parse as the type that the file declares."""
    # A hook may make any cell bad; else a look at the rows in doubt tells.
    doubtful = rows if options.preprocess is not None else rows.where("doubt")
    parts = []
    for table, columns in tables.items():
        text, own = facts(doubtful, chunks, columns, options)
        lost = typed_rows.lost_cells(text, columns, F.col(own)["layout"], options.strip_band)
        parts.append(text.where(lost > 0).select(F.col(own)["path"].alias("path"), F.lit(table).alias("table")))
    return reduce(DataFrame.unionByName, parts).distinct()


def _time_of(text: DataFrame) -> Column:
    """The time of rows of text columns; a hook may have given it another type."""
    kind = dict(text.dtypes).get("time")
    if kind is None:
        return F.lit(None).cast("timestamp_ntz")
    return cleaning.to_time(F.col("time")) if kind == "string" else F.col("time").cast("timestamp_ntz")


def _with_hook_columns(columns: TableColumns, rows: DataFrame, chunks: DataFrame, options: MergeOptions) -> TableColumns:
    """The columns of a table, and those that the hook adds, by their names and types."""
    made, own = facts(rows, chunks, columns, replace(options, keep_tables_without_time=True))
    known = {"log_hash", own, *columns.declared}
    added = {c: [kind] for c, kind in made.dtypes if c not in known}
    return replace(columns, declared={**columns.declared, **added})


def _kept(time_column: Column, own: Column, options: MergeOptions) -> Column:
    inside = time_column.between(own["low"], own["high"])
    if options.keep_tables_without_time:
        return ~own["has_time"] | inside
    return own["has_time"] & inside


def _stored_columns(columns: TableColumns, options: MergeOptions) -> dict[str, str]:
    target = columns.target()
    if options.add_imei and IMEI_COLUMN not in target:
        target[IMEI_COLUMN] = "string"
    return target


def _write_table(
    store: LogStore,
    rows: DataFrame,
    chunks: DataFrame,
    columns: TableColumns,
    schema: stores.TableSchema,
    options: MergeOptions,
    attempt: str,
) -> tuple[float, int]:
    """Write one table; seconds and rows."""
    begun = time.monotonic()
    target = {c: schema.columns[c] for c in _stored_columns(columns, options)}
    typed, chunk = typed_facts(rows, chunks, columns, target, options, store.month)
    seen = Observation()
    counted = typed.observe(seen, F.count(F.lit(1)).alias("rows"))
    stored = {c: t for c, t in schema.columns.items() if c != "log_hash"}
    final = conform(counted, {**stored, store.month: "string", "log_hash": "bigint", chunk: "int"})
    store.write_rows(final.withColumn("batch_id", F.lit(attempt)), columns.table, schema.gen, chunk)
    return time.monotonic() - begun, _observed(seen).get("rows") or 0


def _observed(seen: Observation) -> dict:
    """Observed values; none when the rows turned out empty and were planned away."""
    try:
        return seen.get
    except Py4JJavaError as failure:
        # An observation of nothing has no row to convert; any other fault is one.
        if "AssertionError" in str(failure.java_exception) and "toPyRow" in str(failure):
            return {}
        raise


# Whole operations -------------------------------------------------------


def plan_merge(store: LogStore, files: DataFrame, options: MergeOptions | None = None) -> tuple[DataFrame, DataFrame]:
    """What a merge would do (M12): outcome per file, and the rows per file and table that it would write.

    Decides and counts as a merge does, from one decoding, and leaves the store as it is. Staging goes to the
    shared scratch folder.
    """
    options = options or MergeOptions()
    scratch = scratch_path(store.spark, "preview")
    rows = stage(store, files, options, f"{scratch}/rows")
    decided, _ = _decide_all(store, rows, options, scratch)
    accepted = decided.where(F.col("status") == MERGED)
    chunks = chunks_of(accepted, options.margin_hours)
    tables = _imported(source_columns(rows, accepted), table_summaries(rows), chunks, rows, options)
    parts = []
    for table, columns in tables.items():
        kept, own = facts(rows, chunks, columns, options)
        counted = kept.groupBy(F.col(own)["path"].alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select("path", F.lit(table).alias("table"), "rows"))
    counts = reduce(DataFrame.unionByName, parts) if parts else store.spark.createDataFrame([], "path string, table string, rows bigint")
    counts = _written(store, counts, f"{scratch}/counts")
    folders.delete(store.spark, f"{scratch}/rows")
    return _report(decided, "preview"), counts


def merge(
    store: LogStore, files: DataFrame, options: MergeOptions | None = None, batch_id: str | None = None
) -> DataFrame:
    """Import the logs in ``files(path, content)``; gives the outcome per file."""
    options, batch_id = options or MergeOptions(), batch_id or uuid.uuid4().hex
    begun = time.monotonic()
    folder = f"{store.root}/staging/{batch_id}"
    rows = stage(store, files, options, f"{folder}/rows")
    staged_at = time.monotonic()
    decided, lost = _decide_all(store, rows, options, folder)
    decided_at = time.monotonic()
    accepted = decided.where(F.col("status") == MERGED)
    metrics = [
        (batch_id, "*", "decode", staged_at - begun, None),
        (batch_id, "*", "decide", decided_at - staged_at, None),
    ]
    if not accepted.isEmpty():
        _import_logs(store, rows, accepted, options, batch_id, metrics)
    if lost is not None:
        tried = decided.where(F.col("status").isin(MERGED, FAILED)).select("path")
        _append_events(store, lost.join(tried, "path", "left_semi"), "bad_cells", F.lit(None), batch_id)
        failed = decided.where(F.col("status") == FAILED)
        if not failed.isEmpty():
            # Nothing of these is on disk.
            store.record((failed, stores.FAILED, False, batch_id))
    metrics.append((batch_id, "*", "merge", time.monotonic() - begun, None))
    timed = store.spark.createDataFrame(metrics, stores.METRICS_SCHEMA).coalesce(1)
    _side_by_side(
        lambda: store.append("metrics", timed), lambda: store.append("dispositions", _report(decided, batch_id))
    )
    store.compact_ledger()
    report = store.dispositions().where(F.col("batch_id") == batch_id)
    _move_inputs(store, report, options)
    if not options.keep_staging:
        folders.delete(store.spark, folder)
    if options.fail_fast:
        problems = report.where(~F.col("status").isin(MERGED, NOT_ATTEMPTED))
        first = problems.orderBy("path").first()
        if first is not None:
            raise MergeFailed(f"{first.path}: {first.status} {first.reason or ''}".strip())
    return report


def catalog_difference(store: LogStore, files: DataFrame, options: MergeOptions | None = None) -> DataFrame:
    """``table, column, side``: columns of files that the store lacks (``source_only``), and those of its newest schema
    that no file has, in tables that some file has (``target_only``) (J4). Names in small letters."""
    options = options or MergeOptions()
    rows = of_table(log_files.decode(_spread(files), options.tables, options.location_geometry_only, names_only=True), log_files.COLUMN_ROWS)
    source = rows.select(log_files.cell("table").alias("table"), F.lower(log_files.cell("column")).alias("column")).distinct()
    source = _written(store, source, scratch_path(store.spark, "catalog"))
    columns = [(t, c.lower()) for t, generations in store.schemas().items() for c in generations[-1].columns]
    target = store.spark.createDataFrame(columns, "table string, column string").join(source.select("table").distinct(), "table", "left_semi")
    return joins.schema_difference(source, target, ["table", "column"])


def _decide_all(store: LogStore, rows: DataFrame, options: MergeOptions, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """Every staged file with its status, written; and ``(path, table)`` of all bad cells, if there are any."""
    decided = decide(
        read_identity(rows, options.add_imei), store.active_logs(), not store.is_empty(), options.fail_fast
    )
    decided = _written(store, decided, f"{folder}/files")
    if options.preprocess is None and decided.where(F.col("status").isin(MERGED, ALREADY_MERGED) & (F.col("doubt") > 0)).isEmpty():
        return decided, None
    candidates = _candidates(decided)
    summaries = table_summaries(rows)
    in_doubt = summaries.where(F.col("doubt") > 0) if options.preprocess is None else summaries
    names = [r.table for r in in_doubt.join(candidates.select("path"), "path", "left_semi").select("table").distinct().collect()]
    if not names:
        return decided, None
    chunks = chunks_of(candidates, options.margin_hours)
    columns = {t: c for t, c in source_columns(rows, candidates).items() if t in names}
    tables = _imported(columns, summaries, chunks, rows, options)
    if not tables:
        return decided, None
    lost = _written(store, bad_cells(rows, chunks, tables, options), f"{folder}/lost")
    if lost.isEmpty():
        return decided, None
    failing = lost.where(~F.col("table").isin(*fixed.TOLERATED_TABLES)) if options.bad_cells_fail_log else lost.limit(0)
    return _written(store, _after_check(decided, candidates, failing, options), f"{folder}/checked"), lost


def _candidates(decided: DataFrame) -> DataFrame:
    """Files that can be merged: the first of each new log, and its copies, which come in where the first is bad."""
    merging = decided.where(F.col("status") == MERGED)
    copies = decided.where((F.col("status") == ALREADY_MERGED) & F.col("problem").isNull())
    return merging.unionByName(copies.join(merging.select("log_hash"), "log_hash", "left_semi").select(*decided.columns))


def _after_check(decided: DataFrame, candidates: DataFrame, failing: DataFrame, options: MergeOptions) -> DataFrame:
    """Statuses when some files have bad cells: the first good file of each log is merged, files before it failed.

    ``_bad_table`` names a table with bad cells of each failed file.
    """
    bad = failing.groupBy("path").agg(F.min("table").alias("_bad_table"))
    good = candidates.join(bad, "path", "left_anti").groupBy("log_hash").agg(F.min("path").alias("_first"))
    # Few rows: one per log that can be merged, and one per bad file.
    logs = candidates.select("log_hash").distinct().join(good, "log_hash", "left").withColumn("_candidate", F.lit(True))
    is_candidate = F.col("_candidate").isNotNull() & F.col("problem").isNull()
    before = F.col("_first").isNull() | (F.col("path") < F.col("_first"))
    status = (
        F.when(~is_candidate, F.col("status"))
        .when(F.col("path") == F.col("_first"), MERGED)
        .when(F.col("_bad_table").isNotNull() & before, FAILED)
        .otherwise(F.when(F.col("status") == NOT_ATTEMPTED, NOT_ATTEMPTED).otherwise(ALREADY_MERGED))
    )
    now = decided.join(logs, "log_hash", "left").join(bad, "path", "left").withColumn("status", status)
    now = now.withColumn("_bad_table", F.when(F.col("status") == FAILED, F.col("_bad_table"))).drop("_first", "_candidate")
    if options.fail_fast:
        stop = now.where(F.col("status") == FAILED).agg(F.min("path")).first()[0]
        now = now.withColumn("status", F.when(F.col("path") > stop, NOT_ATTEMPTED).otherwise(F.col("status")))
    return now.select(*decided.columns, "_bad_table")


def _written(store: LogStore, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return store.spark.read.schema(df.schema).parquet(path)


def _imported(
    columns: dict[str, TableColumns], summaries: DataFrame, chunks: DataFrame, rows: DataFrame, options: MergeOptions
) -> dict[str, TableColumns]:
    """The tables that are imported, with the columns that a hook adds."""
    tables = {t: c for t, c in columns.items() if options.tables.keeps(t)}
    if options.preprocess is not None:
        tables = {t: _with_hook_columns(c, rows, chunks, options) for t, c in tables.items()}
    if options.skip_empty_tables:
        filled = {row.table for row in summaries.where(F.col("rows") > 0).select("table").distinct().collect()}
        tables = {t: c for t, c in tables.items() if t in filled}
    if not options.keep_tables_without_time:
        tables = {t: c for t, c in tables.items() if t == fixed.LOGS_TABLE or "time" in c.declared}
    return tables


def _import_logs(
    store: LogStore, rows: DataFrame, accepted: DataFrame, options: MergeOptions, batch_id: str, metrics: list[tuple]
) -> None:
    """Steps 3 and 4 for files that are known to be good."""
    attempt = f"{batch_id}-{uuid.uuid4().hex[:8]}"
    if store.layout == stores.PER_LOG:
        store.remove_log_folders(accepted.select("log_hash").join(store.hidden(), "log_hash"))
    columns, _, (stored, every) = _side_by_side(
        lambda: source_columns(rows, accepted),
        lambda: store.record((accepted, stores.PENDING, True, attempt)),
        store.all_schemas,
    )
    summaries = table_summaries(rows)
    chunks = chunks_of(accepted, options.margin_hours)
    tables = _imported(columns, summaries, chunks, rows, options)
    tables = {t: c.spelled(list(stored[t][-1].columns)) if t in stored else c for t, c in tables.items()}
    incoming = {t: {"log_hash": "bigint", **_stored_columns(c, options)} for t, c in tables.items()}
    schemas, grown = store.evolve(incoming, attempt, stored, every)
    with ThreadPoolExecutor(options.parallel_tables) as pool:
        jobs = {
            t: pool.submit(_write_table, store, rows, chunks, c, schemas[t], options, attempt) for t, c in tables.items()
        }
        reports = [pool.submit(_record_events, store, summaries, columns, accepted, batch_id)]
        if grown is not None:
            reports.append(pool.submit(store.append, "schemas", grown))
        for table, job in jobs.items():
            seconds, count = job.result()
            metrics.append((batch_id, table, "write", seconds, count))
        for report in reports:
            report.result()
    # Rows and schema changes of the attempt count from here on.
    store.record((accepted, stores.MERGED, True, attempt))


def _side_by_side(*actions: Callable) -> list:
    """Results of independent small jobs that run at the same time."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [job.result() for job in [pool.submit(action) for action in actions]]


def _append_events(store: LogStore, rows: DataFrame, event: str, detail: Column, batch_id: str) -> None:
    """Events of files and tables, ``rows(path, table)``."""
    found = rows.select(F.lit(batch_id).alias("batch_id"), "path", "table", F.lit(event).alias("event"), detail.cast("string").alias("detail"))
    store.append("ingest_events", found)


def _record_events(
    store: LogStore, summaries: DataFrame, columns: dict[str, TableColumns], accepted: DataFrame, batch_id: str
) -> None:
    """Warnings of a batch: cut-short reads, odd storage classes, tables without time, old app versions."""
    timeless = [t for t, c in columns.items() if t != fixed.LOGS_TABLE and "time" not in c.declared]
    parts = [
        summaries.where(F.col("error").isNotNull()).select("path", "table", F.lit("partial_read").alias("event"), F.col("error").alias("detail")),
        summaries.where(F.col("odd").isNotNull()).select("path", "table", F.lit("storage_class").alias("event"), F.col("odd").alias("detail")),
        summaries.where(F.col("table").isin(*timeless)).select("path", "table", F.lit("no_time_column").alias("event"), F.lit(None).cast("string").alias("detail")),
        accepted.where(F.col("app_version") < fixed.OLDEST_SUPPORTED_VERSION).select(
            "path", F.lit(fixed.LOGS_TABLE).alias("table"), F.lit("old_app_version").alias("event"), F.col("app_version").cast("string").alias("detail")
        ),
    ]
    events = reduce(DataFrame.unionByName, parts)
    store.append("ingest_events", events.select(F.lit(batch_id).alias("batch_id"), "*"))


def _report(decided: DataFrame, batch_id: str) -> DataFrame:
    bad_table = F.col("_bad_table") if "_bad_table" in decided.columns else F.lit(None).cast("string")
    reason = F.coalesce("error", F.concat(F.lit("bad cells in "), bad_table))
    return decided.select("path", "log_hash", "status", reason.alias("reason"), F.lit(batch_id).alias("batch_id"))


def _move_inputs(store: LogStore, report: DataFrame, options: MergeOptions) -> None:
    """Move finished and failed inputs out of the inbox (M11), a list partition at a time."""
    done = F.col("status") == MERGED
    for folder, chosen in (
        (options.move_imported_to, done),
        (options.move_failed_to, ~done & (F.col("status") != NOT_ATTEMPTED)),
    ):
        if folder:
            paths = (row.path for row in report.where(chosen).select("path").toLocalIterator())
            folders.move_all(store.spark, paths, folder, options.input_root)


def unmerge(store: LogStore, logs: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Remove logs from every table (M5–M7); outcome per requested ``log_hash``.

    ``logs`` has ``log_hash``, or ``path`` and ``content`` of log files; files
    that do not tell their log are reported too.
    """
    batch_id = batch_id or uuid.uuid4().hex
    folder = f"{store.root}/staging/{batch_id}"
    unknown = None
    if "content" in logs.columns:
        only_logs = filters.TableFilter(only=(fixed.LOGS_TABLE,))
        heads = _written(store, read_identity(log_files.decode(logs, only_logs)), f"{folder}/heads")
        no_identity = F.coalesce("log_hash", F.lit(0)) == 0
        unknown = _report(heads.where(no_identity).withColumn("status", identity_problem()), batch_id)
        logs = heads.where(~no_identity)
    wanted = logs.select("log_hash").distinct()
    exists = not store.is_empty()
    known = store.active_logs().select(
        "log_hash", "log_ym", F.col("path").alias("merged_from"), F.col("batch_id").alias("attempt")
    )
    status = outcome(F.col("log_ym").isNotNull(), F.lit(exists), unmerge=True)
    decided = wanted.join(known, "log_hash", "left").withColumn("status", status)
    decided = _written(store, decided, f"{folder}/files")
    gone = decided.where(F.col("status") == UNMERGED).withColumnRenamed("merged_from", "path")
    if not gone.isEmpty():
        store.forget(gone)
    report = decided.select(
        F.col("merged_from").alias("path"),
        "log_hash",
        "status",
        F.lit(None).cast("string").alias("reason"),
        F.lit(batch_id).alias("batch_id"),
    )
    store.append("dispositions", report if unknown is None else report.unionByName(unknown))
    folders.delete(store.spark, folder)
    return store.dispositions().where(F.col("batch_id") == batch_id)
