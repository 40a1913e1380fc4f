"""Log files made from events that show what a merge does with odd cells, bad files and copies."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import reduce

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.operators.aggregates import schema_drift, schema_fingerprints
from logtrail.plans.derived_logs import _ROWS, FIRST_START, TIME_FORMAT, archive, log_files_from
from logtrail.plans.merge import MergeOptions, catalog_difference, merge, plan_merge
from logtrail.plans.store import LogStore
from logtrail.session import scratch_path
from logtrail.sources.log_files import read_log_files, schema_statements
from logtrail.streaming.follow import follow

LOGS = '"log_hash" BIGINT,"log_start_time" DATETIME,"log_end_time" DATETIME,"log_timezone_offset" INT,"log_app_version" TEXT'


def _head(rows: pd.DataFrame) -> tuple[int, int, datetime, int]:
    """Device, block, start and identity of a group of events."""
    device, block = int(rows["device"].iloc[0]), int(rows["block"].iloc[0])
    start = FIRST_START + timedelta(seconds=block)
    return device, block, start, (device << 32) | int((start - datetime(1970, 1, 1)).total_seconds())


def _logs(log_hash: int, start: datetime, end: str | None = None) -> tuple[str, list[tuple]]:
    last = (start + timedelta(days=60)).strftime(TIME_FORMAT) if end is None else end
    return LOGS, [(log_hash, start.strftime(TIME_FORMAT), last, 0, "v3.0.800")]


# Folder scan ---------------------------------------------------------------


def write_folder(files: DataFrame, place: str) -> None:
    """Write ``(path, content)`` below a folder that all executors reach, from the tasks."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = pyarrow.fs.FileSystem.from_uri(place)
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                system.create_dir(f"{root}/{path}".rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(f"{root}/{path}") as stream:
                    stream.write(content)
                # Of other names, so no log files.
                with system.open_output_stream(f"{root}/{path}.part") as stream:
                    stream.write(content[:10])
            yield part[["path"]]

    files.mapInPandas(write, "path string").count()


def merged_folder(spark: SparkSession, events: DataFrame) -> LogStore:
    """A store with all log files of a folder of nested folders."""
    place = scratch_path(spark, "inbox")
    write_folder(log_files_from(events), place)
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")
    merge(store, read_log_files(spark, place))
    return store


# Cells ---------------------------------------------------------------------


def _pack_cells(rows: pd.DataFrame) -> pd.DataFrame:
    device, block, start, log_hash = _head(rows)
    blob_of = {"click": lambda e: e.props, "error": lambda e: b"", "view": lambda e: None}
    text_of = {"view": lambda e: e.props.encode(), "error": lambda e: 7, "signup": lambda e: ""}
    cells = []
    for e in rows.sort_values("event_id").itertuples(index=False):
        blob = blob_of.get(e.event_type, lambda e: f"{e.event_type}{e.event_id}".encode())(e)
        text = text_of.get(e.event_type, lambda e: e.event_type)(e)
        cells.append((e.ts.to_pydatetime().strftime(TIME_FORMAT), e.event_id, blob, text, e.props, int(e.user_id)))
    names = ['"Time" DATETIME', '"posid" INT', '"b" BLOB', '"t" TEXT', '"a`b.c" TEXT', '"_path" INT']
    if device % 2:
        # Every other device has the same columns in reverse, spelled otherwise.
        names, cells = [n.replace('"t"', '"T"') for n in names[::-1]], [row[::-1] for row in cells]
    tables = {"logs": _logs(log_hash, start), "odd": (",".join(names), cells)}
    return pd.DataFrame({"path": [f"cells/{device:06d}/{block:06d}.azm"], "content": [archive(tables)]})


def merged_cells(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Blobs in text columns, texts in blob columns and names of all kinds, merged and read back."""
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")
    merge(store, log_files_from(events, _pack_cells))
    table = store.table("odd")
    text = next(c for c in table.columns if c.lower() == "t")
    return table.select("posid", F.hex("b").alias("b"), F.col(text).alias("t"), F.col("`a``b.c`").alias("abc"), F.col("_path").alias("path_no"))


CELLS_SQL = """select event_id as posid,
    case event_type when 'click' then hex(props) when 'error' then null when 'view' then null else hex(event_type || event_id) end as b,
    case event_type when 'view' then props when 'error' then '7' when 'signup' then null else event_type end as t,
    props as abc, user_id as path_no
  from events where ts between timestamp '2024-01-01' - interval 48 hour and timestamp '2024-01-01' + interval 62 day"""


# Outcomes ------------------------------------------------------------------


def _pack_cases(rows: pd.DataFrame) -> pd.DataFrame:
    device, block, start, log_hash = _head(rows)
    times = [t.to_pydatetime().strftime(TIME_FORMAT) for t in rows.sort_values("event_id")["ts"]]
    facts = ('"time" DATETIME,"n" INT', [(t, i) for i, t in enumerate(times)])
    good = {"logs": _logs(log_hash, start), "kpi": facts}
    # A bad cell in a column of another type, beside a column that no good file has.
    bad = good | {"kpi": ('"time" DATETIME,"n" Double,"z" TEXT', [*[(t, 0.5, "z") for t in times], (start.strftime(TIME_FORMAT), "oops", "z")])}
    cases = {
        0: {"b": archive(good), "c": archive(good), "d": archive(bad)},
        1: {"a": archive(bad), "b": archive(bad), "c": archive(good), "d": archive(bad)},
        2: {"b": archive(bad)},
        3: {"b": archive({"logs": _logs(0, start), "kpi": facts})},
        4: {"b": archive({"logs": _logs(log_hash, start, ""), "kpi": facts})},
        5: {"b": b"no archive"},
        6: {"b": archive({"logs": (LOGS, []), "kpi": facts})},
    }
    files = cases[device % len(cases)]
    paths = [f"cases/{device:06d}/{block:06d}/{name}.azm" for name in files]
    return pd.DataFrame({"path": paths, "content": list(files.values())})


def outcomes(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Outcome of every file, rows kept per table, and the columns that the store has in the end."""
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")
    report = merge(store, log_files_from(events, _pack_cases))
    rows = [report.select(F.col("path").alias("what"), F.col("status").alias("result"))]
    for table, generations in sorted(store.schemas().items()):
        columns = [(f"{table}.{c}", t) for c, t in generations[-1].columns.items()]
        count = store.table(table).agg(F.count(F.lit(1)).cast("string").alias("result"))
        rows += [spark.createDataFrame(columns, "what string, result string"), count.select(F.lit(table).alias("what"), "result")]
    return reduce(DataFrame.unionByName, rows)


_CASES = """with d as (select *, user_id // 10 as device from events),
  e as (select *, event_id % ceil(count(*) over (partition by device) / 100000)::bigint as block from d),
  f as (select device, block, device % 7 as kind from e group by device, block),
  c as (select * from (values (0, 'b', 'merged'), (0, 'c', 'already_merged'), (0, 'd', 'already_merged'),
    (1, 'a', 'failed'), (1, 'b', 'failed'), (1, 'c', 'merged'), (1, 'd', 'already_merged'), (2, 'b', 'failed'),
    (3, 'b', 'invalid_identity'), (4, 'b', 'no_end_time'), (5, 'b', 'unreadable'), (6, 'b', 'invalid_identity')) v(kind, name, status)),
  m as (select count(*) as n from f where kind < 2) """

OUTCOMES_SQL = (
    _CASES
    + """select 'cases/' || lpad(device::varchar, 6, '0') || '/' || lpad(block::varchar, 6, '0') || '/' || name || '.azm' as what, status as result
  from f join c using (kind)
union all select 'logs', n::varchar from m where n > 0
union all select 'kpi', count(*)::varchar from e where device % 7 < 2
  and ts between timestamp '2024-01-01' - interval 48 hour and timestamp '2024-01-01' + to_seconds(block) + interval 62 day having (select n from m) > 0
union all select what, result from m, (values ('kpi.log_hash', 'bigint'), ('kpi.time', 'timestamp_ntz'), ('kpi.n', 'bigint'),
  ('logs.log_hash', 'bigint'), ('logs.log_start_time', 'timestamp_ntz'), ('logs.log_end_time', 'timestamp_ntz'),
  ('logs.log_timezone_offset', 'bigint'), ('logs.log_app_version', 'string')) v(what, result) where n > 0"""
)


# Preview -------------------------------------------------------------------


def previewed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Files with their outcome before a merge, and the rows per table that it would write."""
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")
    report, counts = plan_merge(store, log_files_from(events))
    return report.select("path", "status").join(counts, "path", "left")


PREVIEW_SQL = (
    _ROWS
    + """, p as (select *, 'derived/' || lpad(device::varchar, 6, '0') || '/' || lpad(block::varchar, 6, '0') || '.azm' as path from k)
select path, 'merged' as status, "table", count(*) as rows from p,
  (values ('kpi'), ('signalling'), ('location'), ('android_info_1sec'), ('wifi_scanned')) v("table")
  where not ("table" = 'location' and event_type = 'error') and not ("table" = 'wifi_scanned' and device % 5 < 2) group by path, "table"
union all
select distinct 'derived/' || lpad(device::varchar, 6, '0') || '/' || lpad(block::varchar, 6, '0') || '.azm', 'merged', 'logs', 1 from l"""
)


# Catalogs ------------------------------------------------------------------


def catalog_changes(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Columns of the case files that a store of the usual logs lacks, and the reverse."""
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")
    merge(store, log_files_from(events))
    return catalog_difference(store, log_files_from(events, _pack_cases))


CATALOG_SQL = (
    _CASES
    + """select 'kpi' as "table", "column", side from (values
    ('n', 'source_only', (select count(*) from f where kind not in (2, 5)) > 0), ('z', 'source_only', (select count(*) from f where kind < 3) > 0),
    ('posid', 'target_only', true), ('rsrp', 'target_only', true), ('modem_time', 'target_only', true),
    ('android_cellid_from_cellfile', 'target_only', true), ('x_duration', 'target_only', true),
    ('extra', 'target_only', (select count(*) from f where device % 2 = 0) > 0)) v("column", side, there)
  where there and (select count(*) from f where kind <> 5) > 0
union all select 'kpi', 'log_hash', 'target_only' from (select count(*) as n from f where kind <> 5) where n > 0"""
)


def drift_of(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Files per schema of the usual log files: every other device has a column more."""
    return schema_drift(schema_fingerprints(schema_statements(log_files_from(events)), "path"))


def _drift_sql() -> str:
    common = '"time" DATETIME,"time_ms" INT,"posid" INT,"log_hash" BIGINT'
    kpi = common + ',"rsrp" Double,"modem_time" DATETIME,"android_cellid_from_cellfile" INT,"x_duration" TEXT'
    tables = {
        "logs": LOGS,
        "signalling": common + ',"geom" BLOB,"symbol" TEXT,"info" TEXT',
        "location": common + ',"geom" BLOB',
        "android_info_1sec": '"time" DATETIME,"log_hash" BIGINT',
        "wifi_scanned": common,
        "spatial_ref_sys": '"srid" INT',
    }

    def text(of_kpi: str) -> str:
        return "\n".join(sorted(f'CREATE TABLE "{name}" ({columns})' for name, columns in {**tables, "kpi": of_kpi}.items()))

    even, odd = text(kpi + ',"extra" INT'), text(kpi)
    return _CASES + f"select sha1(case when device % 2 = 0 then '{even}' else '{odd}' end) as fingerprint, count(*) as logs from f group by 1"


DRIFT_SQL = _drift_sql()


# Follow --------------------------------------------------------------------


class Killed(RuntimeError):
    """A merge that is made to break off."""


def followed(spark: SparkSession, events: DataFrame) -> LogStore:
    """A store that follows a growing folder: one run that ends, one that breaks off in a merge, and one that takes up its work."""
    place, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "checkpoint")
    files = scratch_path(spark, "files")
    log_files_from(events).write.parquet(files)
    files = spark.read.parquet(files)
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs")

    def kill(rows: DataFrame, table: str) -> DataFrame:
        raise Killed(table)

    late = F.crc32("path") % 2 == 0
    write_folder(files.where(~late), place)
    follow(store, place, checkpoint).awaitTermination()
    write_folder(files.where(late), place)
    broken = follow(store, place, checkpoint, MergeOptions(preprocess=kill))
    try:
        broken.awaitTermination()
    except Exception as failure:
        # Only the break that was meant: all else is a fault.
        if "Killed" not in str(failure):
            raise
    follow(store, place, checkpoint).awaitTermination()
    return store
