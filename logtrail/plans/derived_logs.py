"""Log files made from an events table, to run whole merges on given data.

One file per device, or several for a device with many events, so a file holds
a bounded number of rows however the events are spread over users, and the
number of files grows with the events.
"""

from __future__ import annotations

import io
import sqlite3
import struct
import zipfile
from collections.abc import Callable
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtrail import fixed_values as fixed
from logtrail.operators.evolution import merge_by_name
from logtrail.operators.joins import lookup_join
from logtrail.plans import store as stores
from logtrail.plans import views
from logtrail.plans.merge import merge, unmerge
from logtrail.plans.store import LogStore
from logtrail.session import scratch_path

USERS_PER_DEVICE = 10
EVENTS_PER_FILE = 100_000
FIRST_START = datetime(2024, 1, 1)
TIME_FORMAT = "%Y-%m-%d %H:%M:%S.%f"


@F.pandas_udf(T.BinaryType())
def point_blob(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Point blobs from coordinates."""
    xy = np.column_stack([lon, lat]).astype("<f8").view(np.uint8).reshape(len(lon), 16)
    blob = np.zeros((len(lon), fixed.POINT_BLOB_LENGTH), dtype=np.uint8)
    blob[:, :6] = np.frombuffer(bytes.fromhex(fixed.POINT_BLOB_HEADER), dtype=np.uint8)
    blob[:, 6:22] = blob[:, 22:38] = blob[:, fixed.POINT_X_AT : fixed.POINT_X_AT + 16] = xy
    blob[:, 38], blob[:, fixed.POINT_CLASS_AT], blob[:, -1] = 0x7C, 1, 0xFE
    return pd.Series([row.tobytes() for row in blob])


def _point(lon: float, lat: float) -> bytes:
    xy = struct.pack("<dd", lon, lat)
    head = bytes.fromhex(fixed.POINT_BLOB_HEADER) + xy + xy
    return head + b"\x7c" + bytes.fromhex(fixed.POINT_CLASS) + xy + b"\xfe"


def log_files_from(events: DataFrame, pack: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """Events as ``(path, content)`` of log files; ``pack`` makes the files of a device's block of events."""
    device = F.floor(F.col("user_id") / USERS_PER_DEVICE).alias("device")
    placed = events.select("*", device)
    blocks = F.ceil(F.count(F.lit(1)) / EVENTS_PER_FILE).alias("blocks")
    split = lookup_join(placed, placed.groupBy("device").agg(blocks), ["device"])
    split = split.withColumn("block", F.pmod("event_id", "blocks")).drop("blocks")
    return split.groupBy("device", "block").applyInPandas(pack or _pack, "path string, content binary")


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    device, block = int(rows["device"].iloc[0]), int(rows["block"].iloc[0])
    shift = timedelta(days=10 * (device % 4))
    start = FIRST_START + shift + timedelta(seconds=block)
    log_hash = (device << 32) | int((start - datetime(1970, 1, 1)).total_seconds())
    end = "" if device % 2 else (start + timedelta(days=19.5)).strftime(TIME_FORMAT)
    offset = (0, 4, -4)[device % 3] * 3_600_000
    events = [
        ((e.ts.to_pydatetime() + shift).strftime(TIME_FORMAT), e)
        for e in rows.sort_values("event_id").itertuples(index=False)
    ]
    common = '"time" DATETIME,"time_ms" INT,"posid" INT,"log_hash" BIGINT'
    symbols = {"click": "send", "view": None}
    dirty = {"error": "159841", "view": None}
    kpi = common + ',"rsrp" Double,"modem_time" DATETIME,"android_cellid_from_cellfile" INT,"x_duration" TEXT'
    kpis = [
        (
            t,
            0,
            e.event_id,
            log_hash,
            e.value,
            "" if e.event_type == "view" else dirty.get(e.event_type, "") + t,
            f"{e.user_id}abc",
            "" if e.event_type == "signup" else e.value,
        )
        for t, e in events
    ]
    if device % 2 == 0:
        kpi += ',"extra" INT'
        kpis = [(*row, int(e.user_id)) for row, (_, e) in zip(kpis, events, strict=True)]
    tables = {
        "logs": (
            '"log_hash" BIGINT,"log_start_time" DATETIME,"log_end_time" DATETIME,"log_timezone_offset" INT,"log_app_version" TEXT',
            [(log_hash, start.strftime(TIME_FORMAT), end, offset, f"v3.0.{740 + device % 5}")],
        ),
        "signalling": (
            common + ',"geom" BLOB,"symbol" TEXT,"info" TEXT',
            [
                (
                    t,
                    0,
                    e.event_id,
                    log_hash,
                    _point(e.value, -e.value / 2) if e.event_type == "click" else None,
                    symbols.get(e.event_type, "recv"),
                    f"{e.props},\n{e.event_type}",
                )
                for t, e in events
            ],
        ),
        "location": (
            common + ',"geom" BLOB',
            [
                (t, 0, e.event_id, log_hash, _point(e.value, -e.value / 2))
                for t, e in events
                if e.event_type != "error"
            ],
        ),
        "kpi": (kpi, kpis),
        "android_info_1sec": ('"time" DATETIME,"log_hash" BIGINT', [(t, log_hash) for t, _ in events]),
        "wifi_scanned": (common, [(t, 0, e.event_id, log_hash) for t, e in events]),
        "spatial_ref_sys": ('"srid" INT', [(4326,)]),
    }
    content = archive(tables)
    return pd.DataFrame({"path": [f"derived/{device:06d}/{block:06d}.azm"], "content": [content]})


def archive(tables: dict[str, tuple[str, list[tuple]]]) -> bytes:
    db = sqlite3.connect(":memory:")
    for name, (columns, rows) in tables.items():
        db.execute(f'create table "{name}" ({columns})')
        db.executemany(f'insert into "{name}" values ({",".join("?" * (columns.count(",") + 1))})', rows)
    db.commit()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(fixed.LOG_DB_MEMBER, db.serialize())
    db.close()
    return out.getvalue()


def merged_store(
    spark: SparkSession, events: DataFrame, layout: str = stores.PER_BATCH, month: str = stores.BY_LOG_MONTH
) -> LogStore:
    """A new store with all derived logs merged."""
    store = LogStore(spark, scratch_path(spark, "store"), "all_logs", layout, month)
    merge(store, log_files_from(events))
    return store


def _time_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def read_back(store: LogStore) -> DataFrame:
    """Rows of the merged tables, KPIs with their position."""
    location = store.table("location")
    kpi = views.with_position(store.table("kpi"), location).withColumn("kind", F.lit("kpi"))
    kpi = kpi.withColumn("modem_time", _time_text("modem_time"))
    messages = store.table("signalling").drop("geom", "symbol").withColumn("kind", F.lit("signalling"))
    wifi = store.table("wifi_scanned").withColumn("kind", F.lit("wifi_scanned"))
    rows = merge_by_name(merge_by_name(kpi, messages), wifi)
    return rows.withColumn("time", _time_text("time"))


def report(store: LogStore) -> DataFrame:
    """State, month and whether anything is stored, per log."""
    sizes = views.log_sizes(store).select("log_hash", (F.col("size_bytes") > 0).alias("stored"))
    return store.ledger().select("log_hash", "status", "log_ym").join(sizes, "log_hash")


def after_unmerge(store: LogStore, events: DataFrame, purge: bool = False) -> DataFrame:
    """Messages left when even devices are removed and every fourth is merged again."""
    device = F.shiftrightunsigned("log_hash", 32)
    unmerge(store, store.active_logs().select("log_hash").where(device % 2 == 0))
    fourth = F.floor(F.col("user_id") / USERS_PER_DEVICE) % 4 == 0
    merge(store, log_files_from(events.where(fourth)))
    if purge:
        store.purge()
    return store.table("signalling").select("log_hash", "posid", "direction")


def rows_per_month(store: LogStore) -> DataFrame:
    """Rows per table and month folder."""
    parts = [store.table(t).select(F.lit(t).alias("table_name"), store.month) for t in ("kpi", "location")]
    rows = merge_by_name(*parts)
    return rows.groupBy("table_name", store.month).agg(F.count(F.lit(1)).alias("row_count"))


_ROWS = """with d as (select *, user_id // 10 as device from events),
  e as (select *, event_id % ceil(count(*) over (partition by device) / 100000)::bigint as block from d),
  s as (select *, to_days(((device % 4) * 10)::integer) as shift from e),
  l as (select *, timestamp '2024-01-01' + shift + to_seconds(block) as start, ts + shift as t from s),
  k as (select *, device * 4294967296 + epoch(start)::bigint as log_hash,
               strftime(start + to_hours((case device % 3 when 1 then 4 when 2 then -4 else 0 end)::integer), '%Y_%m') as log_ym,
               strftime(t, '%Y-%m-%d %H:%M:%S.%f') as time
        from l where device % 2 = 1 or t <= start + interval 516 hour) """

MERGED_SQL = (
    _ROWS
    + """select 'kpi' as kind, log_ym, log_hash, time, event_id as posid, value as rsrp,
       case when event_type not in ('error', 'view')
            then strftime(date_trunc('millisecond', t), '%Y-%m-%d %H:%M:%S.%f') end as modem_time,
       user_id as android_cellid_from_cellfile, case when event_type <> 'signup' then value end as x_duration,
       case when device % 2 = 0 then user_id end as extra,
       case when event_type <> 'error' then value / -2 end as lat, case when event_type <> 'error' then value end as lon,
       null as info, null as direction from k
union all
select 'signalling', log_ym, log_hash, time, event_id, null, null, null, null, null,
       case when event_type = 'click' then value / -2 end, case when event_type = 'click' then value end,
       props || ',' || chr(10) || event_type, case when event_type = 'click' then 1 else 0 end from k
union all
select 'wifi_scanned', log_ym, log_hash, time, event_id, null, null, null, null, null, null, null, null, null
from k where device % 5 >= 2"""
)
REPORT_SQL = _ROWS + "select distinct log_hash, 'merged' as status, log_ym, true as stored from k"
UNMERGED_SQL = (
    _ROWS
    + """select log_hash, event_id as posid, case when event_type = 'click' then 1 else 0 end as direction
         from k where device % 4 <> 2"""
)
ROW_MONTH_SQL = (
    _ROWS
    + """select 'kpi' as table_name, strftime(t, '%Y_%m') as row_ym, count(*) as row_count from k group by 2
         union all select 'location', strftime(t, '%Y_%m'), count(*) from k where event_type <> 'error' group by 2"""
)
