"""The operators on plain tables, each with the SQL that gives the same rows.

The tables stand in for drive-test logs: ``orders`` are logs, ``lineitem`` and
``events`` are facts, ``part`` holds positions, ``conversations`` are messages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.functions import cleaning, geometry, identity
from logtrail.operators import aggregates, evolution, filters, joins
from logtrail.plans import derived_cases, derived_logs, merge, views
from logtrail.plans import store as stores
from logtrail.session import configure, scratch_path
from logtrail.sources import typed_rows
from logtrail.sources.typed_rows import TableColumns
from logtrail.streaming import tables as stream_tables

IMEI_BASE = 358096071000000
SPARK_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TIME = "'%Y-%m-%d %H:%M:%S.%f'"


@dataclass(frozen=True)
class Query:
    """A query over a folder of tables, and its SQL where there is one."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None) -> Callable:
    """Register a query under the name of its function; it gets a configured session."""

    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        @wraps(run)
        def configured(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        QUERIES[run.__name__] = Query(configured, sql)
        return configured

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def time_text(time: str | Column) -> Column:
    """A time as text, to the microsecond."""
    return F.date_format(time, SPARK_TIME)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as facts."""
    return _as_lines(read(spark, folder, "lineitem"))


def _as_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("log_hash"),
        F.col("l_shipdate").alias("time"),
        F.col("l_partkey").alias("posid"),
        F.col("l_quantity").alias("kpi"),
        F.when(F.col("l_returnflag") == "R", "send").otherwise(F.col("l_returnflag")).alias("symbol"),
        F.col("l_linenumber").alias("line"),
    )


def order_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as logs that last 28 days, on a clock seven hours ahead of UTC."""
    log_hash = identity.encode_log_hash(F.col("o_custkey"), F.col("o_orderdate"))
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("log_hash"),
        F.col("o_orderdate").alias("log_start_time"),
        (F.col("o_orderdate") + F.expr("interval 28 days")).alias("log_end_time"),
        identity.log_month(log_hash, F.lit(25200000)).alias("log_ym"),
        F.col("o_orderpriority").alias("priority"),
    )


# Filters and joins ------------------------------------------------------


@query(
    f"""select l_orderkey as log_hash, strftime(l_shipdate, {SQL_TIME}) as time, l_partkey as posid,
               l_quantity as kpi, case when l_returnflag = 'R' then 1 else 0 end as direction,
               strftime(o_orderdate + interval 7 hour, '%Y_%m') as log_ym, p_name, p_retailprice
        from lineitem join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
        where l_shipdate between o_orderdate - interval 48 hour
                             and o_orderdate + interval 28 day + interval 48 hour"""
)
def clamp_join_location(spark: SparkSession, folder: str) -> DataFrame:
    """Facts inside their log's time range, with log month and position."""
    position = read(spark, folder, "part").select(F.col("p_partkey").alias("posid"), "p_name", "p_retailprice")
    kept = filters.clamp_to_log(lines(spark, folder), order_logs(spark, folder), carry=("log_ym",))
    return joins.attach_position(kept, position, ["posid"]).select(
        "log_hash",
        time_text("time").alias("time"),
        "posid",
        "kpi",
        cleaning.direction(F.col("symbol")).alias("direction"),
        "log_ym",
        "p_name",
        "p_retailprice",
    )


@query(
    f"""with bounds as (select user_id, date_trunc('second', min(ts) + interval 3 day) as lo,
                               date_trunc('second', max(ts) - interval 3 day) as hi from events group by user_id)
        select event_id, events.user_id as log_hash, strftime(ts, {SQL_TIME}) as time, value
        from events join bounds on events.user_id = bounds.user_id
        where ts between lo - interval 48 hour and hi + interval 48 hour"""
)
def clamp_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events inside a range taken from their own user."""
    events = read(spark, folder, "events").withColumnRenamed("user_id", "log_hash")
    logs = events.groupBy("log_hash").agg(
        (F.min("ts") + F.expr("interval 3 days")).alias("log_start_time"),
        (F.max("ts") - F.expr("interval 3 days")).alias("log_end_time"),
    )
    kept = filters.clamp_to_log(events, logs, time="ts")
    return kept.select("event_id", "log_hash", time_text("ts").alias("time"), "value")


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi, o_orderpriority as priority
       from lineitem join orders on l_orderkey = o_orderkey"""
)
def facts_with_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact with its log."""
    logs = order_logs(spark, folder).select("log_hash", "priority")
    return joins.attach_log(lines(spark, folder).select("log_hash", "line", "kpi"), logs)


@query(
    """with best as (select user_id, hour(ts) as posid, value as lat, value / 2 as lon,
                            row_number() over (partition by user_id, hour(ts) order by ts desc, value desc) as n
                     from events where event_type = 'signup')
       select e.event_id, e.user_id as log_hash, hour(e.ts) as posid, lat, lon
       from events e left join best b on e.user_id = b.user_id and hour(e.ts) = b.posid and n = 1"""
)
def facts_with_position(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact with the latest position of its key, or none."""
    facts, location = _positions(spark, folder)
    placed = joins.attach_position(facts, location, ["log_hash", "posid"], ["time"])
    return placed.select("event_id", "log_hash", F.col("posid").cast("bigint").alias("posid"), "lat", "lon")


def _positions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = read(spark, folder, "events")
    keys = [F.col("user_id").alias("log_hash"), F.hour("ts").alias("posid")]
    facts = events.select(*keys, "event_id")
    location = events.where(F.col("event_type") == "signup").select(
        *keys, F.col("ts").alias("time"), F.col("value").alias("lat"), (F.col("value") / 2).alias("lon")
    )
    return facts, location


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi
       from lineitem where l_orderkey in (7, 42, 777)"""
)
def filter_by_log(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of chosen logs."""
    return filters.of_log(lines(spark, folder), 7, 42, 777).select("log_hash", "line", "kpi")


@query(
    """with catalog as (select event_id, case event_type when 'signup' then 'logs'
              when 'purchase' then 'spatial_ref_sys' when 'error' then 'x_layer_statistics'
              when 'click' then 'android_metadata'
              else case when user_id % 2 = 0 then 'signalling' else 'lte_rrc_tmsi' end end as table_name from events)
       select 'default' as mode, event_id, table_name from catalog
        where table_name not in ('spatial_ref_sys', 'x_layer_statistics', 'android_metadata')
       union all select 'exclude', event_id, table_name from catalog where table_name in ('logs', 'lte_rrc_tmsi')
       union all select 'only', event_id, table_name from catalog where table_name in ('logs', 'spatial_ref_sys')
       union all select 'relational', event_id, table_name from catalog where table_name in ('logs', 'signalling')"""
)
def table_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog rows that each kind of table list keeps."""
    kind = F.col("event_type")
    other = F.when(F.col("user_id") % 2 == 0, "signalling").otherwise("lte_rrc_tmsi")
    name = (
        F.when(kind == "signup", "logs")
        .when(kind == "purchase", "spatial_ref_sys")
        .when(kind == "error", "x_layer_statistics")
        .when(kind == "click", "android_metadata")
        .otherwise(other)
    )
    catalog = read(spark, folder, "events").select("event_id", name.alias("table_name"))
    modes = {
        "default": filters.TableFilter(),
        "exclude": filters.TableFilter(exclude=filters.parse_table_list("signalling,nothing")),
        "only": filters.TableFilter(only=filters.parse_table_list("spatial_ref_sys\nx_layer_statistics")),
        "relational": filters.TableFilter(relational_target=True),
    }
    kept = [F.when(f.condition(F.col("table_name")), F.lit(m)) for m, f in modes.items()]
    return catalog.select(F.explode(F.array_compact(F.array(*kept))).alias("mode"), "event_id", "table_name")


@query(
    """select event_id, 'location' as table_name, octet_length(props::blob) as geom_bytes from events
       union all select event_id, 'kpi', null from events"""
)
def geometry_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Geometry only in the position table, the legacy column nowhere."""
    events = read(spark, folder, "events").select(
        "event_id", F.col("props").cast("binary").alias("geom"), F.lit(1).alias("time_ms")
    )
    parts = [
        filters.only_location_geometry(filters.drop_legacy(events), t).withColumn("table_name", F.lit(t))
        for t in ("location", "kpi")
    ]
    both = evolution.merge_by_name(*parts)
    return both.select("event_id", "table_name", F.length("geom").cast("bigint").alias("geom_bytes"))


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi from lineitem
       where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderkey % 2 = 0)"""
)
def already_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming rows whose log is in the ledger."""
    return joins.already_merged(lines(spark, folder).select("log_hash", "line", "kpi"), _even_ledger(spark, folder))


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi from lineitem
       where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderkey % 2 = 0)"""
)
def new_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming rows whose log is not in the ledger."""
    return joins.new_logs(lines(spark, folder).select("log_hash", "line", "kpi"), _even_ledger(spark, folder))


def _even_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return order_logs(spark, folder).select("log_hash").where(F.col("log_hash") % 2 == 0)


@query(
    """select 'in/' || event_type || '/' || event_id as path, user_id as log_hash,
              row_number() over (partition by user_id order by 'in/' || event_type || '/' || event_id) = 1 as is_first
       from events"""
)
def first_file_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Which file of each log comes first (M2)."""
    return joins.first_file_wins(_event_files(spark, folder)).select("path", "log_hash", "is_first")


def _event_files(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("in/"), "event_type", F.lit("/"), F.col("event_id").cast("string"))
    return read(spark, folder, "events").select(path.alias("path"), F.col("user_id").alias("log_hash"), "value", "ts")


@query(
    """with s as (select distinct p_type, p_brand from part where p_size % 2 = 1),
            t as (select distinct p_type, p_brand from part where p_size % 3 = 0)
       select p_type as table_name, p_brand as column_name, 'source_only' as side from s anti join t using (p_type, p_brand)
       union all
       select p_type, p_brand, 'target_only' from t anti join s using (p_type, p_brand)"""
)
def schema_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that only the source or only the target has."""
    part = read(spark, folder, "part").withColumnsRenamed({"p_type": "table_name", "p_brand": "column_name"})
    source, target = part.where(F.col("p_size") % 2 == 1), part.where(F.col("p_size") % 3 == 0)
    return joins.schema_difference(source, target, ["table_name", "column_name"])


# Cleaning and identity --------------------------------------------------


@query(
    """select o_orderkey, ((o_custkey + 358096071000000) % 1000000000) * 4294967296
                          + epoch(o_orderdate)::bigint as log_hash from orders"""
)
def log_hash_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Identity from IMEI and start."""
    orders = read(spark, folder, "orders")
    return orders.select("o_orderkey", _order_hash().alias("log_hash"))


def _order_hash() -> Column:
    return identity.encode_log_hash(F.col("o_custkey") + F.lit(IMEI_BASE), F.col("o_orderdate"))


@query(
    f"""with h as (select o_orderkey, o_custkey, ((o_custkey + 358096071000000) % 1000000000) * 4294967296
                          + epoch(o_orderdate)::bigint as log_hash from orders)
        select o_orderkey, (log_hash >> 32) as imei_tail, (log_hash & 4294967295) as start_epoch,
               strftime(make_timestamp((log_hash & 4294967295) * 1000000), {SQL_TIME}) as start,
               strftime(make_timestamp((log_hash & 4294967295) * 1000000)
                        + to_seconds((o_custkey % 3 - 1) * 25200), '%Y_%m') as log_ym from h"""
)
def log_hash_decode(spark: SparkSession, folder: str) -> DataFrame:
    """IMEI tail, start and local month from an identity."""
    log_hash = F.col("log_hash")
    hashed = read(spark, folder, "orders").select("o_orderkey", "o_custkey", _order_hash().alias("log_hash"))
    offset = (F.col("o_custkey") % 3 - 1) * 25200000
    return hashed.select(
        "o_orderkey",
        identity.log_hash_imei(log_hash).alias("imei_tail"),
        identity.log_hash_epoch(log_hash).alias("start_epoch"),
        time_text(identity.epoch_to_time(identity.log_hash_epoch(log_hash))).alias("start"),
        identity.log_month(log_hash, offset).alias("log_ym"),
    )


@query(
    """select strftime(o_orderdate + interval 7 hour, '%Y_%m') as log_ym, count(*) as row_count
       from lineitem join orders on l_orderkey = o_orderkey group by 1"""
)
def month_by_log(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month folder when the log start decides (L1)."""
    per_log = lines(spark, folder).groupBy("log_hash").agg(F.count(F.lit(1)).alias("n"))
    placed = joins.attach_log(per_log, order_logs(spark, folder).select("log_hash", "log_ym"))
    return placed.groupBy("log_ym").agg(F.sum("n").alias("row_count"))


@query("select strftime(l_shipdate, '%Y_%m') as row_ym, count(*) as row_count from lineitem group by 1")
def month_by_row(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month folder when the row time decides (L2)."""
    months = lines(spark, folder).select(identity.month_of(F.col("time")).alias("row_ym"))
    return months.groupBy("row_ym").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    f"""with dirty as (select event_id, case event_type when 'error' then '159841' || strftime(ts, {SQL_TIME})
                when 'view' then '' when 'signup' then 'NaT' else strftime(ts, {SQL_TIME}) end as t from events)
        select event_id, strftime(date_trunc('millisecond', try_cast(t as timestamp)), {SQL_TIME}) as modem_time,
               strftime(try_cast(t as timestamp), {SQL_TIME}) as time from dirty"""
)
def bad_timestamp_to_null(spark: SparkSession, folder: str) -> DataFrame:
    """Times from text, null where it is none."""
    text = _dirty_time(F.col("event_type"), time_text("ts"))
    dirty = read(spark, folder, "events").select("event_id", text.alias("t"))
    return dirty.select(
        "event_id",
        time_text(cleaning.to_time_ms(F.col("t"))).alias("modem_time"),
        time_text(cleaning.to_time(cleaning.not_a_time_to_null(F.col("t")))).alias("time"),
    )


def _dirty_time(kind: Column, text: Column) -> Column:
    return (
        F.when(kind == "error", F.concat(F.lit("159841"), text))
        .when(kind == "view", "")
        .when(kind == "signup", "NaT")
        .otherwise(text)
    )


@query("select c_custkey, substr(c_mktsegment, 1, 5) as bsic from customer")
def prefix5(spark: SparkSession, folder: str) -> DataFrame:
    """First five characters."""
    return read(spark, folder, "customer").select(
        "c_custkey", cleaning.first_characters(F.col("c_mktsegment")).alias("bsic")
    )


@query("select p_partkey, substr(p_brand, 4) as band from part")
def strip_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """Text without its three-character prefix."""
    return read(spark, folder, "part").select("p_partkey", cleaning.strip_prefix(F.col("p_brand")).alias("band"))


def _lenient_texts() -> dict[str, Column]:
    return {
        "leading": F.col("o_orderpriority"),
        "none": F.col("o_orderstatus"),
        "mixed": F.concat(F.lit(" -"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("dB")),
        "absent": F.when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("string")),
        "large": F.concat(F.col("o_custkey").cast("string"), F.lit("0000000000000000000000")),
    }


LENIENT_SQL = """with t as (select o_orderkey, o_orderpriority as leading_, o_orderstatus as none_,
              ' -' || o_totalprice::decimal(18,2)::varchar || 'dB' as mixed_,
              case when o_orderstatus <> 'F' then o_custkey::varchar end as absent_,
              o_custkey::varchar || '0000000000000000000000' as large_ from orders) """


def _lenient_int_sql(name: str) -> str:
    found = f"regexp_extract({name}_, '^\\s*([+-]?[0-9]+)', 1)"
    number = f"coalesce(try_cast({found} as hugeint), 0)"
    return f"case when {name}_ is null then null else least({number}, 9223372036854775807)::bigint end as {name}_value"


@query(
    LENIENT_SQL
    + "select o_orderkey, "
    + ", ".join(_lenient_int_sql(n) for n in ("leading", "none", "mixed", "absent", "large"))
    + " from t"
)
def lenient_int(spark: SparkSession, folder: str) -> DataFrame:
    """Leading integer of a text, else 0."""
    texts = {f"{n}_value": cleaning.lenient_integer(c) for n, c in _lenient_texts().items()}
    return read(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in texts.items()])


def _lenient_double_sql(name: str) -> str:
    found = f"regexp_extract({name}_, '^\\s*([+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)', 1)"
    return f"case when {name}_ is null then null else coalesce(try_cast({found} as double), 0) end as {name}_value"


@query(
    LENIENT_SQL
    + "select o_orderkey, "
    + ", ".join(_lenient_double_sql(n) for n in ("leading", "none", "mixed", "absent", "large"))
    + " from t"
)
def lenient_double(spark: SparkSession, folder: str) -> DataFrame:
    """Leading number of a text, else 0."""
    texts = {f"{n}_value": cleaning.lenient_double(c) for n, c in _lenient_texts().items()}
    return read(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in texts.items()])


@query("select event_id, nullif(case when event_type = 'view' then '' else props end, '') as duration from events")
def empty_to_null(spark: SparkSession, folder: str) -> DataFrame:
    """Empty text is no value."""
    text = F.when(F.col("event_type") == "view", "").otherwise(F.col("props"))
    return read(spark, folder, "events").select("event_id", cleaning.empty_to_null(text).alias("duration"))


@query(
    """select event_id, case when event_type = 'view' then null else octet_length(props::blob) end as blob_bytes,
              case when event_type = 'view' then null else hex(props::blob) end as blob_hex from events"""
)
def empty_blob_to_null(spark: SparkSession, folder: str) -> DataFrame:
    """Empty binary is no value; hex text for text targets."""
    raw = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("props")).cast("binary")
    blob = cleaning.blob_or_null(raw)
    return read(spark, folder, "events").select(
        "event_id", F.length(blob).cast("bigint").alias("blob_bytes"), F.hex(blob).alias("blob_hex")
    )


@query(
    """with t as (select o_orderkey, case when o_custkey % 7 = 0 then 'dev' else 'v3.0.' || (700 + o_custkey % 90) end as v,
                         case when o_orderstatus = 'F' then 'wifi_scanned' else 'signalling' end as table_name from orders),
            p as (select o_orderkey, table_name, coalesce(
                     try_cast(split_part(replace(v, 'v', ''), '.', 1) as bigint) * 1000000
                   + try_cast(split_part(replace(v, 'v', ''), '.', 2) as bigint) * 1000
                   + try_cast(split_part(replace(v, 'v', ''), '.', 3) as bigint), 0) as app_version from t)
       select * from p where not (table_name = 'wifi_scanned' and app_version < 3000742)"""
)
def version_parse_filter(spark: SparkSession, folder: str) -> DataFrame:
    """App version as a number, and the table it gates."""
    text = F.when(F.col("o_custkey") % 7 == 0, "dev").otherwise(
        F.concat(F.lit("v3.0."), (F.col("o_custkey") % 90 + 700).cast("string"))
    )
    table = F.when(F.col("o_orderstatus") == "F", "wifi_scanned").otherwise("signalling")
    parsed = read(spark, folder, "orders").select(
        "o_orderkey", table.alias("table_name"), identity.app_version(text).alias("app_version")
    )
    return parsed.where(filters.version_gate(F.col("table_name"), F.col("app_version")))


@query(
    """select conv_id, turn, case when role = 'user' then 1 else 0 end as direction, length(text) as characters
       from conversations"""
)
def direction_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Message direction as a number."""
    symbol = F.when(F.col("role") == "user", "send").when(F.col("role") == "assistant", "recv")
    return read(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        cleaning.direction(symbol).alias("direction"),
        F.length("text").cast("bigint").alias("characters"),
    )


_CELLS = {
    "time": "DATETIME",
    "modem_time": "DATETIME",
    "x_duration": "TEXT",
    "x_trip_time": "real",
    "gsm_bsic": "TEXT",
    "android_cellid_from_cellfile": "INT",
    "lte_m_tmsi": "int",
    "exynos_basic_info_nr_cellid": "BIGINT",
    "x_session_master_session_id": "INT",
    "label": "test",
    "earfcn": "smallint",
    "level": "Double",
    "note": "TEXT",
}


def _event_cells(spark: SparkSession, folder: str) -> DataFrame:
    kind, when = F.col("event_type"), time_text("ts")
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    user = F.col("user_id").cast("string")
    cells = {
        "time": when,
        "modem_time": _dirty_time(kind, when),
        "x_duration": F.when(kind == "view", "").otherwise(amount),
        "x_trip_time": amount,
        "gsm_bsic": F.col("props"),
        "android_cellid_from_cellfile": F.concat(user, F.lit("abc")),
        "lte_m_tmsi": F.lit("4294967295"),
        "exynos_basic_info_nr_cellid": F.lit("18446744073709551615"),
        "x_session_master_session_id": F.concat(F.lit("s"), user),
        "label": kind,
        "earfcn": F.when(kind == "error", "bad").otherwise(user),
        "level": F.when(kind == "click", "n/a").otherwise(amount),
        "note": F.when(kind == "view", "").otherwise(F.concat(F.lit("a,\n\""), kind)),
    }
    bytes_of = F.array(*[cells[n].cast("string").cast("binary") for n in _CELLS])
    return read(spark, folder, "events").select("event_id", bytes_of.alias("cells"), F.lit("events").alias("layout"))


def _event_columns() -> TableColumns:
    columns = TableColumns("kpi")
    columns.add_layout("events", list(_CELLS.items()))
    return columns


_TYPED_SQL = f"""select event_id, strftime(ts, {SQL_TIME}) as time,
       case when event_type in ('click', 'purchase')
            then strftime(date_trunc('millisecond', ts), {SQL_TIME}) end as modem_time,
       case when event_type <> 'view' then value end as x_duration, value as x_trip_time,
       substr(props, 1, 5) as gsm_bsic, user_id as android_cellid_from_cellfile, 4294967295 as lte_m_tmsi,
       '18446744073709551615' as exynos_basic_info_nr_cellid, 's' || user_id as x_session_master_session_id,
       event_type as label, case when event_type <> 'error' then user_id end as earfcn,
       case when event_type <> 'click' then value end as level,
       case when event_type <> 'view' then 'a,' || chr(10) || '"' || event_type end as note,
       case when event_type in ('error', 'click') then 1 else 0 end as lost_cells from events"""


def _type_events(rows: DataFrame, columns: TableColumns) -> DataFrame:
    typed = typed_rows.type_columns(rows, columns, columns.target(), ["event_id"])
    shown = {
        "time": time_text("time"),
        "modem_time": time_text("modem_time"),
        "exynos_basic_info_nr_cellid": F.col("exynos_basic_info_nr_cellid").cast("string"),
        "lost_cells": F.col(typed_rows.CAST_ERRORS),
    }
    return typed.withColumns(shown).drop(typed_rows.CAST_ERRORS)


@query(_TYPED_SQL)
def typed_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Text cells to typed columns by name and declared type."""
    columns = _event_columns()
    return _type_events(typed_rows.parse_cells(_event_cells(spark, folder), columns), columns)


@query(f"select * replace ('X' || note as note) from ({_TYPED_SQL}) where earfcn % 2 = 0")
def preprocess_hook(spark: SparkSession, folder: str) -> DataFrame:
    """User code between reading and typing."""

    def keep_even(rows: DataFrame, table: str) -> DataFrame:
        even = F.col("earfcn").try_cast("bigint") % 2 == 0
        return rows.where(even).withColumn("note", F.concat(F.lit("X"), F.nullif("note", F.lit(""))))

    columns = _event_columns()
    text = typed_rows.parse_cells(_event_cells(spark, folder), columns).transform(keep_even, "kpi")
    return _type_events(text, columns)


# Geometry ---------------------------------------------------------------


def _line_points(spark: SparkSession, folder: str) -> DataFrame:
    point = derived_logs.point_blob(F.col("l_extendedprice") / -7.0, F.col("l_tax") - F.col("l_quantity"))
    blob = F.when(F.col("l_linenumber") == 7, F.expr("substring(p, 1, 59)")).otherwise(F.col("p"))
    rows = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", point.alias("p"))
    return rows.select("l_orderkey", "l_linenumber", blob.alias("geom"))


@query(
    """select l_orderkey, l_linenumber, case when l_linenumber <> 7 then l_extendedprice / -7.0 end as lon,
              case when l_linenumber <> 7 then l_tax - l_quantity end as lat from lineitem"""
)
def geo_lonlat(spark: SparkSession, folder: str) -> DataFrame:
    """Coordinates of point blobs, none for other blobs."""
    return geometry.with_coordinates(_line_points(spark, folder), "geom").drop("geom")


def _encoded(spark: SparkSession, folder: str, encoded: Column, prefix_bytes: int) -> DataFrame:
    rows = _line_points(spark, folder).select("l_orderkey", "l_linenumber", encoded.alias("g"))
    point = F.when(F.length("g") < 59, F.col("g"))
    return geometry.with_doubles(rows, point, prefix_bytes, ["x", "y"]).select(
        "l_orderkey",
        "l_linenumber",
        F.length("g").cast("bigint").alias("bytes"),
        F.hex(F.substring("g", 1, prefix_bytes)).alias("prefix"),
        "x",
        "y",
    )


def _encoded_sql(size: int, prefix: str) -> str:
    kept = f"substr('0001E6100000', 1, {len(prefix)})"
    return f"""select l_orderkey, l_linenumber, case when l_linenumber = 7 then 59 else {size} end as bytes,
                      case when l_linenumber = 7 then substr(raw, 1, {len(prefix)}) else '{prefix}' end as prefix,
                      case when l_linenumber <> 7 then l_extendedprice / -7.0 end as x,
                      case when l_linenumber <> 7 then l_tax - l_quantity end as y
               from (select *, {kept} as raw from lineitem)"""


@query(_encoded_sql(22, "E6100000010C"))
def geo_mssql_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Points in the SQL Server layout, other blobs unchanged."""
    return _encoded(spark, folder, geometry.to_mssql(F.col("geom")), 6)


@query(_encoded_sql(25, "0101000020E6100000").replace("substr(raw, 1, 18)", "null"))
def geo_ewkb_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Points as EWKB, other blobs unchanged."""
    rows = _encoded(spark, folder, geometry.to_ewkb(F.col("geom")), 9)
    return rows.withColumn("prefix", F.when(F.col("bytes") < 59, F.col("prefix")))


# Aggregations -----------------------------------------------------------


@query(
    """with t as (select distinct user_id, event_type from events)
       select user_id as log_hash, sha1(string_agg(event_type, chr(10) order by event_type)) as fingerprint
       from t group by user_id"""
)
def schema_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-1 of the schema of each log."""
    ddl = read(spark, folder, "events").select(F.col("user_id").alias("log_hash"), F.col("event_type").alias("ddl"))
    return aggregates.schema_fingerprints(ddl)


@query(
    """with t as (select distinct user_id, event_type from events),
            f as (select sha1(string_agg(event_type, chr(10) order by event_type)) as fingerprint from t group by user_id)
       select fingerprint, count(*) as logs from f group by fingerprint"""
)
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Logs per schema."""
    return aggregates.schema_drift(schema_fingerprint(spark, folder))


_IMEI_SQL = """select user_id, props as imei from (select user_id, props,
        row_number() over (partition by user_id order by ts desc, event_id desc) as n
        from events where event_type <> 'error') where n = 1"""


def _event_imei(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "").otherwise(F.col("props"))
    rows = read(spark, folder, "events").select(
        F.col("user_id").alias("log_hash"), text.alias("imei"), "ts", "event_id"
    )
    return aggregates.latest_nonempty(rows, "imei", ["ts", "event_id"])


@query(f"select user_id as log_hash, imei from ({_IMEI_SQL})")
def latest_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """Last value per log that is not empty (G1)."""
    return _event_imei(spark, folder)


@query(
    f"""select event_id, e.user_id as log_hash, value, imei from events e
        left join ({_IMEI_SQL}) i on e.user_id = i.user_id"""
)
def imei_on_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The device of the log on every row (G1)."""
    rows = read(spark, folder, "events").select("event_id", F.col("user_id").alias("log_hash"), "value")
    return aggregates.add_to_rows(rows, _event_imei(spark, folder))


@query(
    f"""select o_orderkey as log_hash, o_orderpriority as priority, strftime(coalesce(
               case when o_orderstatus <> 'F' then o_orderdate + interval 28 day end, m), {SQL_TIME}) as log_end_time
        from orders left join (select l_orderkey, max(l_shipdate) as m from lineitem group by 1) on l_orderkey = o_orderkey"""
)
def end_time_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """End time of a log, or its last heartbeat where it has none."""
    status = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("log_hash"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate") + F.expr("interval 28 days")).alias("log_end_time"),
    )
    heartbeat = lines(spark, folder).select("log_hash", "time")
    filled = aggregates.fallback_end_time(status, heartbeat)
    return filled.select("log_hash", "priority", time_text("log_end_time").alias("log_end_time"))


@query("select source as log_hash, sum(strlen(text))::bigint as size_bytes from documents group by source")
def bytes_per_log(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per log over its parts."""
    parts = read(spark, folder, "documents").select(F.col("source").alias("log_hash"), F.octet_length("text").alias("n"))
    return aggregates.total_size(parts, F.col("n"))


@query(
    """select 't' || l_suppkey as "table", 'o' || l_partkey as operation, l_orderkey || '-' || l_linenumber as batch_id,
              l_extendedprice as duration from lineitem
       order by l_extendedprice desc, 1, 2, 3 limit 20"""
)
def slowest_ops(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty longest operations."""
    metrics = read(spark, folder, "lineitem").select(
        F.concat(F.lit("t"), F.col("l_suppkey").cast("string")).alias("table"),
        F.concat(F.lit("o"), F.col("l_partkey").cast("string")).alias("operation"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("batch_id"),
        F.col("l_extendedprice").alias("duration"),
    )
    return aggregates.slowest_operations(metrics)


@query(
    f"""select user_id, event_id, strftime(ts, {SQL_TIME}) as time, value from events
        where event_id in (select min(event_id) from events group by user_id)"""
)
def first_row_per_file(spark: SparkSession, folder: str) -> DataFrame:
    """First row of each file."""
    rows = read(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    first = aggregates.first_row(rows, "user_id", "event_id")
    return first.select("user_id", "event_id", time_text("ts").alias("time"), "value")


# Merge ------------------------------------------------------------------


@query(
    """select o_orderkey as log_hash, o_totalprice::varchar as kpi, o_orderpriority as priority, null as status from orders
       where o_orderstatus = 'F'
       union all select o_orderkey, (o_custkey + 9007199254740993)::varchar, null, o_orderstatus from orders
       where o_orderstatus <> 'F'"""
)
def merge_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """Logs with differing columns and types in one table, numbers beyond 2**53 too (M3, M4)."""
    orders = read(spark, folder, "orders").withColumnRenamed("o_orderkey", "log_hash")
    older = orders.where(F.col("o_orderstatus") == "F").select(
        "log_hash", F.col("o_totalprice").alias("kpi"), F.col("o_orderpriority").alias("priority")
    )
    newer = orders.where(F.col("o_orderstatus") != "F").select(
        "log_hash", (F.col("o_custkey") + 9007199254740993).alias("kpi"), F.col("o_orderstatus").alias("status")
    )
    return evolution.merge_by_name(older, newer)


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')"""
)
def unmerge(spark: SparkSession, folder: str) -> DataFrame:
    """Facts without those of removed logs (M5)."""
    removed = read(spark, folder, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("log_hash"))
    return joins.new_logs(lines(spark, folder).select("log_hash", "line", "kpi"), removed)


_DISPOSITION_SQL = """with f as (select 'in/' || event_type || '/' || event_id as path, user_id as log_hash,
            case when value < 1 then 'unreadable' when user_id = 0 then 'invalid_identity'
                 when value < 2 then 'no_end_time' end as problem from events),
       r as (select *, case when problem is null then row_number() over (
                 partition by problem is null, log_hash order by path) end as n from f)
       select path, log_hash, case when problem is not null then problem when n > 1 then 'already_merged'
              when exists (select 1 from customer where c_custkey = log_hash and c_custkey % 3 = 0) then 'already_merged'
              else 'merged' end as status from r"""


@query(_DISPOSITION_SQL)
def merge_disposition(spark: SparkSession, folder: str) -> DataFrame:
    """What happens to each incoming file."""
    value, ts = F.col("value"), F.col("ts")
    files = _event_files(spark, folder).select(
        "path",
        "log_hash",
        F.when(value < 1, "broken").alias("error"),
        identity.month_of(ts).alias("log_ym"),
        ts.alias("start"),
        F.when(value >= 2, ts).alias("end"),
    )
    files = files.withColumn("problem", merge.identity_problem())
    active = read(spark, folder, "customer").select(F.col("c_custkey").alias("log_hash")).where("log_hash % 3 = 0")
    return merge.decide(files, active, target_exists=True).select("path", "log_hash", "status")


@query(f"select status, count(*) as files from ({_DISPOSITION_SQL}) group by status")
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Files per outcome."""
    return aggregates.run_summary(merge_disposition(spark, folder))


# Views ------------------------------------------------------------------


def _kpis(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    _, location = _positions(spark, folder)
    facts = read(spark, folder, "events").select(
        F.col("user_id").alias("log_hash"),
        F.hour("ts").alias("posid"),
        F.col("ts").alias("time"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("rsrp"),
        F.length("props").cast("bigint").alias("earfcn"),
    )
    return facts, location


_PLACED_SQL = """with best as (select user_id, hour(ts) as posid, value as lat, value / 2 as lon,
            row_number() over (partition by user_id, hour(ts) order by ts desc, value desc) as n
            from events where event_type = 'signup'),
       placed as (select e.*, lat, lon from events e
            left join best b on e.user_id = b.user_id and hour(e.ts) = b.posid and n = 1)"""


@query(
    _PLACED_SQL
    + f"""select user_id as log_hash, strftime(ts, {SQL_TIME}) as time, lat, lon, value as kpi
          from placed where event_type <> 'error'"""
)
def kpi_with_position(spark: SparkSession, folder: str) -> DataFrame:
    """One KPI on the map (V1)."""
    facts, location = _kpis(spark, folder)
    return views.kpi_with_position(facts, "rsrp", location).withColumn("time", time_text("time"))


@query(
    _PLACED_SQL
    + f"""select user_id as log_hash, strftime(ts, {SQL_TIME}) as time,
                 case when event_type <> 'error' then value end as rsrp, length(props) as earfcn, lat, lon from placed"""
)
def kpi_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Several KPIs with time and position, in time order (V2)."""
    facts, location = _kpis(spark, folder)
    return views.kpi_bundle(facts, ["rsrp", "earfcn"], location).withColumn("time", time_text("time"))


@query(
    """select conv_id as log_hash, turn as time, case role when 'user' then 'send' when 'assistant' then 'recv' end as symbol,
              case when role = 'user' then 1 else 0 end as direction, text as info from conversations"""
)
def l3_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages with direction and whole text (V3)."""
    symbol = F.when(F.col("role") == "user", "send").when(F.col("role") == "assistant", "recv")
    return views.l3_messages(
        read(spark, folder, "conversations").select(
            F.col("conv_id").alias("log_hash"),
            F.col("turn").alias("time"),
            symbol.alias("symbol"),
            F.col("text").alias("info"),
        )
    )


@query(
    f"""select o_orderkey as log_hash, strftime(o_orderdate, {SQL_TIME}) as log_start_time,
               strftime(o_orderdate + interval 28 day, {SQL_TIME}) as log_end_time, o_orderpriority as priority
        from orders where o_orderkey % 2 = 0"""
)
def log_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Logs that are merged now (V4)."""
    found = views.log_inventory(order_logs(spark, folder), _even_ledger(spark, folder))
    times = {c: time_text(c) for c in ("log_start_time", "log_end_time")}
    return found.withColumns(times).drop("log_ym")


# Whole runs -------------------------------------------------------------


@query(
    """select l_orderkey as log_hash, l_linenumber as line, l_quantity as kpi
       from lineitem join orders on l_orderkey = o_orderkey
       where l_shipdate between o_orderdate - interval 48 hour and o_orderdate + interval 28 day + interval 48 hour"""
)
def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The time clamp over a file stream, read back."""
    logs, out = order_logs(spark, folder), scratch_path(spark, "stream")
    stream = stream_tables.stream_table(spark, f"{folder}/lineitem.parquet")
    kept = stream_tables.clamp_stream(stream, logs, out, _as_lines)
    return kept.select("log_hash", "line", "kpi")


@query(derived_logs.MERGED_SQL)
def merge_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Log files made from events, merged, and read back with positions."""
    store = derived_logs.merged_store(spark, read(spark, folder, "events"))
    return derived_logs.read_back(store)


@query(derived_logs.REPORT_SQL)
def merge_report(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome, month folder and stored size of each merged log."""
    store = derived_logs.merged_store(spark, read(spark, folder, "events"))
    return derived_logs.report(store)


@query(derived_logs.UNMERGED_SQL)
def unmerge_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Merged logs, every other one removed again, some of those merged anew (M5, M8)."""
    events = read(spark, folder, "events")
    return derived_logs.after_unmerge(derived_logs.merged_store(spark, events), events)


@query(derived_logs.UNMERGED_SQL)
def unmerge_and_purge(spark: SparkSession, folder: str) -> DataFrame:
    """The same, after the space of the removed logs was given back (M5, M8)."""
    events = read(spark, folder, "events")
    return derived_logs.after_unmerge(derived_logs.merged_store(spark, events), events, purge=True)


@query(derived_logs.UNMERGED_SQL)
def unmerge_log_folders(spark: SparkSession, folder: str) -> DataFrame:
    """The same where each log has its own folder, so that removing one drops it (M5, M7)."""
    events = read(spark, folder, "events")
    store = derived_logs.merged_store(spark, events, layout=stores.PER_LOG)
    return derived_logs.after_unmerge(store, events)


@query(derived_logs.ROW_MONTH_SQL)
def merge_by_row_month(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month folder when merged by row time (L2)."""
    events = read(spark, folder, "events")
    store = derived_logs.merged_store(spark, events, month=stores.BY_ROW_MONTH)
    return derived_logs.rows_per_month(store)


@query(derived_logs.MERGED_SQL)
def folder_scan_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The same logs from files in nested folders, among files of other names."""
    return derived_logs.read_back(derived_cases.merged_folder(spark, read(spark, folder, "events")))


@query(derived_cases.CELLS_SQL)
def blob_and_text_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of any storage class in columns of any type, name, case and order."""
    return derived_cases.merged_cells(spark, read(spark, folder, "events"))


@query(derived_cases.OUTCOMES_SQL)
def merge_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Copies, bad cells, no identity, no end time and unreadable files: outcome, rows and columns."""
    return derived_cases.outcomes(spark, read(spark, folder, "events"))


@query(derived_cases.PREVIEW_SQL)
def merge_preview(spark: SparkSession, folder: str) -> DataFrame:
    """What a merge would do and write, before it does."""
    return derived_cases.previewed(spark, read(spark, folder, "events"))


@query(derived_logs.MERGED_SQL)
def follow_equals_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The same logs from a folder that grows while it is followed, with a run that breaks off."""
    return derived_logs.read_back(derived_cases.followed(spark, read(spark, folder, "events")))


@query(derived_cases.CATALOG_SQL)
def catalog_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that incoming files have and the store lacks, and the reverse."""
    return derived_cases.catalog_changes(spark, read(spark, folder, "events"))


@query(derived_cases.DRIFT_SQL)
def log_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Log files per schema fingerprint, two at every size."""
    return derived_cases.drift_of(spark, read(spark, folder, "events"))
