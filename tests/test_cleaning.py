"""Cleaning rules against SQLite evaluating the same expression."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from logtrail.functions import cleaning, identity
from logtrail.functions.types import is_datetime_column, spark_type, widen, widest
from logtrail.operators.filters import TableFilter, parse_table_list

TEXTS = [
    None, "", "12abc", "abc", " 7.9x", "1e3", "-5", "+6", "-", "  -12.5e2z", ".5", "5.", "1.5e", "99999999999999999999",
    "-99999999999999999999", "9223372036854775807", "0000000000000000000005", "0x10", "nan", "inf", "1d", "\t42", "1_0",
    "1" * 45,
]


def spark_values(spark, texts, build):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
    return [r.v for r in rows.select("n", build(F.col("x")).alias("v")).orderBy("n").collect()]


def sqlite_values(texts, sql):
    db = sqlite3.connect(":memory:")
    return [db.execute(f"select {sql} from (select ? as x)", (t,)).fetchone()[0] for t in texts]


@pytest.mark.parametrize(
    ("build", "sql"),
    [
        (cleaning.lenient_integer, "cast(x as int)"),
        (cleaning.lenient_double, "cast(x as double)"),
        (cleaning.first_characters, "substr(x, 0, 6)"),
        (cleaning.empty_to_null, "nullif(x, '')"),
        (cleaning.strip_prefix, "substr(x, 4)"),
        (cleaning.direction, "case when x = 'send' then 1 else 0 end"),
    ],
)
def test_rule_matches_sqlite(spark, build, sql):
    texts = [*TEXTS, "send", "GSM900", "GSM1800", "αβγδεζ"]
    assert spark_values(spark, texts, build) == sqlite_values(texts, sql)


def test_modem_time_matches_sqlite_and_rejects_impossible_days(spark):
    texts = [
        None, "", "159841018-03-10 07:24:42.191", "2018-03-10 07:24:42.191", "2018-03-10 07:24:42", "NaT", "x",
        "2018-13-01 00:00:00", "2018-02-31 01:00:00",
    ]
    text = spark_values(spark, texts, lambda c: F.date_format(cleaning.to_time_ms(c), "yyyy-MM-dd HH:mm:ss.SSS"))
    want = sqlite_values(texts, "strftime('%Y-%m-%d %H:%M:%f', x)")
    assert text[:-1] == want[:-1]
    assert text[-1] is None


def test_app_version(spark):
    texts = ["v3.0.562", "3.0.742", "v3.1", "dev", None, "v10.20.30.4"]
    assert spark_values(spark, texts, identity.app_version) == [3000562, 3000742, 0, 0, 0, 10020030]


def test_identity_round_trip_and_local_month(spark):
    row = spark.sql("select 358096071732800L as imei, timestamp_ntz'2017-01-02 13:12:49' as start").select(
        identity.encode_log_hash(F.col("imei"), F.col("start")).alias("h")
    )
    out = row.select(
        "h",
        identity.log_hash_imei(F.col("h")).alias("imei"),
        identity.log_hash_epoch(F.col("h")).alias("epoch"),
    ).first()
    assert (out.h, out.imei, out.epoch) == (308090031533871569, 71732800, 1483362769)
    edge = spark.createDataFrame([(1519862399, 0), (1519862399, 25200000), (1519862399, -25200000)], "h bigint, o bigint")
    months = [r[0] for r in edge.select(identity.log_month(F.col("h"), F.col("o"))).collect()]
    assert months == ["2018_02", "2018_03", "2018_02"]


@pytest.mark.parametrize(
    ("declared", "column", "table", "kind"),
    [
        ("Double", "a", "t", "double"), ("FLOAT", "a", "t", "double"), ("real", "a", "t", "double"),
        ("smallint", "a", "t", "bigint"), ("INTEGER", "a", "t", "bigint"), ("int", "a", "t", "bigint"),
        ("short", "a", "t", "smallint"), ("bigint unique", "a", "t", "bigint"), ("TEXT", "a", "t", "string"),
        ("varchar(20)", "a", "t", "string"), ("test", "a", "t", "string"), ("DATETIME", "a", "t", "string"),
        ("DATETIME", "time", "t", "timestamp_ntz"), ("TEXT", "modem_time", "t", "timestamp_ntz"),
        ("real", "x_trip_time", "t", "double"), ("real", "x_interruption_time", "t", "double"),
        ("TEXT", "x_duration", "t", "double"), ("INT", "a_session_master_session_id", "t", "string"),
        ("BIGINT", "exynos_basic_info_nr_cellid", "t", "decimal(20,0)"), ("TEXT", "lte_mmec", "t", "bigint"),
        ("TEXT", "nr_rlc_ul_tp_kbps", "nr_deb_stat", "double"), ("TEXT", "nr_rlc_ul_tp_kbps", "t", "string"),
        ("BLOB", "geom", "t", "binary"), ("blob", "raw", "t", "binary"), ("", "a", "t", "string"),
    ],
)
def test_declared_types(declared, column, table, kind):
    assert spark_type(declared, column, table) == kind


def test_widening_lattice():
    assert widest(["smallint", "bigint"]) == "bigint"
    assert widen("bigint", "double") == "string"
    assert widen("double", "string") == "string"
    assert widen("binary", "bigint") == widen("timestamp_ntz", "double") == "string"
    assert is_datetime_column("log_start_time") and not is_datetime_column("time_of_day")


def test_table_filter_by_name_and_by_column_agree(spark):
    names = ["logs", "kpi", "spatial_ref_sys", "geometry_columns", "log_decode_message", "azq_internal_types",
             "android_metadata", "x_layer_statistics", "spatialite_history", "lte_rrc_tmsi", "wifi_scanned"]
    rows = spark.createDataFrame([(n,) for n in names], "t string")
    for f, kept in [
        (TableFilter(), {"logs", "kpi", "lte_rrc_tmsi", "wifi_scanned"}),
        (TableFilter(exclude=("kpi",)), {"logs", "lte_rrc_tmsi", "wifi_scanned"}),
        (TableFilter(only=("spatial_ref_sys", "android_metadata")), {"logs", "spatial_ref_sys"}),
        (TableFilter(relational_target=True), {"logs", "kpi", "wifi_scanned"}),
    ]:
        assert {n for n in names if f.keeps(n)} == kept
        assert {r.t for r in rows.where(f.condition(F.col("t"))).collect()} == kept
    assert parse_table_list("a, b\nc,,") == ("a", "b", "c")
