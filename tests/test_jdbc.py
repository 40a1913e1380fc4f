"""Statements and rows for relational targets; no database is started."""

import sample_logs as sl

from logtrail.functions import geometry
from logtrail.sinks import jdbc
from pyspark.sql import functions as F

PG = jdbc.JdbcTarget("jdbc:postgresql://h/db", jdbc.POSTGRESQL, "all_logs")
MS = jdbc.JdbcTarget("jdbc:sqlserver://h", jdbc.MSSQL, "dbo")


def rows(spark):
    df = spark.createDataFrame([(1, bytearray(sl.EXAMPLE_POINT), "x", "2018_03")], "log_hash bigint, geom binary, info string, log_ym string")
    return df.withColumn("geom", geometry.to_ewkb(F.col("geom")))


def test_geometry_layout_per_dialect(spark):
    assert bytes(jdbc.prepare(rows(spark), jdbc.POSTGRESQL).first().geom)[:9].hex() == "0101000020e6100000"
    out = jdbc.prepare(rows(spark), jdbc.MSSQL)
    assert bytes(out.first().geom)[:6].hex() == "e6100000010c" and "log_ym" not in out.columns


def test_statements(spark):
    ready = jdbc.prepare(rows(spark), jdbc.POSTGRESQL)
    assert jdbc.create_statement(ready, "logs", PG) == (
        'create table "all_logs"."logs" ("log_hash" bigint unique, "geom" bytea, "info" text)'
    )
    assert jdbc.add_columns_statement(ready, ["log_hash"], "kpi", PG) == (
        'alter table "all_logs"."kpi" add "geom" bytea, add "info" text'
    )
    assert jdbc.add_columns_statement(ready, ["log_hash"], "kpi", MS) == (
        'alter table "dbo"."kpi" add "geom" varbinary(MAX), "info" varchar(MAX)'
    )
    assert jdbc.add_columns_statement(ready, ready.columns, "kpi", PG) is None
    assert jdbc.delete_statement("kpi", 5, PG) == 'delete from "all_logs"."kpi" where log_hash = 5'
    assert jdbc.index_statement("kpi", MS) == 'create index "lh_idx_kpi" on "dbo"."kpi" (log_hash)'


def test_table_for_columnar_targets_only_is_skipped(spark):
    jdbc.append(rows(spark), "lte_rrc_tmsi", PG)
