"""Relational targets over JDBC: K3, K4, F5, and M3, M5 for them.

Rows go out in batches from every task. Statements that change a target's
columns or remove a log are made here as text, per dialect, and run by
``execute`` through the driver's JDBC connection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail.functions import geometry

POSTGRESQL, MSSQL = "postgresql", "mssql"
BATCH_ROWS = 10_000

# Spark type to column type, per dialect.
COLUMN_TYPES = {
    POSTGRESQL: {
        "double": "double precision",
        "bigint": "bigint",
        "int": "integer",
        "smallint": "smallint",
        "string": "text",
        "timestamp_ntz": "timestamp",
        "binary": "bytea",
        "boolean": "boolean",
        "decimal(20,0)": "numeric(20)",
    },
    MSSQL: {
        "double": "float",
        "bigint": "bigint",
        "int": "int",
        "smallint": "smallint",
        "string": "varchar(MAX)",
        "timestamp_ntz": "datetime2",
        "binary": "varbinary(MAX)",
        "boolean": "bit",
        "decimal(20,0)": "numeric(20)",
    },
}


@dataclass(frozen=True)
class JdbcTarget:
    """A relational database and the schema its tables are in (M9)."""

    url: str
    dialect: str = POSTGRESQL
    schema: str = "public"
    properties: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> str:
        """Qualified table name."""
        return f'"{self.schema}"."{name}"'


def prepare(rows: DataFrame, dialect: str, strip_partitions: bool = True) -> DataFrame:
    """Rows as the target takes them: its own geometry layout, no folder columns."""
    if fixed.GEOMETRY_COLUMN in rows.columns and dialect == MSSQL:
        rows = rows.withColumn(fixed.GEOMETRY_COLUMN, geometry.ewkb_to_mssql(F.col(fixed.GEOMETRY_COLUMN)))
    return rows.drop("log_ym", "row_ym") if strip_partitions else rows


def create_statement(rows: DataFrame, name: str, target: JdbcTarget) -> str:
    """Statement that makes the table; ``log_hash`` is unique in ``logs``."""
    types = COLUMN_TYPES[target.dialect]
    parts = []
    for column, kind in rows.dtypes:
        unique = " unique" if name == fixed.LOGS_TABLE and column == "log_hash" else ""
        parts.append(f'"{column}" {types.get(kind, types["string"])}{unique}')
    return f"create table {target.table(name)} ({', '.join(parts)})"


def index_statement(name: str, target: JdbcTarget) -> str:
    """Statement for the index on the log (L3)."""
    return f'create index "lh_idx_{name}" on {target.table(name)} (log_hash)'


def add_columns_statement(rows: DataFrame, existing: list[str], name: str, target: JdbcTarget) -> str | None:
    """Statement that adds the columns the table lacks, if any (M3)."""
    types = COLUMN_TYPES[target.dialect]
    missing = [f'"{c}" {types.get(k, types["string"])}' for c, k in rows.dtypes if c not in existing]
    if not missing:
        return None
    words = ", ".join(missing) if target.dialect == MSSQL else ", ".join(f"add {m}" for m in missing)
    return f"alter table {target.table(name)} {'add ' if target.dialect == MSSQL else ''}{words}"


def delete_statement(name: str, log_hash: int, target: JdbcTarget) -> str:
    """Statement that removes one log from a table (M5)."""
    return f"delete from {target.table(name)} where log_hash = {int(log_hash)}"


def execute(spark: SparkSession, target: JdbcTarget, *statements: str) -> None:
    """Run statements in one transaction."""
    properties = spark._jvm.java.util.Properties()
    for key, value in target.properties.items():
        properties.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(target.url, properties)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
        connection.commit()
    finally:
        connection.close()


def append(rows: DataFrame, name: str, target: JdbcTarget) -> None:
    """Append rows of one table in batches; a table that is not for relational targets is skipped."""
    if name == fixed.COLUMNAR_ONLY_TABLE:
        return
    ready = prepare(rows, target.dialect)
    writer = ready.write.format("jdbc").mode("append").option("url", target.url)
    writer = writer.option("dbtable", target.table(name)).option("batchsize", str(BATCH_ROWS))
    writer.options(**target.properties).save()


def existing_columns(spark: SparkSession, name: str, target: JdbcTarget) -> list[str]:
    """Columns of a table that is there (S8); no rows are read."""
    reader = spark.read.format("jdbc").option("url", target.url).option("dbtable", target.table(name))
    return reader.options(**target.properties).load().columns


def load_table(rows: DataFrame, name: str, target: JdbcTarget, exists: bool) -> None:
    """Append to a table after adding the columns it lacks; a first append makes it (M3)."""
    if exists and name != fixed.COLUMNAR_ONLY_TABLE:
        spark = rows.sparkSession
        ready = prepare(rows, target.dialect)
        statement = add_columns_statement(ready, existing_columns(spark, name, target), name, target)
        if statement:
            execute(spark, target, statement)
    append(rows, name, target)
