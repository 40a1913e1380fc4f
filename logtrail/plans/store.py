"""Merged tables on a shared file system: layout, schemas and ledger.

A store is a folder in any Hadoop file system:

* ``tables/<table>/gen=<n>/…`` – partitioned Parquet, in one of two layouts.
  ``PER_BATCH`` (the default) has a folder per month and merge attempt. Its
  file count follows the data and not the number of logs. Removing a log is one
  ledger row, and ``purge`` gives the space back. ``PER_LOG`` has a folder per
  month and log. Removing a log drops its folders at once; it suits stores of
  up to some 100,000 logs.
* ``schemas`` – columns of each table. Columns are only ever added. A column
  that has to become wider starts a new ``gen``; reads cast older ones.
* ``ledger`` – what happened to each log, one file per change. It is written
  *before* a log's rows (``pending``) and *after* them (``merged``). Reads leave
  out rows of attempts that are not finished, so a half-written log is never
  seen. After ``LEDGER_CHANGES`` changes the state so far is written to
  ``ledger-base``; a read folds the newest base and the changes since.
* ``dispositions``, ``metrics``, ``ingest_events`` – reports per batch.

One writer at a time.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtrail.functions.types import quoted, widen
from logtrail.operators.aggregates import total_size
from logtrail.operators.joins import lookup_join
from logtrail import files
from logtrail.session import configure

LEDGER_SCHEMA = "log_hash bigint, log_ym string, status string, stored boolean, batch_id string, path string, at bigint, published boolean"
SCHEMAS_SCHEMA = "table_name string, gen int, ordinal int, column string, type string, attempt string"
DISPOSITION_SCHEMA = "path string, log_hash bigint, status string, reason string, batch_id string"
METRICS_SCHEMA = "batch_id string, table string, operation string, duration double, rows bigint"
EVENTS_SCHEMA = "batch_id string, path string, table string, event string, detail string"

# Ledger states. Rows are read only while their log is merged.
PENDING, MERGED, UNMERGED, FAILED = "pending", "merged", "unmerged", "failed"

# Folder levels: the month of the log start or of the row time, then one of these.
BY_LOG_MONTH, BY_ROW_MONTH = "log_ym", "row_ym"
PER_BATCH, PER_LOG = "batch_id", "log_hash"

TABLES_AT_ONCE = 8
# Files of single changes after which the ledger gets a new base.
LEDGER_CHANGES = 100


@dataclass(frozen=True)
class TableSchema:
    """Columns of one generation of a table, in order."""

    gen: int
    columns: dict[str, str]


class LogStore:
    """A merge target. ``namespace`` keeps its tables apart from all others (M9)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        namespace: str = "public",
        layout: str = PER_BATCH,
        month: str = BY_LOG_MONTH,
    ):
        self.spark = configure(spark)
        self.root = f"{root.rstrip('/')}/{namespace}"
        self.namespace = namespace
        self.layout = layout
        self.month = month

    # Reports and ledger -------------------------------------------------

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a report or to the ledger."""
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def record(self, *changes: tuple[DataFrame, str, bool, str | None]) -> None:
        """Write new ledger states, all at once.

        A change is ``logs(log_hash, log_ym, path)``, their status, whether
        their rows are on disk, and the attempt that wrote them; without one,
        the logs name it themselves in ``attempt``.
        """
        at = time.time_ns()
        states = [
            logs.select(
                "log_hash",
                "log_ym",
                F.lit(status).alias("status"),
                F.lit(stored).alias("stored"),
                (F.col("attempt") if batch_id is None else F.lit(batch_id)).alias("batch_id"),
                "path",
                F.lit(at).alias("at"),
                F.lit(status == MERGED).alias("published"),
            )
            for logs, status, stored, batch_id in changes
        ]
        # One file: all of it is there, or nothing.
        self.append("ledger", reduce(DataFrame.unionByName, states).coalesce(1))

    def _bases(self) -> list[str]:
        """Finished bases of the ledger, oldest first; named by the time they were begun, in milliseconds."""
        root = f"{self.root}/ledger-base"
        return [n for n in files.children(self.spark, root) if files.exists(self.spark, f"{root}/{n}/_SUCCESS")]

    def _ledger(self) -> DataFrame:
        """The newest base and all changes; some of these may be in the base already, which folds to the same."""
        changes, bases = self._read("ledger", LEDGER_SCHEMA), self._bases()
        if not bases:
            return changes
        return changes.unionByName(self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.root}/ledger-base/{bases[-1]}"))

    def compact_ledger(self, at_least: int = LEDGER_CHANGES) -> bool:
        """Write a new base when there are many files of changes since the last one; whether it did.

        Files of changes go once the base before this one holds them, so
        frames made a while ago can still be read.
        """
        root, bases = f"{self.root}/ledger-base", self._bases()
        changes = {n: at for n, at in files.written_at(self.spark, f"{self.root}/ledger").items() if n.endswith(".parquet")}
        last = int(bases[-1]) if bases else -1
        if sum(at > last for at in changes.values()) < at_least:
            return False
        # A second early: clocks of the store and of this machine may differ a little.
        begun = int(time.time() * 1000) - 1000
        columns = [field.name for field in T._parse_datatype_string(LEDGER_SCHEMA).fields]
        self.attempts().select(*columns).write.parquet(f"{root}/{max(begun, last + 1):020d}")
        old = [f"{self.root}/ledger/{n}" for n, at in changes.items() if at <= last]
        files.delete_all(self.spark, [*old, *[f"{root}/{n}" for n in bases[:-1]]])
        return True

    def attempts(self) -> DataFrame:
        """Latest state of each log per merge attempt."""
        values = ("log_ym", "status", "stored", "path", "at")
        state = F.max_by(F.struct(*values), "at").alias("s")
        folded = self._ledger().groupBy("log_hash", "batch_id").agg(state, F.max("published").alias("published"))
        return folded.select("log_hash", "batch_id", "s.*", "published")

    def ledger(self) -> DataFrame:
        """Latest state of each log."""
        values = ("log_ym", "status", "stored", "batch_id", "path", "at")
        order = F.struct(F.col("status") == MERGED, "at")
        state = F.max_by(F.struct(*values), order).alias("s")
        return self.attempts().groupBy("log_hash").agg(state).select("log_hash", "s.*")

    def hidden(self) -> DataFrame:
        """Keys of rows that are on disk and must not be read: few, whatever the size of the store."""
        states = self.attempts() if self.layout == PER_BATCH else self.ledger()
        return states.where(F.col("stored") & (F.col("status") != MERGED)).select(*self.row_keys(), "log_ym", "path")

    def row_keys(self) -> list[str]:
        """What tells one write of a log from another."""
        return ["log_hash", "batch_id"] if self.layout == PER_BATCH else ["log_hash"]

    def active_logs(self) -> DataFrame:
        """Logs that are merged now."""
        return self.attempts().where(F.col("status") == MERGED)

    def is_empty(self) -> bool:
        """Whether nothing was ever merged here."""
        return not files.exists(self.spark, f"{self.root}/ledger") and not self._bases()

    def dispositions(self) -> DataFrame:
        """Outcome of every file."""
        return self._read("dispositions", DISPOSITION_SCHEMA)

    def metrics(self) -> DataFrame:
        """Duration of every operation."""
        return self._read("metrics", METRICS_SCHEMA)

    def ingest_events(self) -> DataFrame:
        """Warnings met while reading and typing."""
        return self._read("ingest_events", EVENTS_SCHEMA)

    # Schemas ------------------------------------------------------------

    def schemas(self) -> dict[str, list[TableSchema]]:
        """All generations of all tables, oldest first.

        This is catalog metadata: one row per column, not per log.
        """
        return self.all_schemas()[0]

    def all_schemas(self) -> tuple[dict[str, list[TableSchema]], dict[str, dict[int, dict[str, str]]]]:
        """Generations of published attempts, oldest first; and types of columns by name in small letters per generation, published or not.

        An attempt is published once a log of it was merged: what a merge that broke off has added does not count.
        """
        published = self._ledger().where(F.col("published")).select(F.col("batch_id").alias("attempt")).distinct()
        rows = self._read("schemas", SCHEMAS_SCHEMA).join(published.withColumn("counts", F.lit(True)), "attempt", "left")
        counts = F.col("attempt").isNull() | F.col("counts").isNotNull()
        found: dict[str, dict[int, dict[str, str]]] = {}
        every: dict[str, dict[int, dict[str, str]]] = {}
        for row in rows.withColumn("counts", counts).orderBy("table_name", "gen", "ordinal").collect():
            every.setdefault(row.table_name, {}).setdefault(row.gen, {}).setdefault(row.column.lower(), row.type)
            if row.counts:
                found.setdefault(row.table_name, {}).setdefault(row.gen, {})[row.column] = row.type
        generations = {t: [TableSchema(gen, columns) for gen, columns in sorted(gens.items())] for t, gens in found.items()}
        return generations, every

    def evolve(
        self,
        incoming: dict[str, dict[str, str]],
        attempt: str,
        stored: dict[str, list[TableSchema]],
        every: dict[str, dict[int, dict[str, str]]],
    ) -> tuple[dict[str, TableSchema], DataFrame | None]:
        """Schemas grown from :meth:`all_schemas` so that ``incoming`` tables fit, and the catalog rows to add (M3).

        The rows go to :meth:`append` before the first log that needs them is
        published, and count from then on. Files of one generation never have
        two types of a column, not even those of attempts that broke off.
        """
        rows, result = [], {}
        for table, columns in incoming.items():
            gens = every.get(table, {})
            current = stored[table][-1] if table in stored else TableSchema(0, {})
            target = {c: widen(t, columns.get(c, t)) for c, t in current.columns.items()}
            target.update({c: t for c, t in columns.items() if c not in target})
            on_disk = gens.get(current.gen, {})
            clash = any(on_disk.get(c.lower(), t) != t for c, t in target.items())
            gen = max(gens) + 1 if clash else current.gen
            known = {} if clash else current.columns
            rows += [(table, gen, i, c, t, attempt) for i, (c, t) in enumerate(target.items()) if c not in known]
            result[table] = TableSchema(gen, target)
        return result, self.spark.createDataFrame(rows, SCHEMAS_SCHEMA).coalesce(1) if rows else None

    # Tables -------------------------------------------------------------

    def table_names(self) -> list[str]:
        """Tables of this store."""
        return sorted(self.schemas())

    def partition_columns(self) -> list[str]:
        """Folder levels of a table."""
        return [self.month, self.layout]

    def generation_path(self, table: str, gen: int) -> str:
        """Folder of one generation."""
        return f"{self.root}/tables/{table}/gen={gen}"

    def read_generation(self, table: str, schema: TableSchema, paths: list[str] | None = None) -> DataFrame:
        """Rows of one generation, or of some of its folders, finished logs or not."""
        path = self.generation_path(table, schema.gen)
        fields = [f"{quoted(c)} {t}" for c, t in schema.columns.items() if c != "log_hash"]
        keys = {"log_hash": "bigint", self.month: "string", self.layout: "bigint" if self.layout == PER_LOG else "string"}
        full = T._parse_datatype_string(", ".join([*fields, *[f"{c} {t}" for c, t in keys.items()]]))
        if paths is None and files.exists(self.spark, path):
            return self.spark.read.schema(full).parquet(path)
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", path).parquet(*paths)

    def _folders(self, table: str, gen: int, logs: list) -> list[str]:
        """Folders of a generation that hold rows of ``logs(log_ym, log_hash, batch_id)``: named, and not found by listing."""
        root = self.generation_path(table, gen)
        months = self._months(root) if self.month == BY_ROW_MONTH else None
        named = {f"{root}/{m}/{self.layout}={row[self.layout]}" for row in logs for m in months or [f"log_ym={row.log_ym}"]}
        return files.existing(self.spark, sorted(named))

    def table(self, name: str, *log_hashes: int) -> DataFrame:
        """Rows of one table from merged logs, over all schema generations.

        Naming logs prunes to the folders they are in (F11).
        """
        generations = self.schemas().get(name)
        if not generations:
            raise ValueError(f"no such table: {name}")
        final = {c: t for c, t in generations[-1].columns.items() if c != "log_hash"}
        keys = [self.month, *self.row_keys()]
        parts = {g.gen: None for g in generations}
        if log_hashes:
            found = self.active_logs().where(F.col("log_hash").isin(*log_hashes)).select("log_hash", "log_ym", "batch_id").distinct().collect()
            parts = {g.gen: self._folders(name, g.gen, found) for g in generations}
        rows = reduce(DataFrame.unionByName, [_as(self.read_generation(name, g, parts[g.gen]), final, keys) for g in generations])
        if log_hashes:
            rows = rows.where(F.col("log_hash").isin(*log_hashes))
        hidden = self.hidden().select(*self.row_keys())
        if not hidden.isEmpty():
            rows = lookup_join(rows, hidden, self.row_keys(), "left_anti")
        return rows.drop("batch_id")

    def write_rows(self, rows: DataFrame, table: str, gen: int, chunk: str | None = None) -> None:
        """Write rows of one merge attempt.

        In the batch layout nothing is shuffled: rows come from staging file by
        file and are only sorted inside each task, so that a filter on log or
        time skips row groups. In the log layout rows are spread by log and
        ``chunk``, which numbers bounded runs of rows, so a log that holds much
        of the data is many tasks.
        """
        if self.layout == PER_LOG:
            rows = rows.repartition(*self.partition_columns(), *([chunk] if chunk else [])).drop("batch_id")
        order = [*self.partition_columns(), "log_hash", *(["time"] if "time" in rows.columns else [])]
        (
            (rows.drop(chunk) if chunk else rows)
            .sortWithinPartitions(*dict.fromkeys(order))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition_columns())
            .parquet(self.generation_path(table, gen))
        )

    # Removal ------------------------------------------------------------

    def _roots(self) -> list[tuple[str, TableSchema, str]]:
        every = [(t, g, self.generation_path(t, g.gen)) for t, gens in self.schemas().items() for g in gens]
        return [entry for entry in every if files.exists(self.spark, entry[2])]

    def _months(self, root: str) -> list[str]:
        return [c for c in files.children(self.spark, root) if c.startswith(f"{self.month}=")]

    def remove_log_folders(self, logs: DataFrame) -> int:
        """Delete the folders of ``logs(log_hash, log_ym)`` in every table, in the log layout (M5–M7).

        Folder names hold month and log, so this never reads rows. The list of
        logs comes to the driver one partition at a time.
        """
        roots = [root for _, _, root in self._roots()]
        months = {root: self._months(root) for root in roots} if self.month == BY_ROW_MONTH else {}
        removed, waiting = 0, []
        for log in logs.select("log_hash", "log_ym").toLocalIterator():
            for root in roots:
                for month in months.get(root, [f"log_ym={log.log_ym}"]):
                    waiting.append(f"{root}/{month}/log_hash={log.log_hash}")
            if len(waiting) >= 10_000:
                removed += files.delete_all(self.spark, waiting)
                waiting = []
        return removed + files.delete_all(self.spark, waiting)

    def forget(self, logs: DataFrame) -> None:
        """Take merged ``logs(log_hash, log_ym, path, attempt)`` out of every table (M5)."""
        self.record((logs, UNMERGED, True, None))
        if self.layout == PER_LOG:
            self.remove_log_folders(logs)
            self.record((logs, UNMERGED, False, None))

    def purge(self) -> int:
        """Give back the space of rows that are no longer read; the number of attempts cleaned.

        In the batch layout all attempts that have such rows are cleaned at
        once: each table is read once, and the rows of their merged logs are
        written under one new name. One ledger write then switches from the
        old names to the new one, and the old folders go. A crash at any point
        leaves either name readable, never both or none; a later purge removes
        what is left over.
        """
        if self.layout == PER_LOG:
            # The list is read again for the ledger write, which does not change it until it ends.
            gone = self.ledger().where(F.col("stored") & (F.col("status") != MERGED))
            self.remove_log_folders(gone)
            self.record((gone.withColumnRenamed("batch_id", "attempt"), UNMERGED, False, None))
            self.compact_ledger()
            return 0
        scratch = f"{self.root}/staging/purge-{uuid.uuid4().hex}"
        affected = self.hidden().select("batch_id").distinct()
        # The ledger changes below: the state of now is written.
        self.attempts().join(affected, "batch_id", "left_semi").write.parquet(scratch)
        states = self.spark.read.parquet(scratch)
        # One row per attempt and month, not per log.
        named = states.select("log_ym", "batch_id", (F.col("status") == MERGED).alias("kept")).groupBy("log_ym", "batch_id").agg(F.max("kept").alias("kept")).collect()
        if named:
            self._rewrite(states.where(F.col("status") == MERGED), [row for row in named if row.kept])
            old = [path for _, schema, root in self._roots() for path in self._folders_at(root, named)]
            files.delete_all(self.spark, old)
            self.record((states.withColumnRenamed("batch_id", "attempt"), UNMERGED, False, None))
        files.delete(self.spark, scratch)
        self.compact_ledger()
        return len({row.batch_id for row in named})

    def _folders_at(self, root: str, named: list) -> list[str]:
        months = self._months(root) if self.month == BY_ROW_MONTH else None
        return sorted({f"{root}/{m}/batch_id={row.batch_id}" for row in named for m in months or [f"log_ym={row.log_ym}"]})

    def _rewrite(self, kept: DataFrame, named: list) -> None:
        """Write the rows of merged logs of some attempts as one attempt, and switch to it."""
        if not named:
            return
        fresh = f"purge~{uuid.uuid4().hex}"
        self.record((kept, PENDING, True, fresh))
        logs = kept.select("log_hash", "batch_id")

        def rewrite(root: tuple[str, TableSchema, str]) -> None:
            table, schema, _ = root
            paths = self._folders(table, schema.gen, named)
            if paths:
                rows = lookup_join(self.read_generation(table, schema, paths), logs, ["log_hash", "batch_id"], "left_semi")
                self.write_rows(rows.withColumn("batch_id", F.lit(fresh)), table, schema.gen)

        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(rewrite, self._roots()))
        self.record((kept, MERGED, True, fresh), (kept.withColumnRenamed("batch_id", "attempt"), UNMERGED, True, None))

    # Sizes --------------------------------------------------------------

    def log_sizes(self) -> DataFrame:
        """Stored bytes per log.

        In the log layout sizes come from file listings alone. In the batch
        layout a file's size is shared out by rows, from its log column alone.
        """
        if self.layout == PER_LOG:
            listed = (
                self.spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet")
                .load(f"{self.root}/tables")
            )
            log_hash = F.regexp_extract("path", r"/log_hash=(-?\d+)/", 1).cast("bigint")
            return total_size(listed.select(log_hash.alias("log_hash"), "length"), F.col("length"))
        parts = [
            self.read_generation(table, schema)
            .select("log_hash", "batch_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
            .groupBy("log_hash", "batch_id", "file", "size")
            .agg(F.count(F.lit(1)).alias("n"))
            for table, schema, _ in self._roots()
        ]
        if not parts:
            return self.spark.createDataFrame([], "log_hash bigint, size_bytes bigint")
        counts = reduce(DataFrame.unionByName, parts)
        totals = counts.groupBy("file").agg(F.sum("n").alias("total"))
        shared = counts.join(totals, "file").withColumn("share", F.col("size") * F.col("n") / F.col("total"))
        kept = shared.join(self.active_logs().select("log_hash", "batch_id"), ["log_hash", "batch_id"], "left_semi")
        return total_size(kept, F.col("share")).withColumn("size_bytes", F.round("size_bytes").cast("bigint"))

    def register(self) -> None:
        """Make every table a temporary view named ``<namespace>_<table>`` for SQL use."""
        for name in self.table_names():
            self.table(name).createOrReplaceTempView(f"{self.namespace}_{name}")


def _as(df: DataFrame, columns: dict[str, str], keys: list[str]) -> DataFrame:
    have = dict(df.dtypes)
    values = [
        (F.col(quoted(c)).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in columns.items()
    ]
    return df.select(*keys, *values)
