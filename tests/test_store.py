"""The store at many batches: named folders, the ledger's bases, and purging all attempts at once."""

import sample_logs as sl
from pyspark.sql import functions as F

from logtrail import files
from logtrail.plans import store as stores
from logtrail.plans.merge import merge, unmerge
from logtrail.plans.store import LogStore
from logtrail.sources.log_files import read_log_files

BATCHES = 3000


def log(h, value):
    return {"logs": sl.logs_table(h), "kpi": ('"time" DATETIME,"v" INT', [("2018-03-10 07:01:00", value)])}


def batches(spark, tmp_path, n, layout=stores.PER_BATCH, month=stores.BY_LOG_MONTH):
    """A store with some logs, each merged by itself."""
    store = LogStore(spark, str(tmp_path / "store"), layout=layout, month=month)
    for i in range(n):
        merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", f"{i}.azm", log(sl.log_hash(i + 1), i))))
    return store


def values(store, *logs):
    return sorted(r.v for r in store.table("kpi", *logs).collect())


def test_a_named_log_reads_its_folder_alone_among_thousands_of_batches(spark, tmp_path):
    store = batches(spark, tmp_path, 2)
    made = spark.range(BATCHES).select(
        (F.col("id") + 10**12).alias("log_hash"), F.lit("2018_03").alias("log_ym"), F.concat(F.lit("other-"), "id").alias("attempt"), F.lit("p").alias("path")
    )
    store.record((made, stores.MERGED, True, None))
    for i in range(BATCHES):
        (tmp_path / "store" / "public" / "tables" / "kpi" / "gen=0" / "log_ym=2018_03" / f"batch_id=other-{i}").mkdir(parents=True)
    named = store.table("kpi", sl.log_hash(2))
    plan = named._jdf.queryExecution().executedPlan().toString()
    # The plan knows one path, so one folder was listed.
    assert "InMemoryFileIndex(1 paths)" in plan
    assert values(store, sl.log_hash(2)) == [1] and values(store, 404) == []
    assert values(store, sl.log_hash(1), sl.log_hash(2), 10**12 + 5) == [0, 1]


def test_named_logs_in_other_layouts(spark, tmp_path):
    for i, (layout, month) in enumerate([(stores.PER_LOG, stores.BY_LOG_MONTH), (stores.PER_BATCH, stores.BY_ROW_MONTH)]):
        store = batches(spark, tmp_path / str(i), 2, layout, month)
        assert values(store, sl.log_hash(1)) == [0] and values(store) == [0, 1]
        assert len(store.table("kpi", sl.log_hash(1)).inputFiles()) == 1


def test_all_attempts_are_purged_in_one_rewrite(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path / "store"))
    for i in range(4):
        for j in range(2):
            sl.write_log(tmp_path / f"in{i}", f"{j}.azm", log(sl.log_hash(10 * i + j + 1), 10 * i + j))
        merge(store, read_log_files(spark, str(tmp_path / f"in{i}")))
    gone = spark.createDataFrame([(sl.log_hash(10 * i + 1),) for i in range(3)], "log_hash bigint")
    unmerge(store, gone)
    writes = []
    real = LogStore.write_rows
    monkeypatch.setattr(LogStore, "write_rows", lambda self, rows, table, gen, chunk=None: writes.append(table) or real(self, rows, table, gen, chunk))
    want = [1, 11, 21, 30, 31]
    assert values(store) == want
    assert store.purge() == 3
    # One write per table for three attempts; the fourth attempt was not touched.
    assert sorted(writes) == ["kpi", "logs"]
    assert values(store) == want and store.hidden().isEmpty()
    folders = files.children(spark, f"{store.generation_path('kpi', 0)}/log_ym=2018_03")
    assert len(folders) == 2 and sum("purge~" in name for name in folders) == 1
    assert store.purge() == 0 and sorted(writes) == ["kpi", "logs"]
    assert values(store, sl.log_hash(2), sl.log_hash(1)) == [1]


def test_a_purge_that_broke_off_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path / "store"))
    for i in range(3):
        sl.write_log(tmp_path / "in", f"{i}.azm", log(sl.log_hash(i + 1), i))
    merge(store, read_log_files(spark, str(tmp_path / "in")))
    unmerge(store, spark.createDataFrame([(sl.log_hash(1),)], "log_hash bigint"))
    real = LogStore.record
    for stop in range(3):
        done = []

        def crash(self, *changes, stop=stop, done=done):
            if len(done) == stop:
                raise RuntimeError("gone")
            done.append(1)
            real(self, *changes)

        monkeypatch.setattr(LogStore, "record", crash)
        try:
            store.purge()
        except RuntimeError:
            pass
        monkeypatch.setattr(LogStore, "record", real)
        assert values(store) == [1, 2]
    store.purge()
    assert values(store) == [1, 2] and store.hidden().isEmpty()


def test_ledger_bases_fold_to_the_same_state(spark, tmp_path):
    store = batches(spark, tmp_path, 3)
    unmerge(store, spark.createDataFrame([(sl.log_hash(1),)], "log_hash bigint"))
    columns = ["log_hash", "batch_id", "status", "stored", "published"]
    before, schemas = sorted(store.attempts().select(columns).collect()), store.schemas()
    held = store.active_logs()
    assert not store.compact_ledger()
    assert store.compact_ledger(at_least=1) and sorted(store.attempts().select(columns).collect()) == before
    # A frame from before the base still reads: its files go with the next one.
    assert held.count() == 2
    merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", "9.azm", log(sl.log_hash(9), 9))))
    assert store.compact_ledger(at_least=1)
    assert store.schemas() == schemas and values(store) == [1, 2, 9]
    assert len(store._bases()) == 2
    merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", "8.azm", log(sl.log_hash(8), 8))))
    assert store.compact_ledger(at_least=1) and len(store._bases()) == 2
    assert values(store) == [1, 2, 8, 9] and not store.is_empty()
