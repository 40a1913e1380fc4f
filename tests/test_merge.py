"""Merge, unmerge and evolution on real log files."""

import datetime as dt

import pytest
import sample_logs as sl
from pyspark.sql import functions as F

from logtrail.operators import aggregates
from logtrail.operators.filters import TableFilter
from logtrail.plans import merge as merging
from logtrail.plans import store as stores
from logtrail.plans import views
from logtrail.plans.merge import MergeFailed, MergeOptions, merge, plan_merge, unmerge
from logtrail.plans.store import LogStore
from logtrail.sources import log_files
from logtrail.sources.log_files import read_log_files, schema_statements

H1, H2, H3 = sl.log_hash(71732800), sl.log_hash(5), sl.log_hash(9)


def statuses(report):
    return {r.path.rsplit("/", 1)[-1]: r.status for r in report.collect()}


def by_hash(report):
    return {r.log_hash: r.status for r in report.collect()}


def hashes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "log_hash bigint")


def small(hash_value, **logs):
    full = sl.plain_log(hash_value, **logs)
    return {t: full[t] for t in ("logs", "signalling", "android_info_1sec")}


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    """One merge of good, repeated and bad files, for the tests that only read."""
    folder = tmp_path_factory.mktemp("merged")
    inbox = folder / "in"
    sl.write_log(inbox, "a.azm", sl.plain_log(H1))
    sl.write_log(inbox / "nested" / "deep", "b.azm", sl.plain_log(H1))
    sl.write_log(inbox, "c.azm", sl.plain_log(H2, end="", version="v3.0.741"))
    sl.write_log(inbox, "ignored.zip", sl.plain_log(H3))
    (inbox / "not_a_zip.azm").write_bytes(b"nope")
    (inbox / "no_member.azm").write_bytes(sl.archive(b"", "other.db"))
    sl.write_log(inbox, "zero.azm", small(0))
    sl.write_log(inbox, "no_logs.azm", {"logs": (sl.logs_table(1)[0], []), "signalling": (sl.SIGNALLING, [])})
    no_end = small(sl.log_hash(11), end="")
    no_end["android_info_1sec"] = (no_end["android_info_1sec"][0], [])
    sl.write_log(inbox, "no_end.azm", no_end)
    image = bytearray(sl.database({"logs": sl.logs_table(sl.log_hash(12)), "big": ('"time" DATETIME,"x" TEXT', [(sl.START, "y" * 500)] * 4000)}))
    image[len(image) // 2 : len(image) // 2 + 8192] = b"\xff" * 8192
    (inbox / "torn.azm").write_bytes(sl.archive(bytes(image)))
    store = LogStore(spark, str(folder / "store"), "all_logs")
    report = merge(store, read_log_files(spark, str(inbox)), MergeOptions(add_imei=True))
    return store, report


def test_outcome_per_file(merged):
    _, report = merged
    assert statuses(report) == {
        "a.azm": "merged",
        "b.azm": "already_merged",
        "c.azm": "merged",
        "not_a_zip.azm": "unreadable",
        "no_member.azm": "unreadable",
        "zero.azm": "invalid_identity",
        "no_logs.azm": "invalid_identity",
        "no_end.azm": "no_end_time",
        "torn.azm": "merged",
    }
    summary = {r.status: r.files for r in aggregates.run_summary(report).collect()}
    assert summary == {"merged": 3, "already_merged": 1, "unreadable": 2, "invalid_identity": 2, "no_end_time": 1}


def test_tables_and_rows(merged):
    store, _ = merged
    assert set(store.table_names()) == {
        "logs", "signalling", "location", "log_info", "android_info_1sec", "kpi", "nr_cell_meas", "wifi_scanned", "big",
    }
    assert store.table("signalling", H1).count() == 5
    # Old app versions keep no rows of the gated table.
    assert {r.log_hash for r in store.table("wifi_scanned").collect()} == {H1}


def test_tables_are_open_to_sql(spark, merged):
    store, _ = merged
    store.register()
    assert spark.sql(f"select count(*) as n from all_logs_signalling where log_hash = {H1}").first().n == 5


def test_clamp_keeps_both_bounds(merged):
    store, _ = merged
    infos = {r.info for r in store.table("signalling", H1).collect()}
    assert {"first kept", "last kept"} <= infos and not infos & {"too early", "too late", "no time"}


def test_cells(merged):
    store, _ = merged
    rows = {r.time: r for r in store.table("kpi", H1).collect()}
    first = rows[dt.datetime(2018, 3, 10, 7, 1)]
    assert (first.lte_rsrp, first.lte_earfcn, first.modem_time) == (-80.5, 1800, None)
    assert (first.gsm_bsic, first.gsm_band, first.android_cellid_from_cellfile) == ("12345", "GSM900", 12)
    assert (first.x_duration, first.x_trip_time, first.note) == (None, 4.5, "a")
    second = rows[dt.datetime(2018, 3, 10, 7, 2)]
    assert second.modem_time == dt.datetime(2018, 3, 10, 7, 2, 0, 123000)
    assert (second.android_cellid_from_cellfile, second.x_duration, second.lte_rsrp) == (0, 1.5, None)
    assert rows[dt.datetime(2018, 3, 10, 7, 3)].note is None
    cells = [(r.pci, r.rsrp) for r in store.table("nr_cell_meas", H1).orderBy("time").collect()]
    assert cells == [(12, -1.5), (None, None)]


def test_messages_keep_lines_and_get_direction(merged):
    store, _ = merged
    rows = views.l3_messages(store.table("signalling", H1)).orderBy("time").collect()
    assert [r.direction for r in rows] == [1, 1, 0, 0, 1]
    assert rows[1].info == 'line one,\n"two"\nNaTional'
    assert rows[2].info is None and rows[3].info == "NaT"
    assert "time_ms" not in store.table("signalling").columns


def test_geometry_and_position_join(merged):
    store, _ = merged
    example = store.table("signalling", H1).where("seqid = 1").first()
    assert round(example.lon, 3) == 100.663 and round(example.lat, 3) == 13.777
    assert bytes(example.geom).hex().upper().startswith("0101000020E6100000DD30C0F46C2A5940")
    kept_raw = store.table("signalling", H1).where("seqid = 4").first()
    assert bytes(kept_raw.geom) == b"\x00\x01junk" and kept_raw.lat is None
    placed = views.kpi_with_position(store.table("kpi", H1), "lte_rsrp", store.table("location"))
    assert {(r.kpi, r.lat, r.lon) for r in placed.collect()} == {(-80.5, 13.75, 100.5), (-90.25, None, None)}


def test_imei_on_all_rows(merged):
    store, _ = merged
    assert {r.imei_id for r in store.table("kpi", H1).collect()} == {"222"}


def test_events_inventory_sizes_and_timings(merged):
    store, _ = merged
    events = {(r.event, r.table) for r in store.ingest_events().collect()}
    assert ("no_time_column", "no_time") in events
    assert ("partial_read", "big") in events
    assert 0 < store.table("big").count() < 4000
    assert {r.log_hash for r in views.inventory_of(store).collect()} == {H1, H2, sl.log_hash(12)}
    sizes = {r.log_hash: r.size_bytes for r in views.log_sizes(store).collect()}
    assert sizes[H1] > 0
    assert views.slowest_operations(store).first().duration > 0
    row = store.table("logs", H2).first()
    assert row.log_ym == "2018_03" and row.log_end_time is None


def test_schema_fingerprints(spark, tmp_path):
    sl.write_log(tmp_path, "a.azm", small(H1))
    sl.write_log(tmp_path, "b.azm", small(H2))
    sl.write_log(tmp_path, "c.azm", sl.plain_log(H3))
    prints = aggregates.schema_fingerprints(schema_statements(read_log_files(spark, str(tmp_path))), "path")
    assert sorted(r.logs for r in aggregates.schema_drift(prints).collect()) == [1, 2]


@pytest.mark.parametrize("layout", [stores.PER_BATCH, stores.PER_LOG])
def test_life_cycle(spark, tmp_path, layout):
    path = sl.write_log(tmp_path / "in", "a.azm", small(H1))
    sl.write_log(tmp_path / "in", "b.azm", small(H2))
    one, both = read_log_files(spark, path), read_log_files(spark, str(tmp_path / "in"))
    store = LogStore(spark, str(tmp_path / "store"), "all_logs", layout)
    assert set(by_hash(unmerge(store, one)).values()) == {"empty_target"}
    outcomes, counts = plan_merge(store, both)
    assert set(by_hash(outcomes).values()) == {"merged"}
    # What the merge below writes: rows outside the log's time range are not counted.
    assert counts.where("table = 'signalling'").agg(F.sum("rows")).first()[0] == 10
    assert store.is_empty() and store.table_names() == []
    assert by_hash(merge(store, both)) == {H1: "merged", H2: "merged"}
    assert LogStore(spark, str(tmp_path / "store"), layout=layout).table_names() == []
    assert store.table("logs").count() == 2
    assert by_hash(merge(store, one)) == {H1: "already_merged"}
    assert by_hash(unmerge(store, hashes(spark, H1, 404))) == {H1: "unmerged", 404: "not_present"}
    for table in store.table_names():
        assert {r.log_hash for r in store.table(table).select("log_hash").distinct().collect()} == {H2}
    assert {r.log_hash: r.size_bytes is None for r in views.log_sizes(store).collect()} == {H1: True, H2: False}
    store.purge()
    assert store.hidden().isEmpty() and store.table("signalling").count() == 5
    assert by_hash(merge(store, one)) == {H1: "merged"}
    assert store.table("logs").count() == 2 and store.table("signalling").count() == 10
    assert store.table("signalling", H2).count() == 5


def test_evolution_over_three_logs(spark, tmp_path):
    def log(h, columns, row):
        return {"logs": sl.logs_table(h), "kpi": (f'"time" DATETIME,{columns}', [("2018-03-10 07:01:00", *row)])}

    store = LogStore(spark, str(tmp_path / "store"))
    logs = [
        log(H1, '"a" INT,"b" TEXT', (1, "x")),
        log(H2, '"a" INT,"c" Double,"b" TEXT', (2, 2.5, "y")),
        log(H3, '"a" TEXT', ("007",)),
    ]
    for i, tables in enumerate(logs):
        path = sl.write_log(tmp_path / "in", f"{i}.azm", tables)
        merge(store, read_log_files(spark, path))
    rows = {r.log_hash: (r.a, r.b, r.c) for r in store.table("kpi").collect()}
    assert rows == {H1: ("1", "x", None), H2: ("2", "y", 2.5), H3: ("007", None, None)}
    assert [g.gen for g in store.schemas()["kpi"]] == [0, 1]


def test_bad_cells_fail_the_log_unless_tolerated(spark, tmp_path):
    bad = {"logs": sl.logs_table(H1), "kpi": ('"time" DATETIME,"v" Double', [(sl.START, 1.0), (sl.START, "oops")])}
    fine = {"logs": sl.logs_table(H2), "nr_handover_stats": ('"time" DATETIME,"v" Double', [(sl.START, "oops")])}
    sl.write_log(tmp_path / "in", "bad.azm", bad)
    sl.write_log(tmp_path / "in", "fine.azm", fine)
    store = LogStore(spark, str(tmp_path / "store"))
    report = merge(store, read_log_files(spark, str(tmp_path / "in")))
    assert statuses(report) == {"bad.azm": "failed", "fine.azm": "merged"}
    # A table that only failed logs have is not made.
    assert set(store.table_names()) == {"logs", "nr_handover_stats"} and store.table("nr_handover_stats").first().v is None
    assert {(r.event, r.table) for r in store.ingest_events().collect()} == {("bad_cells", "kpi"), ("bad_cells", "nr_handover_stats")}


def test_crash_before_publish_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    path = sl.write_log(tmp_path / "in", "a.azm", small(H1))
    store = LogStore(spark, str(tmp_path / "store"))
    real = LogStore.record

    def crash(self, *changes):
        if changes[0][1] == stores.MERGED:
            raise RuntimeError("gone")
        real(self, *changes)

    monkeypatch.setattr(LogStore, "record", crash)
    with pytest.raises(RuntimeError, match="gone"):
        merge(store, read_log_files(spark, path))
    monkeypatch.undo()
    assert store.table_names() == []
    assert by_hash(merge(store, read_log_files(spark, path))) == {H1: "merged"}
    assert store.table("signalling").count() == 5
    store.purge()
    assert store.hidden().isEmpty() and store.table("signalling").count() == 5


def test_options(spark, tmp_path):
    inbox = tmp_path / "in"
    sl.write_log(inbox, "a.azm", sl.plain_log(H1))
    sl.write_log(inbox, "b.azm", small(0))
    sl.write_log(inbox, "c.azm", sl.plain_log(H3))

    def shout(rows, table):
        return rows.withColumn("info", F.upper("info")) if table == "signalling" else rows

    options = MergeOptions(
        tables=TableFilter(only=("signalling", "location", "no_time", "empty")),
        location_geometry_only=True,
        keep_tables_without_time=True,
        preprocess=shout,
        fail_fast=True,
        move_imported_to=str(tmp_path / "done"),
        move_failed_to=str(tmp_path / "failed"),
        input_root=str(inbox),
    )
    store = LogStore(spark, str(tmp_path / "store"), month=stores.BY_ROW_MONTH)
    with pytest.raises(MergeFailed, match="b.azm"):
        merge(store, read_log_files(spark, str(inbox)), options)
    assert statuses(store.dispositions()) == {"a.azm": "merged", "b.azm": "invalid_identity", "c.azm": "not_attempted"}
    assert set(store.table_names()) == {"logs", "signalling", "location", "no_time"}
    assert "geom" not in store.table("signalling").columns and "geom" in store.table("location").columns
    assert "FIRST KEPT" in {r.info for r in store.table("signalling").collect()}
    assert store.table("no_time").first().a == 1
    assert [p.name for p in (tmp_path / "done").glob("*.azm")] == ["a.azm"]
    assert [p.name for p in (tmp_path / "failed").glob("*.azm")] == ["b.azm"]
    assert [p.name for p in inbox.glob("*.azm")] == ["c.azm"]


def test_mounted_files_have_no_size_limit_and_others_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log_files, "VALUE_LIMIT", 10)
    sl.write_log(tmp_path / "in", "a.azm", small(H1))
    outcomes, _ = plan_merge(LogStore(spark, str(tmp_path / "store")), read_log_files(spark, str(tmp_path / "in")))
    assert [r.status for r in outcomes.collect()] == ["merged"]
    far = spark.createDataFrame([("far://store/a.azm", None)], "path string, content binary")
    outcomes, _ = plan_merge(LogStore(spark, str(tmp_path / "store")), far)
    assert [(r.status, "larger than" in r.reason) for r in outcomes.collect()] == [("unreadable", True)]


BAD = ('"time" DATETIME,"v" INT', [("2018-03-10 07:01:00.000", "no number")])


def test_a_good_copy_follows_a_failed_one(spark, tmp_path):
    inbox = tmp_path / "in"
    sl.write_log(inbox, "a.azm", small(H1) | {"kpi2": BAD})
    sl.write_log(inbox, "b.azm", small(H1) | {"kpi2": BAD})
    sl.write_log(inbox, "c.azm", small(H1))
    sl.write_log(inbox, "d.azm", small(H1))
    store = LogStore(spark, str(tmp_path / "store"))
    report = merge(store, read_log_files(spark, str(inbox)))
    assert statuses(report) == {"a.azm": "failed", "b.azm": "failed", "c.azm": "merged", "d.azm": "already_merged"}
    assert [r.log_hash for r in store.active_logs().collect()] == [H1]


def test_many_bad_copies_cost_one_scan_and_change_no_schema(spark, tmp_path):
    inbox = tmp_path / "in"
    bad = sl.logs_table(H1), ('"time" DATETIME,"n" Double,"z" INT', [("2018-03-10 07:01:00.000", "oops", 1)])
    good = sl.logs_table(H1), ('"time" DATETIME,"n" INT', [("2018-03-10 07:01:00.000", 7)])
    for i in range(12):
        sl.write_log(inbox, f"{i:02d}.azm", dict(zip(("logs", "kpi"), bad, strict=True)))
    sl.write_log(inbox, "50.azm", dict(zip(("logs", "kpi"), good, strict=True)))
    sl.write_log(inbox, "60.azm", dict(zip(("logs", "kpi"), bad, strict=True)))
    sl.write_log(inbox, "other.azm", {"logs": sl.logs_table(H2), "kpi": bad[1]})
    store = LogStore(spark, str(tmp_path / "store"))
    preview, counts = plan_merge(store, read_log_files(spark, str(inbox)))
    want = {f"{i:02d}.azm": "failed" for i in range(12)} | {"50.azm": "merged", "60.azm": "already_merged", "other.azm": "failed"}
    assert statuses(preview) == want and {(r.table, r["rows"]) for r in counts.collect()} == {("logs", 1), ("kpi", 1)}
    report = merge(store, read_log_files(spark, str(inbox)))
    assert statuses(report) == want
    assert {r.reason for r in report.where("status = 'failed'").collect()} == {"bad cells in kpi"}
    # Each table was written once, and nothing of the failed files is in the schema.
    written = store.metrics().where("operation = 'write'").groupBy("table").count().collect()
    assert {(r.table, r["count"]) for r in written} == {("logs", 1), ("kpi", 1)}
    assert store.schemas()["kpi"][-1].columns == {"log_hash": "bigint", "time": "timestamp_ntz", "n": "bigint"}
    assert len(store.schemas()["kpi"]) == 1 and [r.n for r in store.table("kpi").collect()] == [7]
    events = store.ingest_events().where("event = 'bad_cells'").collect()
    assert {r.path.rsplit("/", 1)[-1] for r in events} == {*[f"{i:02d}.azm" for i in range(12)], "other.azm"}


def test_a_merge_that_broke_off_changes_no_schema(spark, tmp_path, monkeypatch):
    def log(h, columns, row):
        return {"logs": sl.logs_table(h), "kpi": (f'"time" DATETIME,{columns}', [("2018-03-10 07:01:00", *row)])}

    store = LogStore(spark, str(tmp_path / "store"))
    merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", "0.azm", log(H1, '"a" INT', (1,)))))
    real = LogStore.record

    def crash(self, *changes):
        if changes[0][1] == stores.MERGED:
            raise RuntimeError("gone")
        real(self, *changes)

    monkeypatch.setattr(LogStore, "record", crash)
    broken = sl.write_log(tmp_path / "in", "1.azm", log(H2, '"a" TEXT,"z" TEXT', ("x", "y")))
    with pytest.raises(RuntimeError, match="gone"):
        merge(store, read_log_files(spark, broken))
    with pytest.raises(RuntimeError, match="gone"):
        merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", "2.azm", log(H3, '"a" INT,"w" TEXT', (2, "y")))))
    monkeypatch.undo()
    assert store.schemas()["kpi"][-1].columns == {"log_hash": "bigint", "time": "timestamp_ntz", "a": "bigint"}
    # The same names with other types, beside files that were left on disk.
    merge(store, read_log_files(spark, sl.write_log(tmp_path / "in", "3.azm", log(H2, '"a" INT,"w" Double', (5, 2.5)))))
    assert {(r.a, r.w) for r in store.table("kpi").collect()} == {(1, None), (5, 2.5)}
    store.purge()
    assert {(r.a, r.w) for r in store.table("kpi").collect()} == {(1, None), (5, 2.5)}


def test_any_column_name_and_storage_class(spark, tmp_path):
    columns = '"Time" DATETIME,"_path" TEXT,"n" INT,"_had_n" INT,"a`b" TEXT,"a.b c" REAL,"_own" TEXT,"value_0" TEXT,"_chunk" INT,"b" BLOB,"t" TEXT'
    rows = [
        ("2018-03-10 07:01:00.000", "p", 1, 2, "q", 0.5, "o", "v", 9, "C0FFEE", b"\xff\x00raw"),
        ("2018-03-10 07:02:00.000", None, None, None, None, None, None, None, None, b"\x00\x01", "é"),
        ("2018-03-10 07:03:00.000", None, None, None, None, None, None, None, None, b"", b"plain"),
    ]
    sl.write_log(tmp_path / "in", "a.azm", small(H1) | {"odd": (columns, rows)})
    # Another file spells and orders the columns in its own way.
    sl.write_log(tmp_path / "in", "b.azm", small(H2) | {"odd": ('"T" TEXT,"N" INT,"time" DATETIME', [("other", 5, "2018-03-10 07:04:00.000")])})
    store = LogStore(spark, str(tmp_path / "store"), month=stores.BY_ROW_MONTH)
    assert statuses(merge(store, read_log_files(spark, str(tmp_path / "in")))) == {"a.azm": "merged", "b.azm": "merged"}
    table = store.table("odd")
    assert len(table.columns) == len({c.lower() for c in table.columns})
    named = {c.lower(): F.col(f"`{c.replace('`', '``')}`") for c in table.columns}
    names = ("_path", "n", "_had_n", "a`b", "a.b c", "_own", "value_0", "_chunk")
    parts = [*[named[c].alias(f"c{i}") for i, c in enumerate(names)], named["b"].alias("b"), named["t"].cast("binary").alias("t"), "time"]
    got = {r.time.minute: r for r in table.select(*parts).collect()}
    assert tuple(got[1])[:8] == ("p", 1, 2, "q", 0.5, "o", "v", 9)
    assert [got[i].b and bytes(got[i].b) for i in (1, 2, 3, 4)] == [b"C0FFEE", b"\x00\x01", None, None]
    assert [bytes(got[i].t) for i in (1, 2, 3, 4)] == [b"\xff\x00raw", "é".encode(), b"plain", b"other"] and got[4].c1 == 5
    events = [r.detail for r in store.ingest_events().where("event = 'storage_class'").collect()]
    assert events == ["1 texts in b, 2 blobs in t"] or events == ["2 blobs in t, 1 texts in b"]
    one = store.active_logs().where(F.col("log_hash") == H2).select("log_hash")
    unmerge(store, one)
    store.purge()
    assert store.table("odd").count() == 3 and "_chunk" in store.table("odd").columns


def test_rows_are_fetched_while_there_is_room(monkeypatch):
    import sqlite3

    monkeypatch.setattr(log_files, "BATCH_BYTES", 1000)
    db = sqlite3.connect(":memory:")
    db.execute("create table t (x)")
    db.executemany("insert into t values (?)", [("y" * n,) for n in (10, 10, 5000, 10, 990, 10)])
    sizes = [[len(r[0]) for r in batch] for batch in log_files._row_batches(db, "select x from t")]
    assert sizes == [[10, 10, 5000], [10, 990], [10]]


def test_fail_fast_stops_at_bad_cells(spark, tmp_path):
    inbox = tmp_path / "in"
    sl.write_log(inbox, "a.azm", small(H1))
    sl.write_log(inbox, "b.azm", small(H2) | {"kpi2": BAD})
    sl.write_log(inbox, "c.azm", small(H3))
    store = LogStore(spark, str(tmp_path / "store"))
    with pytest.raises(MergeFailed, match="b.azm"):
        merge(store, read_log_files(spark, str(inbox)), MergeOptions(fail_fast=True))
    assert statuses(store.dispositions()) == {"a.azm": "merged", "b.azm": "failed", "c.azm": "not_attempted"}
    assert [r.log_hash for r in store.active_logs().collect()] == [H1]


def test_odd_schemas_fail_their_file_alone(spark, tmp_path):
    inbox = tmp_path / "in"
    sl.write_log(inbox, "a.azm", small(H1))
    sl.write_log(inbox, "b.azm", small(H2) | {"signalling": ('"time" DATETIME,"info" TEXT', [])})
    sl.write_log(inbox, "c.azm", small(H3) | {"x": ('"time" DATETIME,"log_ym" TEXT', [])})
    report = merge(LogStore(spark, str(tmp_path / "store")), read_log_files(spark, str(inbox)))
    assert statuses(report) == {"a.azm": "merged", "b.azm": "unreadable", "c.azm": "unreadable"}


def test_large_cells_come_back_whole_and_all_log_rows_stay(spark, tmp_path):
    text, blob = "é" * 15_000_000, b"\x01\xff" * 7_500_000
    tables = {
        "logs": (sl.logs_table(H1)[0], sl.logs_table(H1)[1] + sl.logs_table(H1, version="v3.0.900")[1]),
        "big_cells": ('"time" DATETIME,"t" TEXT,"b" BLOB', [("2018-03-10 07:01:00.000", text, blob), ("2018-03-10 07:02:00.000", "x", None)]),
    }
    sl.write_log(tmp_path / "in", "a.azm", tables)
    store = LogStore(spark, str(tmp_path / "store"))
    assert statuses(merge(store, read_log_files(spark, str(tmp_path / "in")))) == {"a.azm": "merged"}
    rows = {r.n: r for r in store.table("big_cells").select(F.length("t").alias("n"), F.octet_length("b").alias("size"), F.sha2("b", 256).alias("sha")).collect()}
    assert set(rows) == {15_000_000, 1} and rows[15_000_000].size == len(blob)
    assert store.table("logs").count() == 2


def test_moved_inputs_keep_their_place_and_replace_nothing(spark, tmp_path):
    inbox, done = tmp_path / "in", tmp_path / "done"
    for turn in (1, 2):
        sl.write_log(inbox / "x", "a.azm", small(sl.log_hash(100 + turn)))
        sl.write_log(inbox / "y", "a.azm", small(sl.log_hash(200 + turn)))
        options = MergeOptions(move_imported_to=str(done), input_root=str(inbox))
        merge(LogStore(spark, str(tmp_path / "store")), read_log_files(spark, str(inbox)), options)
    moved = sorted(str(p.relative_to(done)) for p in done.rglob("*.azm*") if not p.name.startswith("."))
    assert moved == ["x/a.azm", "x/a.azm.2", "y/a.azm", "y/a.azm.2"]
    assert not list(inbox.rglob("*.azm"))


def test_a_hook_adds_columns_and_times(spark, tmp_path):
    def hook(df, table):
        if table == "no_time":
            return df.withColumn("time", F.lit("2018-03-10 07:05:00.000")).withColumn("twice", F.col("a").cast("double") * 2)
        return df

    sl.write_log(tmp_path / "in", "a.azm", small(H1) | {"no_time": ('"a" INT', [(4,)])})
    store = LogStore(spark, str(tmp_path / "store"))
    merge(store, read_log_files(spark, str(tmp_path / "in")), MergeOptions(preprocess=hook))
    row = store.table("no_time").first()
    assert (row.a, row.twice) == (4, 8.0) and str(row.time) == "2018-03-10 07:05:00"


def test_decision_matrix(spark):
    cases = spark.createDataFrame([(p, e) for p in (True, False) for e in (True, False)], "present boolean, target boolean")
    rows = cases.select(
        "*",
        merging.outcome(F.col("present"), F.col("target"), False).alias("merge"),
        merging.outcome(F.col("present"), F.col("target"), True).alias("unmerge"),
    ).collect()
    assert {(r.present, r.target): (r["merge"], r.unmerge) for r in rows} == {
        (True, True): ("already_merged", "unmerged"),
        (True, False): ("merged", "empty_target"),
        (False, True): ("merged", "not_present"),
        (False, False): ("merged", "empty_target"),
    }
