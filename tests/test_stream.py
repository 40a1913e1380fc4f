"""A followed folder gives what a batch merge gives."""

import pytest
import sample_logs as sl

from logtrail.plans.merge import merge
from logtrail.plans.store import LogStore
from logtrail.sources.log_files import read_log_files
from logtrail.streaming.follow import follow


def rows(store):
    tables = {t: sorted(map(str, store.table(t).collect())) for t in store.table_names()}
    return {t: r for t, r in tables.items()}


def test_stream_equals_batch_and_merges_each_log_once(spark, tmp_path):
    inbox = tmp_path / "in"
    keep = ("logs", "signalling", "location")
    for i in range(3):
        full = sl.plain_log(sl.log_hash(100 + i))
        sl.write_log(inbox / f"d{i}", f"{i}.azm", {t: full[t] for t in keep})
    batch = LogStore(spark, str(tmp_path / "batch"))
    merge(batch, read_log_files(spark, str(inbox)))
    stream = LogStore(spark, str(tmp_path / "stream"))
    checkpoint = str(tmp_path / "checkpoint")
    follow(stream, str(inbox), checkpoint, files_per_batch=2).awaitTermination()
    assert rows(stream) == rows(batch)
    # The same log in a new file is refused, also by a new checkpoint.
    full = sl.plain_log(sl.log_hash(100))
    sl.write_log(inbox, "again.azm", {t: full[t] for t in keep})
    follow(stream, str(inbox), checkpoint).awaitTermination()
    again = stream.dispositions().where("path like '%again.azm'").first()
    assert again.status == "already_merged"
    assert stream.table("logs").count() == 3


def test_interval_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError, match="positive"):
        follow(LogStore(spark, str(tmp_path)), str(tmp_path), str(tmp_path / "c"), every_seconds=0)
