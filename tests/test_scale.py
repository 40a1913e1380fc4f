"""Plans and results where one key holds a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from logtrail.operators import aggregates, filters, joins
from logtrail.plans import derived_logs

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
}


@pytest.fixture
def shuffled(spark):
    """A session that never broadcasts and calls small partitions skewed."""
    before = {k: spark.conf.get(k, None) for k in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_facts(spark, rows=400_000):
    """A third of the rows belong to log 1."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 2).cast("bigint")
    time = F.timestamp_seconds(F.col("id") % 100_000).cast("timestamp_ntz")
    # Several scan tasks, so that a hot shuffle partition has parts to split into.
    return spark.range(0, rows, 1, 16).select(key.alias("log_hash"), time.alias("time"), F.md5(F.col("id").cast("string")).alias("info"))


def logs(spark):
    start = F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz")
    return spark.range(1, 5003).select(
        F.col("id").alias("log_hash"), start.alias("log_start_time"), (start + F.expr("interval 1 hour")).alias("log_end_time")
    )


def final_plan(df):
    value = F.coalesce("v", F.lit(0)) if "v" in df.columns else F.lit(0)
    counted = df.groupBy().agg(F.sum(F.length("info") + value))
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split_in_shuffled_joins(shuffled, how):
    facts, lookup = hot_facts(shuffled), logs(shuffled)
    joined = joins.lookup_join(facts, lookup.where("log_hash % 2 = 1").select("log_hash", F.lit(1).alias("v")), ["log_hash"], how)
    want = {"inner": None, "left": 400_000, "left_semi": None, "left_anti": None}[how]
    odd = facts.where("log_hash % 2 = 1").count()
    assert joined.count() == (want or (odd if how != "left_anti" else 400_000 - odd))
    assert "skew=true" in final_plan(joined)


def test_clamp_is_whole_on_a_hot_log(shuffled):
    kept = filters.clamp_to_log(hot_facts(shuffled), logs(shuffled), hours=1)
    assert kept.count() == hot_facts(shuffled).where(F.unix_seconds(F.col("time").cast("timestamp")) <= 7200).count()


def test_copies_of_one_log_do_not_share_a_task(shuffled):
    files = hot_facts(shuffled, 100_000).select("log_hash", F.concat(F.lit("in/"), "info").alias("path"))
    marked = joins.first_file_wins(files)
    assert marked.where("is_first").groupBy("log_hash").count().where("count > 1").isEmpty()
    assert marked.count() == 100_000
    plan = marked._jdf.queryExecution().executedPlan().toString()
    # The copies themselves are only ever shuffled by their own path.
    assert "Window" not in plan and "hashpartitioning(path" in plan


def test_aggregates_combine_before_their_shuffle(spark):
    latest = aggregates.latest_nonempty(hot_facts(spark, 1000), "info", ["time"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate(") >= 2 and "partial_max_by" in plan


def test_busy_device_becomes_several_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(derived_logs, "EVENTS_PER_FILE", 100)
    events = spark.range(1000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id")).cast("bigint").alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit("{}").alias("props"),
    )
    files = [r.path for r in derived_logs.log_files_from(events).collect()]
    assert len([p for p in files if "/000000/" in p]) == 6 and len(files) == 6 + 99
