"""A task's share of the user x lesson rows does not grow with the data."""

import pytest
from pyspark.sql import functions as F

from helpers import make_sources
from lessonlens import session
from lessonlens.operators import allocation as A
from lessonlens.operators import completion as CMP
from lessonlens.plans.products import Pipeline
from lessonlens.sources import fixtures

DEALT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLEL_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def _restored(spark, *names):
    before = {n: spark.conf.get(n, None) for n in names}
    yield
    for n, value in before.items():
        if value is None:
            spark.conf.unset(n)
        else:
            spark.conf.set(n, value)


@pytest.fixture
def dealt(spark):
    yield from _restored(spark, DEALT)


@pytest.fixture
def merged(spark):
    yield from _restored(spark, DEALT, MERGED, PARALLEL_FIRST)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_grow_with_users_and_catalogue(spark, sources, monkeypatch):
    monkeypatch.setattr(session, "FAN_OUT_ROWS", 1000)

    def pipe(n):
        users = [dict(id=i, type=3, status=1, centre_id=1) for i in range(n)]
        lessons = [dict(id=i, name=f"l{i}", subject_id=1, lesson_category_id=0, status=1, student_access=1) for i in range(50)]
        return Pipeline(make_sources(spark, sources, f"users-{n}", users=users, lessons=lessons))
    few, many = pipe(400), pipe(1200)
    assert A.catalogue_rows(few.src) == 50
    assert (few.partitions, many.partitions) == (20, 60)
    assert many.users.rdd.getNumPartitions() == 60
    assert many.users.count() == 1200


def test_scope_without_user_filter_covers_the_logs(spark, sources, monkeypatch):
    monkeypatch.setattr(session, "FAN_OUT_ROWS", 10)
    logs = [dict(user_id=i, lesson_id=1, completed=1) for i in range(300)]      # of users that are not there
    assert Pipeline(make_sources(spark, sources, "logs", learning_activities=logs)).partitions == 30


def test_exchanges_are_sized_by_the_logs(spark, dealt, monkeypatch):
    plain = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(session, "LOG_ROWS", 100)
    session.deal(spark, 100)
    assert int(spark.conf.get(DEALT)) == plain
    session.deal(spark, 100 * plain * 4)
    assert int(spark.conf.get(DEALT)) == plain * 4 == session.user_partitions(spark)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == plain


def test_logs_are_not_merged_into_large_tasks(spark, merged, monkeypatch):
    logs = spark.range(1_000_000).selectExpr("id * 7 % 1000000 AS user_id", "id % 500 AS lesson_id", "1 AS completed",
                                           "CAST(id % 100 AS DECIMAL(10,2)) AS score",
                                           "CAST(id % 5 AS DECIMAL(10,2)) AS rating", "CAST(id % 60 AS INT) AS duration")
    monkeypatch.setattr(session, "MERGED_BYTES", "1m")
    monkeypatch.setattr(session, "LOG_ROWS", 10_000)
    spark.conf.set(PARALLEL_FIRST, "false")     # as where the logs are large: each task is filled up to the size
    spark.conf.unset(MERGED)
    session.deal(spark, 1_000_000)
    tasks = [r["count"] for r in CMP._aggregate(logs).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 1_000_000 and max(tasks) < 250_000


def test_a_merged_size_of_the_session_is_kept(spark, merged):
    spark.conf.set(MERGED, "8m")
    session.deal(spark, 100)
    assert spark.conf.get(MERGED) == "8m"
    spark.conf.unset(MERGED)
    session.deal(spark, 100)
    assert spark.conf.get(MERGED) == session.MERGED_BYTES


def test_settings_are_as_before_after_a_checkpoint(spark):
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    df = session.checkpoint_partitioned(spark.range(100), "id", 31)
    assert df.rdd.getNumPartitions() == 31 and [spark.conf.get(n) for n in names] == before


def test_fan_out_passes_the_completion_unsorted(sources):
    plan = _plan(Pipeline(sources).merged)
    assert any("ShuffledHashJoin [user_id" in x and "LeftOuter, BuildRight" in x for x in plan.splitlines())
    assert not any("SortMergeJoin [user_id" in x and "_src" in x for x in plan.splitlines())


def test_snapshot_joins_its_users_unsorted(spark, sources):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")          # as where the user tables are too large to broadcast
    try:
        joins = [x for x in _plan(Pipeline(sources).user_snapshot()).splitlines() if "LeftOuter" in x and "Join [user_id" in x]
    finally:
        spark.conf.set(name, before)
    assert len(joins) == 5 and all("ShuffledHashJoin" in x and "BuildRight" in x for x in joins)


def test_stored_tables_hold_the_derived_rows(spark, sources):
    lazy = fixtures.Sources(spark, sources.sf_dir)
    for name in (*fixtures.OF_STORED, "batches", "ple_assessment_options", "centre_subject"):
        a, b = getattr(sources, name), getattr(lazy, name)
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
