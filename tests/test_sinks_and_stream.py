"""Sinks (stage-and-swap, skip-empty, CSV) and the Structured Streaming refresh driver."""

import tempfile
import uuid

from pyspark.sql import functions as F

from lessonlens.operators import joins
from lessonlens.plans.catalog import SNAP_SCALARS, previous_snapshot
from lessonlens.plans.products import Pipeline
from lessonlens.sources import sinks
from lessonlens.streaming.feed import refresh_batch, start_activity_refresh


def test_stage_and_swap_can_replace_from_itself(spark, sources):
    snap = Pipeline(sources).user_snapshot().select(*SNAP_SCALARS)
    assert sinks.write_replace(snap, "ll_snapshot_t1")
    live = spark.table("ll_snapshot_t1")
    n = live.count()
    # a replacement computed from the live table itself
    assert sinks.write_replace(live.where(F.col("user_id") % 2 == 0), "ll_snapshot_t1")
    assert spark.table("ll_snapshot_t1").count() == snap.where(F.col("user_id") % 2 == 0).count() < n
    assert not sinks.write_replace(live.limit(0), "ll_snapshot_t1")     # empty never replaces
    assert sinks.table_exists(spark, "ll_snapshot_t1")


def test_interrupted_swap_loses_no_row(spark):
    name = f"ll_swap_{uuid.uuid4().hex}"
    first, second = spark.range(7).toDF("user_id"), spark.range(9).toDF("user_id")
    assert sinks.choose_mode(spark, name) == "full"
    sinks.stage_and_swap(first, name)
    # stopped while staging, between the renames, and before the drop
    sinks.stage(second, name)
    assert sinks.choose_mode(spark, name) == "incremental" and spark.table(name).count() == 7
    sinks.stage(second, name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    assert sinks.choose_mode(spark, name) == "incremental" and spark.table(name).count() == 7
    sinks.stage(second, name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.sql(f"ALTER TABLE {name}__staging RENAME TO {name}")
    sinks.recover(spark, name)
    assert spark.table(name).count() == 9
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__")]


def test_missing_target_is_built_in_full(spark, sources):
    name = f"ll_full_{uuid.uuid4().hex}"
    everyone = Pipeline(sources).user_snapshot()
    refresh_batch(spark, lambda: sources, name, everyone.select("user_id").limit(1))
    assert spark.table(name).count() == everyone.count() > 1


def test_append_creates_then_adds(spark):
    name = f"ll_append_{uuid.uuid4().hex}"
    sinks.write_append(spark.range(3).toDF("x"), name)
    sinks.write_append(spark.range(2).toDF("x"), name)
    assert spark.table(name).count() == 5


def test_broadcast_bound_is_not_shared_between_scopes(spark):
    full = spark.range(50).toDF("k")
    key = ("sf", uuid.uuid4().hex)
    assert joins.row_count(full.where("k < 5"), key) == 5
    assert joins.row_count(full, key) == 50


def test_csv_sink_writes_nested_as_json(spark, sources):
    out = tempfile.mkdtemp(prefix="ll-csv-")
    snap = Pipeline(sources).user_snapshot().limit(5)
    sinks.write_csv(snap, out + "/x", gzip=True, nested=("project_combos", "subject_combos"))
    back = spark.read.option("header", True).csv(out + "/x")
    assert back.count() == 5 and "subject_combos" in back.columns


def test_enforce_schema_zero_fill(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    df = spark.createDataFrame([(None, "a")], "x int, y string")
    out = sinks.enforce_schema(df, StructType([StructField("x", IntegerType())]), zero_fill=("x",))
    assert out.first().x == 0 and out.columns == ["x"]


def test_activity_stream_refreshes_target(spark, sources):
    p = Pipeline(sources)
    prev = previous_snapshot(p)
    sinks.stage_and_swap(prev, "ll_stream_target")
    feed = tempfile.mkdtemp(prefix="ll-feed-")
    act = sources.learning_activities
    act.write.mode("overwrite").parquet(feed + "/batch1")
    q = start_activity_refresh(spark, feed + "/batch1", act.schema, lambda: sources,
                               "ll_stream_target", name=f"t_feed_{uuid.uuid4().hex}")
    q.awaitTermination(600)
    table = spark.table("ll_stream_target")
    assert table.groupBy("user_id").count().where("count > 1").count() == 0
    fresh = p.user_snapshot().join(act.select("user_id").distinct(), "user_id", "left_semi")
    got = table.join(act.select("user_id").distinct(), "user_id", "left_semi")
    key = lambda df: sorted(tuple(r) for r in df.select(*SNAP_SCALARS).collect())
    assert key(got) == key(fresh)
