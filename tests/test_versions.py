"""Versioned tables: bucketed replacement, single-step switch, vacuum."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from lessonlens.plans.catalog import SNAP_SCALARS, previous_snapshot
from lessonlens.plans.products import Pipeline
from lessonlens.sources.versions import VersionedTable
from lessonlens.streaming import incremental as INC
from lessonlens.streaming.feed import refresh_batch


def made(spark, df, key="user_id", buckets=16):
    t = VersionedTable(spark, f"ll_v_{uuid.uuid4().hex[:12]}", key, buckets)
    t.publish(df)
    return t


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def people(spark, n, version=0):
    return spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("centre_id"),
                                 F.lit(version).alias("v"), F.array(F.struct(F.col("id").alias("a"))).alias("nested"))


def test_only_touched_buckets_are_written(spark):
    t = made(spark, people(spark, 1000))
    before = t.locations()
    assert len(before) == 16 and t.version() == 1
    keys = spark.createDataFrame([(3,), (4,)], "user_id long")
    buckets = t.replace(keys, people(spark, 1000, 1).where("user_id = 3"))
    after = t.locations()
    assert 1 <= len(buckets) <= 2 and t.version() == 2
    assert {b for b in before if before[b] != after.get(b)} == set(buckets)
    expected = people(spark, 1000).where("user_id not in (3, 4)").unionByName(people(spark, 1000, 1).where("user_id = 3"))
    assert rows(t.table()) == rows(expected) and t.table().columns == ["user_id", "centre_id", "v", "nested"]
    # the rewriting plan reads the touched folders only
    plan = t.rows(buckets)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and len(t.rows(buckets).inputFiles()) < len(t.table().inputFiles())


def test_an_emptied_bucket_and_an_empty_scope(spark):
    t = made(spark, people(spark, 40))
    b = t.touched(people(spark, 40).where("user_id = 5"))[0]
    own = t.rows([b]).select("user_id")
    assert t.replace(own, t.table().limit(0)) == [b] and b not in t.locations()
    assert t.table().count() == 40 - people(spark, 40).where(t.bucket() == b).count()
    assert t.replace(own.limit(0), t.table().limit(0)) == [] and t.version() == 2
    with pytest.raises(ValueError):
        t.replace(spark.createDataFrame([(1,)], "user_id long"), people(spark, 40))


def test_replacement_by_another_column(spark):
    t = made(spark, people(spark, 300))
    # centre 2 now has user 1 (of centre 1) and has lost its others
    scope = spark.createDataFrame([(2,)], "centre_id long")
    fresh = people(spark, 300, 1).where("user_id = 1").withColumn("centre_id", F.lit(2).cast("long"))
    t.replace(scope, fresh, by="centre_id", also="user_id")
    assert rows(t.table()) == rows(INC.replace_keys(people(spark, 300), fresh, scope, "centre_id", also_key="user_id"))


def test_a_reader_finds_the_old_version_or_the_new_one(spark):
    t = made(spark, people(spark, 500))
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(sorted({r.v for r in spark.table(t.name).where("user_id < 20").select("v").collect()})))
            except Exception as e:  # noqa: BLE001  any failure of a reader counts
                failed.append(e)
                return
    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 7):
        t.replace(people(spark, 20).select("user_id"), people(spark, 20, v))
        t.vacuum(keep=3)
    stop.set()
    reader.join()
    assert not failed and len(seen) > 1 and all(len(s) == 1 for s in seen)


def test_a_stopped_write_leaves_the_live_version(spark, monkeypatch):
    t = made(spark, people(spark, 60))
    real = spark.sql

    def no_view(text, *a, **k):
        if "REPLACE VIEW" in text:
            raise InterruptedError
        return real(text, *a, **k)
    with monkeypatch.context() as m:
        m.setattr(spark, "sql", no_view)
        with pytest.raises(InterruptedError):
            t.replace(people(spark, 60).select("user_id"), people(spark, 60, 1))
    assert t.version() == 1 and rows(t.table()) == rows(people(spark, 60))
    t.replace(people(spark, 60).select("user_id"), people(spark, 60, 2))
    assert t.vacuum(keep=1) == 2 and rows(t.table()) == rows(people(spark, 60, 2))
    fs, root = t._files(t.root)
    assert len(fs.listStatus(root)) == 1          # the live version's folder alone
    t.drop()
    assert not t.exists() and not fs.exists(root)


def test_a_replacement_from_a_former_version_is_refused(spark):
    t = made(spark, people(spark, 30))
    other = VersionedTable(spark, t.name)
    assert (other.key, other.buckets, other.root) == ("user_id", 16, t.root)
    base = t.version()
    other.replace(people(spark, 3).select("user_id"), people(spark, 3, 1))
    with pytest.raises(RuntimeError, match="meanwhile"):
        t._switch(t.table(), t.locations(), base)
    assert t.version() == 2 and t.table().where("v = 1").count() == 3


def test_a_table_without_key_is_switched_whole(spark):
    t = made(spark, people(spark, 5), key=None)
    assert not t.publish(people(spark, 0), allow_empty=False) and t.version() == 1
    t.publish(t.table().where("user_id > 1"))         # from itself
    assert rows(t.table(), "user_id") == [(2,), (3,), (4,)] and t.version() == 2
    t.publish(people(spark, 0))
    assert t.table().count() == 0 and t.vacuum(keep=1) == 2


def test_stored_refreshes_equal_the_frames(spark, sources):
    prev = previous_snapshot(Pipeline(sources))
    keys = sources.users.where("id % 100 = 7").select(F.col("id").alias("user_id"))
    t = made(spark, prev)
    INC.refresh_users_in(t, sources, keys)
    assert rows(t.table()) == rows(INC.refresh_users(sources, prev, keys))
    centres = sources.centres.where("id in (3, 7)").select(F.col("id").alias("centre_id"))
    t = made(spark, prev)
    assert len(INC.refresh_centres_in(t, sources, centres)) <= 16
    assert rows(t.table(), *SNAP_SCALARS) == rows(INC.refresh_centres(sources, prev, centres), *SNAP_SCALARS)
    INC.cleanup_inactive_in(t, sources)
    gone = INC.cleanup_inactive(sources, INC.refresh_centres(sources, prev, centres))
    assert rows(t.table(), *SNAP_SCALARS) == rows(gone, *SNAP_SCALARS)


def test_a_batch_rewrites_its_users_buckets(spark, sources):
    t = VersionedTable(spark, f"ll_v_{uuid.uuid4().hex[:12]}", "user_id", 32)
    batch = sources.users.select(F.col("id").alias("user_id")).where("user_id in (11, 12)")
    assert refresh_batch(spark, lambda: sources, t, batch) == 1         # no table yet: built in full
    full = rows(Pipeline(sources).user_snapshot(), *SNAP_SCALARS)
    before = t.locations()
    assert rows(t.table(), *SNAP_SCALARS) == full
    assert refresh_batch(spark, lambda: sources, t, batch.limit(0)) == 0 and t.version() == 1
    refresh_batch(spark, lambda: sources, t, batch)
    assert rows(t.table(), *SNAP_SCALARS) == full
    assert sum(before[b] != at for b, at in t.locations().items()) <= 2
