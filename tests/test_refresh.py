"""Refresh algebra: a full rebuild equals an incremental refresh of all
keys; refreshing twice equals once; a user who moved centre is never duplicated."""

from pyspark.sql import functions as F

from lessonlens.plans.catalog import SNAP_SCALARS, previous_snapshot
from lessonlens.plans.products import Pipeline
from lessonlens.streaming import incremental as INC


def _rows(df):
    return sorted(tuple(r) for r in df.select(*SNAP_SCALARS).collect())


def test_refresh_all_keys_equals_full_rebuild(sources):
    p = Pipeline(sources)
    prev = previous_snapshot(p)
    keys = sources.users.select(F.col("id").alias("user_id"))
    assert _rows(INC.refresh_users(sources, prev, keys)) == _rows(p.user_snapshot())


def test_refresh_is_idempotent(sources):
    p = Pipeline(sources)
    prev = previous_snapshot(p)
    keys = INC.refresh_keys(sources, prev, INC.watermark_value(prev))
    once = INC.refresh_users(sources, prev, keys)
    twice = INC.refresh_users(sources, once, keys)
    assert _rows(once) == _rows(twice)
    assert INC.gap_users(sources, once).count() == 0


def test_centre_refresh_does_not_duplicate_moved_user(sources):
    p = Pipeline(sources)
    snap = p.user_snapshot()
    mover = snap.where(F.col("centre_id").isNotNull()).orderBy("user_id").first()
    stale = snap.withColumn("centre_id", F.when(F.col("user_id") == mover.user_id, F.lit(999))
                            .otherwise(F.col("centre_id")))
    centres = sources.centres.where(F.col("id") == mover.centre_id).select(F.col("id").alias("centre_id"))
    out = INC.refresh_centres(sources, stale, centres)
    rows = out.where(F.col("user_id") == mover.user_id).collect()
    assert len(rows) == 1 and rows[0].centre_id == mover.centre_id


def test_cleanup_removes_inactive_users_and_centres(sources):
    p = Pipeline(sources)
    out = INC.cleanup_inactive(sources, previous_snapshot(p))
    bad_users = INC.inactive_users(sources)
    bad_centres = INC.inactive_centres(sources)
    assert out.join(bad_users, "user_id", "left_semi").count() == 0
    assert out.join(bad_centres, "centre_id", "left_semi").count() == 0
    assert INC.cleanup_inactive(sources, None) is None


def test_empty_key_result_still_removes_old_rows(sources):
    p = Pipeline(sources)
    prev = previous_snapshot(p)
    gone = INC.inactive_users(sources)
    fresh = Pipeline(sources, user_keys=gone).user_snapshot()
    assert fresh.count() == 0
    out = INC.replace_keys(prev, fresh, gone, "user_id")
    assert out.join(gone, "user_id", "left_semi").count() == 0


def test_scope_reaches_the_logs(spark):
    """A restricted run semi-joins both logs and the career history below their aggregates."""
    from lessonlens.operators.scope import Params
    from lessonlens.plans.catalog import pipeline
    from tests.conftest import SF_SMALL

    def semi_joins(p):
        return p.merged._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi")

    full = pipeline(spark, SF_SMALL)
    keys = full.src.users.select(F.col("id").alias("user_id")).where("user_id < 9")
    assert semi_joins(full) == 0
    assert semi_joins(Pipeline(full.src, user_keys=keys)) == 3
    assert semi_joins(Pipeline(full.src, Params(centre_id=7))) == 3
    assert semi_joins(Pipeline(full.src, Params(subject_id=12))) == 2


def test_large_scopes_filter_the_logs_by_a_bitmap(spark, sources, monkeypatch):
    """Beyond the broadcast bound a scope still restricts the logs, and gives the same rows."""
    from lessonlens.operators import completion, joins

    keys = sources.users.select(F.col("id").alias("user_id")).where("user_id % 3 = 0")
    expected = _rows(Pipeline(sources, user_keys=keys).user_snapshot())
    for module in (completion, __import__("lessonlens.plans.products", fromlist=["x"])):
        monkeypatch.setattr(module, "may_broadcast", lambda df, key=None, limit=None: False)
    p = Pipeline(sources, user_keys=keys)
    assert p.scope_ids is None and len(p.log_keys) == 1
    plan = p.merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bitmap_construct_agg") == 2 and "Join LeftSemi" not in plan
    assert _rows(p.user_snapshot()) == expected
    # what reaches the aggregate: all rows of the scope, few others
    log = sources.learning_activities
    near = joins.bitmap_semi_join(log, keys, "user_id")
    exact = log.join(keys, "user_id", "left_semi")
    assert near.columns == log.columns
    assert near.exceptAll(exact).count() == 0 and near.count() == exact.count()
    tight = joins.bitmap_semi_join(log, keys, "user_id", bits=64)
    assert exact.exceptAll(tight).count() == 0
