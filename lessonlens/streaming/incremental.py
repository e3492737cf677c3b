"""Incremental maintenance of the user snapshot (section 2I), set-based.

The reference refreshes users or centres one query at a time; here the key
set is one DataFrame, the recomputation is one plan restricted by a semi
join, and the keyed replacement is an anti join + union (parquet tables cannot
DELETE/MERGE).  As a frame (``refresh_users``) it spans the whole target; on a
stored target (``refresh_users_in``) only the touched buckets of a
:class:`VersionedTable` are read and written.  "Watermark" is a batch
high-water mark on the target, not a streaming watermark: the reference has
no event stream (see ``lessonlens.streaming.feed`` for the optional
Structured Streaming driver of the same refresh).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.functions.columns import is_active, is_inactive
from lessonlens.plans.products import Pipeline
from lessonlens.session import ensure_checkpoint_dir
from lessonlens.sources.fixtures import CHANGED_DAY, Sources
from lessonlens.sources.versions import VersionedTable

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_DATETIME = re.compile(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")


# -- I1 / I2 / B24: cutoffs ---------------------------------------------------------
def watermark(target: DataFrame | None, overlap_minutes: int = C.DEFAULT_OVERLAP_MINUTES
              ) -> DataFrame:
    """``COALESCE(MAX(created_at), epoch) - overlap`` as a one-row frame.

    ``target=None`` (no table yet) gives the epoch itself.
    """
    if overlap_minutes < 0:
        raise ValueError(f"the overlap may not be negative: {overlap_minutes} minutes")
    epoch = F.to_timestamp_ntz(F.lit(C.EPOCH))
    if target is None:
        from pyspark.sql import SparkSession

        return SparkSession.active().range(1).select(epoch.alias("cutoff_at"))
    hw = F.coalesce(F.max(F.col("created_at").cast("timestamp_ntz")), epoch)
    return target.agg((hw - F.make_dt_interval(mins=F.lit(overlap_minutes))).alias("cutoff_at"))


def watermark_value(target: DataFrame | None,
                    overlap_minutes: int = C.DEFAULT_OVERLAP_MINUTES) -> str:
    """The high-water mark as a literal: one aggregated scalar read on the driver.

    As a literal the cutoff becomes a pushed-down predicate on every source
    scan (row groups older than the cutoff are skipped) instead of a join.
    """
    row = watermark(target, overlap_minutes).first()
    return row["cutoff_at"].strftime("%Y-%m-%d %H:%M:%S.%f")


def cutoff_literal(since: str | None = None, days: int | None = None,
                   now: dt.datetime | None = None) -> str:
    """A validated cutoff text.  A date gets midnight; ``days`` counts
    back from ``now`` (passed in, so jobs stay replayable)."""
    if since is not None:
        since = since.strip()
        if _DATE.match(since):
            since += " 00:00:00"
        if not _DATETIME.match(since):
            raise ValueError(f"malformed cutoff {since!r}")
        dt.datetime.strptime(since, "%Y-%m-%d %H:%M:%S")
        return since
    if days is not None:
        if days < 0:
            raise ValueError(f"cannot look back {days} days")
        return ((now or dt.datetime.now()) - dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")
    raise ValueError("since or days is required")


def _since(df: DataFrame, cutoff: str, *cols: str) -> DataFrame:
    """Rows with any of ``cols`` >= cutoff (a literal, pushed into the scan).  A table laid out by the day of
    the last change is read from the cutoff's day on: earlier directories are not listed."""
    cut = F.to_timestamp_ntz(F.lit(cutoff))
    if CHANGED_DAY in df.columns:
        # a row without any time has no day and cannot pass
        df = df.where(F.col(CHANGED_DAY) >= F.lit(cutoff[:10]).cast("date"))
    cond = None
    for name in cols:
        term = F.col(name) >= cut
        cond = term if cond is None else cond | term
    return df.where(cond)


# -- I3 / G6 ------------------------------------------------------------------------
def changed_users(src: Sources, cutoff) -> DataFrame:
    """Users created or updated since the cutoff (active only), plus users whose
    profile or either activity log changed since then; one distinct id column."""
    u = _since(src.users.where(is_active()), cutoff, "created_at", "updated_at").select(
        F.col("id").alias("user_id"))
    parts = [u] + [
        _since(t, cutoff, "created_at", "updated_at").select("user_id")
        for t in (src.student_details, src.learning_activities, src.facilitator_learning_activities)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("user_id").isNotNull()).distinct()


def active_user_ids(src: Sources) -> DataFrame:
    return (src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active())
            .select(F.col("id").alias("user_id")))


# -- I4 / C12 ------------------------------------------------------------------------
def gap_users(src: Sources, target: DataFrame | None) -> DataFrame:
    """Active source users absent from the target (all of them if no target)."""
    ids = active_user_ids(src).distinct()
    if target is None:
        return ids
    return ids.join(target.select("user_id"), "user_id", "left_anti")


# -- I5 / G7 ------------------------------------------------------------------------
def valid_keys(keys: DataFrame, pattern: str = C.UUID_PATTERN, key: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Keys kept as text, split into (well-formed, rejected), each trimmed and once; blank and NULL ones are in
    neither.  Numeric keys need no such check: their type is it."""
    text = F.trim(F.col(key).cast("string"))
    named = keys.select(text.alias(key)).where(F.length(key) > 0).distinct()
    return named.where(F.col(key).rlike(pattern)), named.where(~F.col(key).rlike(pattern))


def refresh_keys(src: Sources, target: DataFrame | None, cutoff,
                 centre_id=None) -> DataFrame:
    """(changed since cutoff) UNION (gap), optionally intersected with one centre's
    active users; NULL keys dropped, and where ids are text those that ``valid_keys`` rejects."""
    keys = changed_users(src, cutoff).unionByName(gap_users(src, target)).distinct()
    if centre_id is not None:
        keys = changed_users_centre(keys, src, centre_id)
    if keys.schema["user_id"].dataType.typeName() == "string":
        keys = valid_keys(keys)[0]
    return keys.where(F.col("user_id").isNotNull())


def changed_users_centre(keys: DataFrame, src: Sources, centre_id) -> DataFrame:
    """Keys intersected with the active users of one centre."""
    centre_users = (src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active()
                                    & (F.col("centre_id") == F.lit(centre_id)))
                    .select(F.col("id").alias("user_id")))
    return keys.join(centre_users, "user_id", "left_semi")


# -- I6 / C25 ------------------------------------------------------------------------
def changed_centres(src: Sources, cutoff) -> DataFrame:
    """Distinct centres of changed, active users; NULL centre dropped."""
    changed = changed_users(src, cutoff)
    u = (src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active()
                         & F.col("centre_id").isNotNull())
         .select(F.col("id").alias("user_id"), "centre_id"))
    return u.join(changed, "user_id", "left_semi").select("centre_id").distinct()


# -- I7 / I12 ------------------------------------------------------------------------
def missing_keys(wanted: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Wanted keys with no row in the target (skip-existing / outstanding keys)."""
    w = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    return w if target is None else w.join(target.select(key), key, "left_anti")


# -- A7 ------------------------------------------------------------------------------
def replace_keys(target: DataFrame | None, fresh: DataFrame, scope: DataFrame,
                 key: str, also_key: str | None = None) -> DataFrame:
    """Keyed replacement: every key in ``scope`` loses its old rows — even when the
    fresh result has none — and the fresh rows are added.

    ``also_key`` additionally removes old rows whose ``also_key`` appears in the
    fresh rows (a user who moved centre is not duplicated by a centre refresh).
    """
    if target is None:
        return fresh
    kept = target.join(scope.select(key).distinct(), key, "left_anti")
    if also_key is not None:
        kept = kept.join(fresh.select(also_key).distinct(), also_key, "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


# -- I8 ------------------------------------------------------------------------------
def refresh_users(src: Sources, target: DataFrame | None, keys: DataFrame, **kw) -> DataFrame:
    """Recompute the snapshot for ``keys`` (one plan, semi-join scoped) and replace."""
    fresh = Pipeline(src, user_keys=keys, **kw).user_snapshot()
    return replace_keys(target, fresh, keys, "user_id")


def refresh_centres(src: Sources, target: DataFrame | None, centres: DataFrame, **kw) -> DataFrame:
    """Recompute the snapshot for every active user of ``centres`` and replace by
    centre; rows of the same users left under an old centre are removed too."""
    users = (src.users.select(F.col("id").alias("user_id"), "centre_id")
             .join(centres.select("centre_id").distinct(), "centre_id", "left_semi")
             .select("user_id"))
    fresh = Pipeline(src, user_keys=users, **kw).user_snapshot()
    return replace_keys(target, fresh, centres, "centre_id", also_key="user_id")


def _stored_keys(keys: DataFrame, key: str) -> DataFrame:
    """The distinct keys, computed once: a replacement reads them several times."""
    ensure_checkpoint_dir(keys.sparkSession)
    return keys.select(key).where(F.col(key).isNotNull()).distinct().checkpoint(eager=True)


def refresh_users_in(target: VersionedTable, src: Sources, keys: DataFrame, **kw) -> list[int]:
    """``refresh_users`` on a stored target: rewrites the buckets of the keys and switches to the
    new version; returns those buckets.  Without a target the whole snapshot is built."""
    if not target.exists():
        target.publish(Pipeline(src, **kw).user_snapshot())
        return sorted(target.locations())
    scope = _stored_keys(keys, "user_id")
    return target.replace(scope, Pipeline(src, user_keys=scope, **kw).user_snapshot())


def refresh_centres_in(target: VersionedTable, src: Sources, centres: DataFrame, **kw) -> list[int]:
    """``refresh_centres`` on a stored target: rewrites the buckets of the centres' former and
    present users."""
    scope = _stored_keys(centres, "centre_id")
    users = (src.users.select(F.col("id").alias("user_id"), "centre_id")
             .join(scope, "centre_id", "left_semi").select("user_id"))
    fresh = Pipeline(src, user_keys=_stored_keys(users, "user_id"), **kw).user_snapshot()
    return target.replace(scope, fresh, by="centre_id", also="user_id")


def cleanup_inactive_in(target: VersionedTable, src: Sources) -> list[int]:
    """``cleanup_inactive`` on a stored target: rewrites the buckets that lose a row."""
    rows = target.table().select("user_id", "centre_id")
    gone = (rows.join(inactive_users(src), "user_id", "left_semi").select("user_id")
            .unionByName(rows.join(inactive_centres(src), "centre_id", "left_semi").select("user_id")))
    return target.replace(_stored_keys(gone, "user_id"), target.table().limit(0))


# -- B15 / C14 / I9 / I10 ------------------------------------------------------------------
def inactive_users(src: Sources) -> DataFrame:
    return src.users.where(is_inactive()).select(F.col("id").alias("user_id"))


def inactive_centres(src: Sources) -> DataFrame:
    return src.centres.where(is_inactive()).select(F.col("id").alias("centre_id"))


def cleanup_inactive(src: Sources, target: DataFrame | None) -> DataFrame | None:
    """Drop target rows whose user or centre is inactive; a missing table is a no-op."""
    if target is None:
        return None
    return (target.join(inactive_users(src), "user_id", "left_anti")
            .join(inactive_centres(src), "centre_id", "left_anti"))


def cleanup_preview(src: Sources, target: DataFrame) -> DataFrame:
    """Counts of rows that cleanup would delete, without writing: by user, by
    centre, and in total (a row may match both)."""
    iu = inactive_users(src).distinct().withColumn("_u", F.lit(1))
    ic = inactive_centres(src).distinct().withColumn("_c", F.lit(1))
    t = target.select("user_id", "centre_id").join(iu, "user_id", "left").join(ic, "centre_id", "left")
    return t.agg(F.count_if(F.col("_u").isNotNull()).cast("bigint").alias("rows_inactive_user"),
                 F.count_if(F.col("_c").isNotNull()).cast("bigint").alias("rows_inactive_centre"),
                 F.count_if(F.col("_u").isNotNull() | F.col("_c").isNotNull()).cast("bigint")
                  .alias("rows_to_delete"))


# -- D22 -----------------------------------------------------------------------------
def users_per_key(src: Sources, ids: DataFrame, id_type: str) -> DataFrame:
    """Active users per requested id (centre or user), zero-filled."""
    col = {"centre": "centre_id", "user": "id"}[id_type]
    counts = (src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active())
              .groupBy(F.col(col).alias("id")).agg(F.count(F.lit(1)).alias("user_count")))
    return (ids.select("id").distinct().join(counts, "id", "left")
            .select("id", F.coalesce("user_count", F.lit(0)).cast("bigint").alias("user_count")))
