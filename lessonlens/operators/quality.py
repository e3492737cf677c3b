"""Data-quality checks (2M) over the snapshot.  The reference recommends them in
prose only; each is a single aggregate pass (no row reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C

REQUIRED = ["user_id", "user_type", "total_allocated", "total_completed", "completion_pct"]


def dup_users(table: DataFrame) -> DataFrame:
    """Users with more than one row."""
    return (table.groupBy("user_id").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
            .where(F.col("rows") > 1))


def multi_centre_users(table: DataFrame) -> DataFrame:
    """Users whose rows sit under more than one centre."""
    return (table.groupBy("user_id")
            .agg(F.countDistinct("centre_id").cast("bigint").alias("centres"))
            .where(F.col("centres") > 1))


def checks(snapshot: DataFrame, centres: DataFrame, addon: DataFrame,
           active_users: DataFrame) -> DataFrame:
    """M1-M6 as one row per check: ``(check, value)``; 0 means pass except for
    the row counts and the coverage ratio."""
    cnt = lambda cond: F.count_if(cond).cast("decimal(20,4)")

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("decimal(20,4)").alias("value")).select(
            F.lit(name).alias("check"), "value")

    main = snapshot.agg(
        F.count(F.lit(1)).cast("decimal(20,4)").alias("snapshot_rows"),
        *[cnt(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED],
        cnt((F.col("completion_pct") < 0) | (F.col("completion_pct") > 100)).alias("pct_out_of_range"),
        cnt(F.col("total_completed") > F.col("total_allocated")).alias("completed_gt_allocated"),
        cnt((F.col("total_lessons_allocated") + F.col("total_assessments_allocated")
             != F.col("total_allocated"))
            | (F.col("total_lessons_completed") + F.col("total_assessments_completed")
               != F.col("total_completed"))).alias("parts_mismatch"),
        cnt((F.col("subject_combos").isNull() & (F.col("total_lessons_completed") > 0))
            | (F.col("subject_combos").isNotNull() & (F.col("total_lessons_completed") == 0)))
        .alias("combos_rule_violations"))
    names = main.columns
    long = main.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(n).alias("value")) for n in names])))
    unknown_centre = (snapshot.where(F.col("centre_id").isNotNull()).select("centre_id")
                      .join(centres.select(F.col("id").alias("centre_id")), "centre_id", "left_anti"))
    orphans = addon.select("user_id").distinct().join(snapshot.select("user_id"), "user_id", "left_anti")
    snap_users = snapshot.select("user_id").distinct()
    act = active_users.select("user_id").distinct()
    coverage = (act.join(snap_users.withColumn("_in", F.lit(1)), "user_id", "left")
                .agg(F.round(F.count_if(F.col("_in").isNotNull()).cast("decimal(20,0)")
                             / F.nullif(F.count(F.lit(1)).cast("decimal(20,0)"),
                                        F.lit(0).cast("decimal(20,0)")), 4)
                     .cast("decimal(20,4)").alias("value"))
                .select(F.lit("coverage").alias("check"), "value"))
    return (long.unionByName(rows(dup_users(snapshot), "duplicate_users"))
            .unionByName(rows(unknown_centre, "rows_unknown_centre"))
            .unionByName(rows(orphans, "addon_users_not_in_snapshot"))
            .unionByName(rows(act, "active_users"))
            .unionByName(coverage))


def centre_drop(current: DataFrame, previous: DataFrame,
                threshold: float = C.CENTRE_DROP_THRESHOLD) -> DataFrame:
    """M7: rows per centre now vs the previous snapshot; a drop above the threshold
    is flagged (a centre that vanished counts as a full drop)."""
    cur = current.groupBy("centre_id").agg(F.count(F.lit(1)).cast("bigint").alias("rows_now"))
    prev = (previous.groupBy(F.col("centre_id").alias("_pc"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("rows_before")))
    # NULL-safe: users without a centre form one group on both sides
    j = (cur.join(prev, cur.centre_id.eqNullSafe(prev._pc), "full")
         .withColumn("centre_id", F.coalesce("centre_id", "_pc")))
    now = F.coalesce(F.col("rows_now"), F.lit(0))
    before = F.coalesce(F.col("rows_before"), F.lit(0))
    drop = F.when(before > 0, F.round((before - now).cast("decimal(20,0)") / before, 4)).cast("decimal(10,4)")
    return j.select("centre_id", now.cast("bigint").alias("rows_now"),
                    before.cast("bigint").alias("rows_before"), drop.alias("drop_ratio"),
                    F.when(drop > F.lit(threshold), 1).otherwise(0).alias("flagged"))


def audit_rows(table: DataFrame, run_id: str) -> DataFrame:
    """M8: rows per centre for one run."""
    return (table.groupBy("centre_id").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
            .select(F.lit(run_id).alias("run_id"), "centre_id", "rows"))


def schema_drift(df: DataFrame, declared) -> list[str]:
    """M9: differences between a frame's schema and the declared one (names, types)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    out = [f"missing {n}" for n in want if n not in have]
    out += [f"unexpected {n}" for n in have if n not in want]
    out += [f"type {n}: {have[n]} != {want[n]}" for n in want if n in have and have[n] != want[n]]
    return out
