"""Per-centre allocation diagnostics (2K), re-aimed as set-based tables.

The reference inspects one centre on the console; here every stage is a
``groupBy(centre_id)`` over the real allocation relations, so all centres are
diagnosed in one job and the counts agree with what the pipeline produces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.functions.columns import is_active, type_not_excluded
from lessonlens.plans.products import Pipeline

_COUNT = lambda: F.count(F.lit(1)).cast("bigint")


def centre_status(p: Pipeline) -> DataFrame:
    """K0: active / inactive / soft-deleted per centre."""
    c = p.src.centres
    return c.select(F.col("id").alias("centre_id"), "name",
                    F.when(F.col("status") != 1, "inactive")
                    .when(F.col("deleted_at").isNotNull(), "soft_deleted")
                    .otherwise("active").alias("centre_state"))


def active_users_by_type(p: Pipeline) -> DataFrame:
    """Active users per centre, type and PLE flag."""
    u = p.src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active())
    return (u.groupBy("centre_id", F.col("type").alias("user_type"), "is_ple")
            .agg(_COUNT().alias("user_count")))


def centre_subjects(p: Pipeline) -> DataFrame:
    """K2: subjects mapped to each centre, active and inactive."""
    s = p.src.subjects.select(F.col("id").alias("subject_id"), is_active().alias("_active"))
    j = p.src.centre_subject.join(s, "subject_id")
    return j.groupBy("centre_id").agg(
        _COUNT().alias("mapped"), F.count_if(F.col("_active")).cast("bigint").alias("active"),
        F.count_if(~F.col("_active")).cast("bigint").alias("inactive"))


def centre_lessons(p: Pipeline) -> DataFrame:
    """K3: learner-eligible lessons per centre, subject and type, before and after
    the type exclusion."""
    from lessonlens.operators.allocation import eligible_lessons

    s = p.src.subjects.where(is_active()).select(F.col("id").alias("subject_id"),
                                                  F.col("name").alias("subject"))
    les = eligible_lessons(p.src, True, p.consts, excluded_types=())
    j = p.src.centre_subject.join(s, "subject_id").join(les, "subject_id")
    return (j.groupBy("centre_id", "subject", "lesson_type")
            .agg(_COUNT().alias("lessons"),
                 F.count_if(type_not_excluded("lesson_type", p.consts.excluded_lesson_types))
                 .cast("bigint").alias("after_type_filter")))


def path_reach(p: Pipeline, path: str) -> DataFrame:
    """K4 / K6: distinct users, lessons and rows per centre for one allocation path."""
    a = p.allocation.where(F.col("allocation_path") == path)
    return a.groupBy("centre_id").agg(
        F.countDistinct("user_id").cast("bigint").alias("users"),
        F.countDistinct("lesson_id").cast("bigint").alias("lessons"), _COUNT().alias("rows"))


def ple_reach(p: Pipeline) -> DataFrame:
    """K5: PLE learners per centre, those with a live latest career path, and those
    with at least one allocated lesson (path + mapped subject)."""
    from lessonlens.operators.allocation import latest_career_path

    live = p.src.ple_career_paths.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("job_type_id"))
    with_path = latest_career_path(p.src).join(live, "job_type_id", "left_semi").select(
        "user_id", F.lit(1).alias("_path"))
    allocated = (p.allocation.where(F.col("allocation_path") == C.PATH_PLE)
                 .select("user_id").distinct().withColumn("_alloc", F.lit(1)))
    u = (p.users.where(F.col("user_type").isin(*C.LEARNER_TYPES) & (F.col("is_ple") == 1))
         .select("user_id", "centre_id").distinct()
         .join(with_path, "user_id", "left").join(allocated, "user_id", "left"))
    return u.groupBy("centre_id").agg(
        _COUNT().alias("ple_learners"),
        F.count_if(F.col("_path").isNotNull()).cast("bigint").alias("with_career_path"),
        F.count_if(F.col("_alloc").isNotNull()).cast("bigint").alias("with_subject_mapping"))


def ple_paths(p: Pipeline) -> DataFrame:
    """K5: career paths in use per centre (PLE learners by their latest live path)."""
    from lessonlens.operators.allocation import latest_career_path

    names = p.src.ple_career_paths.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("job_type_id"), F.col("name").alias("career_path"))
    u = (p.users.where(F.col("user_type").isin(*C.LEARNER_TYPES) & (F.col("is_ple") == 1))
         .select("user_id", "centre_id").distinct())
    return (u.join(latest_career_path(p.src), "user_id").join(names, "job_type_id")
            .groupBy("centre_id", "career_path")
            .agg(F.countDistinct("user_id").cast("bigint").alias("users")))


def activity_by_centre(p: Pipeline) -> DataFrame:
    """K7: learner activity records per centre and completed flag (active users).

    The log is counted by user before the centre is looked up: the join sees one row per user and
    flag instead of every record, and a very active user is combined map-side."""
    u = p.src.users.where(is_active()).select(F.col("id").alias("user_id"), "centre_id")
    by_user = p.src.learning_activities.groupBy("user_id", "completed").agg(_COUNT().alias("n"))
    return (by_user.join(u, "user_id").groupBy("centre_id", "completed")
            .agg(F.sum("n").cast("bigint").alias("records")))


def matched_completions(p: Pipeline) -> DataFrame:
    """K8: completions that survive the full allocation chain, per centre."""
    return (p.merged.where(F.col("completed") == 1).groupBy("centre_id")
            .agg(_COUNT().alias("matched_completions")))


def centre_totals(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows, summed totals and average percentage per centre."""
    return snapshot.groupBy("centre_id").agg(
        _COUNT().alias("row_count"),
        F.coalesce(F.sum("total_allocated"), F.lit(0)).cast("bigint").alias("sum_allocated"),
        F.coalesce(F.sum("total_completed"), F.lit(0)).cast("bigint").alias("sum_completed"),
        F.coalesce(F.round(F.avg("completion_pct"), 2), F.lit(0)).cast("decimal(10,2)")
        .alias("avg_pct"))


def user_funnel(p: Pipeline) -> DataFrame:
    """One row per active user with all that K1 and K4-K9 count of them: type, PLE flag, live career path, and the
    user's allocated, PLE-allocated and completed rows.  The user x lesson rows are built once and
    aggregated where they lie (partitioned by user)."""
    from lessonlens.operators.allocation import latest_career_path
    from lessonlens.operators.rollup import one_user_row

    fan = p.merged.groupBy("user_id").agg(
        _COUNT().alias("allocated"), F.sum("completed").cast("bigint").alias("completed"),
        F.count_if(F.col("allocation_path") == C.PATH_PLE).cast("bigint").alias("ple_allocated"))
    live = p.src.ple_career_paths.where(F.col("deleted_at").isNull()).select(F.col("id").alias("job_type_id"))
    paths = latest_career_path(p.src).join(live, "job_type_id", "left_semi").select("user_id", F.lit(1).alias("with_path"))
    return (one_user_row(p.users).select("user_id", "centre_id", "user_type", "is_ple")
            .join(fan, "user_id", "left").join(paths, "user_id", "left"))


def centre_funnel(p: Pipeline) -> DataFrame:
    """K1, K5, K8 and K9 per centre in one aggregate of the user funnel."""
    learner = F.col("user_type").isin(*C.LEARNER_TYPES)
    ple = learner & (F.col("is_ple") == 1)
    def number(cond):
        return F.count_if(cond).cast("bigint")
    return user_funnel(p).groupBy("centre_id").agg(
        _COUNT().alias("n_users"), number(learner).alias("n_learners"), number(ple).alias("ple_learners"),
        number(ple & F.col("with_path").isNotNull()).alias("with_career_path"),
        number(ple & (F.col("ple_allocated") > 0)).alias("with_subject_mapping"),
        F.coalesce(F.sum("allocated"), F.lit(0)).alias("sum_allocated"),
        F.coalesce(F.sum("completed"), F.lit(0)).alias("sum_completed"))


def centre_flags(p: Pipeline) -> DataFrame:
    """One row per centre with the list of warnings raised by K0-K9."""
    c = centre_status(p).select("centre_id", "centre_state")
    subj = centre_subjects(p)
    les = (centre_lessons(p).groupBy("centre_id")
           .agg(F.sum("lessons").alias("n_lessons"), F.sum("after_type_filter").alias("n_after")))
    act = (activity_by_centre(p).where(F.col("completed") == 1)
           .groupBy("centre_id").agg(F.sum("records").alias("n_done")))
    j = (c.join(centre_funnel(p), "centre_id", "left").join(subj, "centre_id", "left").join(les, "centre_id", "left")
         .join(act, "centre_id", "left"))
    z = lambda n: F.coalesce(F.col(n), F.lit(0))
    rules = [
        (F.col("centre_state") != "active", "centre not active"),
        (z("n_users") == 0, "no active users"),
        ((z("n_learners") > 0) & (z("ple_learners") == z("n_learners")), "all learners are PLE"),
        (z("mapped") == 0, "no subjects mapped"),
        ((z("mapped") > 0) & (z("active") == 0), "all mapped subjects inactive"),
        ((z("n_lessons") > 0) & (z("n_after") == 0), "all eligible lessons excluded by type"),
        ((z("ple_learners") > 0) & (z("with_career_path") == 0), "PLE learners without career path"),
        ((z("with_career_path") > 0) & (z("with_subject_mapping") == 0),
         "career paths without subject mapping"),
        (z("n_done") == 0, "no completed activity"),
        ((z("n_done") > 0) & (z("sum_completed") == 0), "completions not matching allocation"),
        (z("n_users") == 0, "no snapshot rows"),
        ((z("n_users") > 0) & (z("sum_completed") == 0), "snapshot rows without completions"),
    ]
    flags = F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in rules]))
    return j.select("centre_id", flags.alias("flags"))
