"""Programme and phase attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.operators.joins import bounded_broadcast
from lessonlens.operators.scope import (NO_SCOPE, Params, active_centres, active_programs,
                                        active_projects, scope_filter)
from lessonlens.sources.fixtures import Sources


def _key(src: Sources, name: str) -> tuple:
    return (src.sf_dir, name)


def centre_programme(src: Sources, params: Params = NO_SCOPE) -> DataFrame:
    """Active centre -> its active projects -> programme name (left).

    Dimension-sized: centres x projects.
    """
    cp = scope_filter(src.centre_project, params, {"project_id": "project_id"})
    return (active_centres(src, params).join(cp, "centre_id")
            .join(active_projects(src, params), "project_id")
            .join(active_programs(src), "program_id", "left")
            .select("program_name", "project_id", "project_name", "centre_id", "ple_enabled")
            .distinct())


def user_batches(users: DataFrame) -> DataFrame:
    """Distinct (user, batch, centre) for users with a batch."""
    return (users.where(F.col("batch_id").isNotNull())
            .select("user_id", "batch_id", "centre_id").distinct())


def _phase_catalogue(src: Sources, params: Params) -> DataFrame:
    """Phase -> (name, project) for live phases, filtered by project / phase scope."""
    ph = src.phases.where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("phase_id"), F.col("name").alias("phase_name"))
    pp = scope_filter(src.phase_project, params, {"project_id": "project_id"})
    cat = ph.join(pp, "phase_id")
    return scope_filter(cat, params, {"phase_id": "phase_id"})


def _centre_phase(src: Sources) -> DataFrame:
    """Live centre-phase links for centres that exist."""
    ids = src.centres.select(F.col("id").alias("centre_id"))
    return (src.centre_phase.where(F.col("deleted_at").isNull())
            .join(ids, "centre_id", "left_semi").select("centre_id", "phase_id"))


def phase_batch(src: Sources, users: DataFrame, params: Params = NO_SCOPE) -> DataFrame:
    """User batch -> live batch -> batch phase -> centre phase (same centre) -> project.

    The batch-side catalogue (batch x phase x project) is dimension-sized and
    broadcast behind a size check; users keep their partitioning.
    """
    bp = (src.batches.where(F.col("deleted_at").isNull()).select(F.col("id").alias("batch_id"))
          .join(src.batch_phase.where(F.col("deleted_at").isNull()).select("batch_id", "phase_id"),
                "batch_id")
          .join(_phase_catalogue(src, params), "phase_id"))
    cat = bp.join(_centre_phase(src), "phase_id")
    ub = user_batches(users)
    return (ub.join(bounded_broadcast(cat, _key(src, ("batch_phase_cat", params))),
                    ["batch_id", "centre_id"])
            .select(F.col("phase_id").alias("p_phase_id"), F.col("batch_id").alias("p_batch_id"),
                    "phase_name", F.col("centre_id").alias("p_centre_id"),
                    F.col("project_id").alias("p_project_id"), F.col("user_id").alias("p_user_id")))


def phase_direct(src: Sources, users: DataFrame, params: Params = NO_SCOPE) -> DataFrame:
    """phase_users -> active learner -> centre phase on (centre, phase) -> project.

    One row per (phase, centre, project, user); restricted to learners/alumni.
    """
    pu = src.phase_users.where(F.col("deleted_at").isNull()).select("user_id", "phase_id")
    learners = users.where(F.col("user_type").isin(*C.LEARNER_TYPES)).select("user_id", "centre_id")
    cat = _phase_catalogue(src, params).join(_centre_phase(src), "phase_id")
    rows = (pu.join(learners, "user_id")
            .join(bounded_broadcast(cat, _key(src, ("direct_phase_cat", params))),
                  ["phase_id", "centre_id"]))
    return (rows.groupBy("phase_id", "centre_id", "project_id", "user_id")
            .agg(F.max("phase_name").alias("phase_name"))
            .select(F.col("phase_id").alias("p_phase_id"),
                    F.lit(None).cast("bigint").alias("p_batch_id"), "phase_name",
                    F.col("centre_id").alias("p_centre_id"),
                    F.col("project_id").alias("p_project_id"), F.col("user_id").alias("p_user_id")))


def phase_rows(src: Sources, users: DataFrame, params: Params = NO_SCOPE) -> DataFrame:
    """G4 + C10 + D17: distinct (user, programme, project, phase) rows.

    Users are expanded to the projects of their centre (broadcast, dimension
    sized), then left-joined to their phase rows on (user, centre, project)
    with the NULL-tolerant batch condition as a residual predicate: a direct
    phase row (no batch) matches any user, a batch row only the same batch.
    The phase rows of a partition's users (bounded by the phase catalogue) are hashed.
    """
    phases = phase_batch(src, users, params).unionByName(phase_direct(src, users, params))
    cp = centre_programme(src, params)
    u = users.select("user_id", "centre_id", "batch_id").join(
        bounded_broadcast(cp, _key(src, ("centre_programme", params))), "centre_id")
    cond = ((F.col("p_user_id") == F.col("user_id")) & (F.col("p_centre_id") == F.col("centre_id"))
            & (F.col("p_project_id") == F.col("project_id"))
            & (F.col("p_batch_id").isNull() | (F.col("p_batch_id") == F.col("batch_id"))))
    return (u.join(phases.hint("shuffle_hash"), cond, "left")
            .select("user_id", "program_name", "project_id", "project_name", "p_phase_id",
                    "phase_name")
            .distinct())


def project_combos(src: Sources, users: DataFrame, params: Params = NO_SCOPE) -> DataFrame:
    """Per user, the sorted array of {programme, project, phase} entries."""
    item = F.struct(F.col("program_name").alias("prog_name"), F.col("project_id"),
                    F.col("project_name").alias("proj_name"), F.col("p_phase_id"),
                    F.col("phase_name").alias("phase"))
    return (phase_rows(src, users, params).groupBy("user_id")
            .agg(F.array_sort(F.collect_list(item)).alias("project_combos")))


def main_centres(src: Sources, program_ids, registered_since: str) -> DataFrame:
    """J18 (P12): active centres of the given programmes (active project), without
    test/demo names, ranked by distinct active learners registered since a date."""
    from lessonlens.functions.columns import is_active

    c = (src.centres.where(is_active() & ~F.lower("name").like("%test%")
                           & ~F.lower("name").like("%demo%"))
         .select(F.col("id").alias("centre_id")))
    prj = (src.projects.where(is_active() & F.col("program_id").isin(*program_ids))
           .join(src.programs.select(F.col("id").alias("program_id")), "program_id")
           .select(F.col("id").alias("project_id")))
    cp = src.centre_project.join(prj, "project_id").select("centre_id").distinct()
    u = (src.users.where(is_active() & F.col("type").isin(*C.LEARNER_TYPES)
                         & (F.col("created_at") >= F.to_timestamp_ntz(F.lit(registered_since))))
         .select(F.col("id").alias("user_id"), "centre_id"))
    return (u.join(c, "centre_id").join(cp, "centre_id", "left_semi")
            .groupBy(F.col("centre_id").alias("id"))
            .agg(F.countDistinct("user_id").cast("bigint").alias("user_count"))
            .orderBy(F.col("user_count").desc(), F.col("id")))
