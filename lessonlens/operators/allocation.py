"""Allocation engine: which lessons each active user should do.

Plan shape (the same at any scale):

* users are never joined to a centre x lesson product.  They are joined to
  ``centre_subject`` (size: centres x subjects) and then to the lesson
  catalogue (size: lessons), both broadcast behind a row-count check, so the
  user x lesson fan-out is produced map-side without a shuffle;
* the three paths (non-PLE, PLE, staff) are one pass with a per-row path
  column, not three unioned branches, so each dimension is broadcast once;
* batch / trade / career-path gates are applied at user x subject grain,
  before the fan-out to lessons;
* lesson attributes (type, flags, exclusion) are computed once on the
  catalogue; the type exclusion is moved ahead of the de-duplication because
  the type is a function of the lesson alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.config import DEFAULT, Constants
from lessonlens.functions.columns import (assessment_flag, is_active, staff_access,
                                          toolkit_type, type_not_excluded, year_gate)
from lessonlens.operators.joins import bounded_broadcast, dimension_join, gate_join, row_count
from lessonlens.operators.scope import NO_SCOPE, Params
from lessonlens.sources.fixtures import Sources

ALLOCATION_COLUMNS = [
    "user_id", "user_name", "user_type", "centre_id", "project_id", "batch_id", "trade_id",
    "career_path_id", "career_path_name", "career_path_updated_at", "is_master_trainer",
    "subject_id", "subject_name", "subject_is_ple", "ple_career_path_id", "year_to_map",
    "subject_order", "lesson_id", "lesson_name", "lesson_order", "lesson_type", "is_assessment",
    "toolkit_type", "trade_duration", "allocation_path",
]


def _key(src: Sources, name: str) -> tuple:
    return (src.sf_dir, name)


# -- E1 ------------------------------------------------------------------------
def latest_career_path(src: Sources, keys: DataFrame | None = None) -> DataFrame:
    """Latest active career-path row per user (``updated_at`` desc, then id desc).

    An aggregate (``max`` of an ordering struct) instead of a window: it
    combines map-side, so a user with a huge history never lands whole in
    one task.  ``keys`` (bounded, ``user_id``) restrict a scoped run's history first.
    """
    p = src.ple_career_path_user.where((F.col("status") == 1) & F.col("deleted_at").isNull())
    if keys is not None:
        p = p.join(F.broadcast(keys), "user_id", "left_semi")
    best = F.max(F.struct(F.col("updated_at").alias("ts"), F.col("id").alias("rid"),
                          F.col("job_type_id").alias("job")))
    return (p.groupBy("user_id").agg(best.alias("b"))
            .select("user_id", F.col("b.job").alias("job_type_id"),
                    F.col("b.ts").alias("career_path_updated_at")))


# -- B7 + B8 + B9 + B10: lesson catalogue ------------------------------------------
def eligible_lessons(src: Sources, learner: bool, consts: Constants = DEFAULT,
                     excluded_types=None) -> DataFrame:
    """Active lessons of the fixed category with their type name and flags.

    ``learner=True`` adds ``student_access = 1``.  ``excluded_types`` (default:
    the fixed list) is applied here; pass ``()`` to keep every type.
    """
    excluded = consts.excluded_lesson_types if excluded_types is None else excluded_types
    lt = src.lesson_types.select(F.col("id").alias("lesson_type_id"),
                                 F.col("name").alias("lesson_type"))
    lessons = src.lessons.where(is_active() & (F.col("lesson_category_id") == consts.lesson_category_id))
    if learner:
        lessons = lessons.where(F.col("student_access") == 1)
    return (lessons.join(bounded_broadcast(lt, _key(src, "lesson_types")), "lesson_type_id", "left")
            .where(type_not_excluded("lesson_type", excluded))
            .select("subject_id", F.col("id").alias("lesson_id"), F.col("name").alias("lesson_name"),
                    "lesson_order", "lesson_type",
                    assessment_flag("is_assessment", "name").alias("is_assessment"),
                    toolkit_type().alias("toolkit_type"),
                    "student_access", "facilitator_access", "mastertrainer_access"))


def catalogue_rows(src: Sources, consts: Constants = DEFAULT, excluded_types=None) -> int:
    """Number of lessons that one user can be allocated."""
    return row_count(eligible_lessons(src, False, consts, excluded_types), _key(src, ("lessons_any", excluded_types)))


def _user_subjects(src: Sources, users: DataFrame, params: Params,
                   consts: Constants = DEFAULT) -> DataFrame:
    """Active users x their centre's active subjects (+ trade duration).

    ``centre_subject`` grows with centres x subjects: broadcast while bounded,
    a salted shuffle join beyond (one centre may hold a third of the users).
    """
    subj = (src.subjects.where(is_active())
            .select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name"),
                    F.col("is_ple").alias("subject_is_ple"), "ple_career_path_id", "year_to_map"))
    if params.subject_id is not None:
        subj = subj.where(F.col("subject_id") == params.subject_id)
    cs = (src.centre_subject.join(subj, "subject_id")
          .select("centre_id", "subject_id", "subject_order", "subject_name", "subject_is_ple",
                  "ple_career_path_id", "year_to_map"))
    trades = src.trades.select(F.col("id").alias("trade_id"), F.col("duration").alias("trade_duration"))
    us = dimension_join(users, cs, ["centre_id"], "inner", _key(src, "centre_subject_active"),
                        consts.broadcast_row_limit)
    return us.join(bounded_broadcast(trades, _key(src, "trades")), "trade_id", "left")


# -- J1 / J2: the three allocation paths in one pass ------------------------------------
def _path() -> "F.Column":
    t, ple = F.col("user_type"), F.col("is_ple")
    learner = t.isin(*C.LEARNER_TYPES)
    return (F.when(learner & (ple.isNull() | (ple != 1)), C.PATH_NON_PLE)
            .when(learner & (ple == 1), C.PATH_PLE)
            .when(t.isin(*C.STAFF_TYPES), C.PATH_STAFF))


def alloc_paths(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
                consts: Constants = DEFAULT, ple_rule: str = "strict",
                excluded_types=None, dedup: bool = False,
                keys: DataFrame | None = None) -> DataFrame:
    """All three allocation paths (non-PLE, PLE, staff) as one relation (G1).

    Each user row gets its path from type and PLE flag; the path decides which
    subject gates apply (batch / trade / career-path mapping / year) and which
    lesson access flag counts.  One pass instead of three unioned branches:
    every dimension is broadcast once and the users keep their ``user_id``
    partitioning; the latest career path is joined on that partitioning.
    """
    if ple_rule not in ("strict", "loose"):
        raise ValueError(ple_rule)
    path = F.col("allocation_path")
    paths = (src.ple_career_paths.where(F.col("deleted_at").isNull())
             .select(F.col("id").alias("job_type_id"), F.col("id").alias("career_path_id"),
                     F.col("name").alias("career_path_name")))
    latest = (latest_career_path(src, keys)
              .join(bounded_broadcast(paths, _key(src, "ple_career_paths")), "job_type_id", "left")
              .select("user_id", "career_path_id", "career_path_name", "career_path_updated_at"))
    u = users.withColumn("allocation_path", _path()).where(path.isNotNull())
    u = u.join(latest.hint("shuffle_hash"), "user_id", "left")     # one row per user: hashed at any size
    us = _user_subjects(src, u, params, consts)
    spcp = src.subject_ple_career_path.select(F.col("ple_career_path_id").alias("career_path_id"),
                                              "subject_id")
    us = gate_join(us, spcp, ["career_path_id", "subject_id"], "_map",
                   _key(src, "subject_ple_career_path"))
    us = gate_join(us, src.batch_subject, ["batch_id", "subject_id"], "_bs", _key(src, "batch_subject"))
    us = gate_join(us, src.subject_trade, ["trade_id", "subject_id"], "_st", _key(src, "subject_trade"))
    s_ple, cp = F.col("subject_is_ple"), F.col("career_path_id")
    batch_ok = F.col("batch_id").isNull() | F.col("_bs").isNotNull()
    trade_ok = F.col("trade_id").isNull() | F.col("_st").isNotNull()
    mapped = cp.isNotNull() & F.col("_map").isNotNull()
    if ple_rule == "loose":
        mapped = cp.isNull() | (s_ple == 0) | F.col("_map").isNotNull()
    keep = (((path == C.PATH_NON_PLE) & s_ple.isin(0, 2) & batch_ok & trade_ok & year_gate())
            | ((path == C.PATH_PLE) & s_ple.isin(0, 1) & mapped & batch_ok & year_gate())
            | ((path == C.PATH_STAFF) & s_ple.isin(0, 1, 2)))
    us = us.where(keep)
    if dedup:
        us = _dedup_subjects(us)
    lessons = eligible_lessons(src, False, consts, excluded_types)
    rows = us.join(bounded_broadcast(lessons, _key(src, ("lessons_any", excluded_types))), "subject_id")
    learner_path = path.isin(C.PATH_NON_PLE, C.PATH_PLE)
    rows = rows.where((learner_path & (F.col("student_access") == 1))
                      | ((path == C.PATH_STAFF) & staff_access()))
    staff, ple_p = path == C.PATH_STAFF, path == C.PATH_PLE
    null = lambda t: F.lit(None).cast(t)
    return rows.select(
        "user_id", "user_name", "user_type", "centre_id", "project_id",
        F.when(~staff, F.col("batch_id")).alias("batch_id"),
        F.when(path == C.PATH_NON_PLE, F.col("trade_id")).alias("trade_id"),
        F.when(ple_p, cp).alias("career_path_id"),
        F.when(ple_p, F.col("career_path_name")).alias("career_path_name"),
        F.when(ple_p, F.col("career_path_updated_at")).alias("career_path_updated_at"),
        "is_master_trainer", "subject_id", "subject_name", "subject_is_ple", "ple_career_path_id",
        "year_to_map", "subject_order", "lesson_id", "lesson_name", "lesson_order", "lesson_type",
        "is_assessment", "toolkit_type",
        F.when(~staff, F.col("trade_duration")).alias("trade_duration"),
        "allocation_path")


def alloc_non_ple(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
                  consts: Constants = DEFAULT, excluded_types=None) -> DataFrame:
    """Learners/alumni that are not PLE: centre subjects gated by batch, trade, year."""
    return (alloc_paths(src, users, params, consts, "strict", excluded_types)
            .where(F.col("allocation_path") == C.PATH_NON_PLE))


def alloc_ple(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
              consts: Constants = DEFAULT, rule: str = "strict", excluded_types=None) -> DataFrame:
    """PLE learners/alumni.

    ``rule="strict"`` (current): a live career path is required and every
    subject must be mapped to it.  ``rule="loose"`` (variant P2): a user
    without a path, or a general subject (``is_ple = 0``), passes unmapped.
    """
    return (alloc_paths(src, users, params, consts, rule, excluded_types)
            .where(F.col("allocation_path") == C.PATH_PLE))


def alloc_staff(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
                consts: Constants = DEFAULT, excluded_types=None) -> DataFrame:
    """Admins all lessons; facilitators / master trainers by their access flag."""
    return (alloc_paths(src, users, params, consts, "strict", excluded_types)
            .where(F.col("allocation_path") == C.PATH_STAFF))


# -- G1 + E2: union and de-duplication --------------------------------------------------
def alloc_union(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
                consts: Constants = DEFAULT, ple_rule: str = "strict",
                excluded_types=None) -> DataFrame:
    """G1: the union of the three paths (built as one relation, see ``alloc_paths``)."""
    return alloc_paths(src, users, params, consts, ple_rule, excluded_types)


def _dedup_subjects(us: DataFrame) -> DataFrame:
    """E2 at user x subject grain (before the lesson fan-out).

    A lesson belongs to one subject, so duplicate (user, lesson) rows can only
    come from duplicate (user, subject) rows (duplicate profiles or mapping
    rows) that passed the gates; each of those yields the same lessons, and the
    window's ordering keys (career-path time, lesson order) tie within them.
    Picking one (user, subject) row by the same tie-break therefore equals the
    per-lesson de-duplication, on ~20x fewer rows.
    """
    w = Window.partitionBy("user_id", "subject_id").orderBy(
        F.col("career_path_updated_at").desc_nulls_last(), F.col("subject_order").asc_nulls_first(),
        F.col("batch_id").asc_nulls_first(), F.col("trade_id").asc_nulls_first(),
        F.col("career_path_id").asc_nulls_first())
    return us.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def alloc_dedup(allocation: DataFrame) -> DataFrame:
    """One row per (user, lesson): latest career path first, then lowest lesson order.

    Remaining columns complete the order so the choice is deterministic when
    duplicate profiles or mappings produce copies.
    """
    w = Window.partitionBy("user_id", "lesson_id").orderBy(
        F.col("career_path_updated_at").desc_nulls_last(), F.col("lesson_order").asc_nulls_first(),
        F.col("subject_order").asc_nulls_first(), F.col("subject_id").asc_nulls_first(),
        F.col("batch_id").asc_nulls_first(), F.col("trade_id").asc_nulls_first(),
        F.col("career_path_id").asc_nulls_first())
    return (allocation.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def allocation(src: Sources, users: DataFrame, params: Params = NO_SCOPE,
               consts: Constants = DEFAULT, ple_rule: str = "strict",
               excluded_types=None, keys: DataFrame | None = None) -> DataFrame:
    """J1/J2 + E2 + B8: the de-duplicated, type-filtered allocation (one row per
    user x lesson), de-duplicated at subject grain before the fan-out."""
    return alloc_paths(src, users, params, consts, ple_rule, excluded_types, dedup=True, keys=keys)
