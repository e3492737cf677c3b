"""Registered queries: ``key -> fn(spark, sf_dir) -> DataFrame``.

Nested products are exposed in comparable form: scalar columns plus array
sizes, and separate keys with the arrays inlined (one row per element).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lessonlens.functions import ids as IDS
from lessonlens.functions import json_text as JT
from lessonlens.functions.columns import (batch_status_label, first_slot, is_active, is_inactive,
                                          user_type_label, year_gate, yes_no_label)
from lessonlens.operators import addon as AD
from lessonlens.operators import allocation as A
from lessonlens.operators import assessment as AS
from lessonlens.operators import completion as CMP
from lessonlens.operators import diagnostics as DG
from lessonlens.operators import filters as FL
from lessonlens.operators import kpi as KPI
from lessonlens.operators import programme as PG
from lessonlens.operators import quality as DQ
from lessonlens.operators import rollup as R
from lessonlens.operators.scope import Params
from lessonlens.plans.products import SNAPSHOT_COLUMNS, Pipeline
from lessonlens.session import tune
from lessonlens.sources import history as HIST
from lessonlens.sources import registry as REG
from lessonlens.sources import sinks as SINKS
from lessonlens.sources.fixtures import sources_for
from lessonlens.sources.versions import VersionedTable
from lessonlens.streaming import incremental as INC

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Scope values used by the scope_* keys (ids of the fixture tables).
SCOPE_VALUES = {"centre_id": 7, "user_id": 3, "batch_id": 70, "trade_id": 2, "subject_id": 12,
                "project_id": 5, "program_id": 0, "phase_id": 4}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_PIPELINES: dict[tuple, Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str, **kw) -> Pipeline:
    """The run's Pipeline for (session, sources, scope, rule, constants).

    One Pipeline per configuration and session, as in a run that builds every
    product: the checkpointed, user-partitioned active users and the declared
    allocation / completion plan are shared by all products built from it.
    Runs restricted to a key set (``user_keys``) always get their own.
    """
    tune(spark)
    src = sources_for(spark, sf_dir)
    if "user_keys" in kw:
        return Pipeline(src, **kw)
    key = (src.run, tuple(sorted(kw.items(), key=lambda x: x[0])))
    p = _PIPELINES.get(key)
    if p is None:
        p = _PIPELINES[key] = Pipeline(src, **kw)
    return p


def _size(c: str) -> F.Column:
    return F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.size(c)).cast("bigint")


# -- B2 / E1 / B7-B10 --------------------------------------------------------------
@register("active_users")
def q_active_users(spark, sf):
    return pipeline(spark, sf).users


@register("latest_career_path")
def q_latest_career_path(spark, sf):
    return A.latest_career_path(pipeline(spark, sf).src)


@register("lesson_flags")
def q_lesson_flags(spark, sf):
    src = pipeline(spark, sf).src
    return A.eligible_lessons(src, learner=False, excluded_types=()).select(
        "lesson_id", "is_assessment", "toolkit_type")


@register("eligible_lessons")
def q_eligible_lessons(spark, sf):
    src = pipeline(spark, sf).src
    return A.eligible_lessons(src, learner=True).select(
        "lesson_id", "subject_id", "lesson_name", "lesson_order", "lesson_type", "is_assessment",
        "toolkit_type")


# -- J1 / J2 / G1 / E2 / B8 ---------------------------------------------------------
@register("alloc_non_ple")
def q_alloc_non_ple(spark, sf):
    p = pipeline(spark, sf)
    return A.alloc_non_ple(p.src, p.users)


@register("alloc_ple")
def q_alloc_ple(spark, sf):
    p = pipeline(spark, sf)
    return A.alloc_ple(p.src, p.users)


@register("alloc_ple_loose")
def q_alloc_ple_loose(spark, sf):
    p = pipeline(spark, sf)
    return A.alloc_ple(p.src, p.users, rule="loose")


@register("alloc_staff")
def q_alloc_staff(spark, sf):
    p = pipeline(spark, sf)
    return A.alloc_staff(p.src, p.users)


@register("alloc_union")
def q_alloc_union(spark, sf):
    p = pipeline(spark, sf)
    return A.alloc_union(p.src, p.users)


@register("alloc_dedup")
def q_alloc_dedup(spark, sf):
    return pipeline(spark, sf).allocation


def _types(spark, sf, excluded):
    return (pipeline(spark, sf, excluded_types=excluded).allocation
            .select("user_id", "lesson_id", "lesson_type"))


@register("exclude_types_default")
def q_exclude_default(spark, sf):
    return _types(spark, sf, None)


@register("exclude_types_none")
def q_exclude_none(spark, sf):
    return _types(spark, sf, ())


@register("exclude_types_custom")
def q_exclude_custom(spark, sf):
    return _types(spark, sf, ("quiz", "video"))


@register("year_gate")
def q_year_gate(spark, sf):
    p = pipeline(spark, sf)
    u = p.users.where(F.col("user_type").isin(3, 4)
                      & (F.col("is_ple").isNull() | (F.col("is_ple") != 1)))
    us = A._user_subjects(p.src, u, p.params).where(F.col("subject_is_ple").isin(0, 2))
    return us.select("user_id", "subject_id", "year_to_map", "trade_duration",
                     F.when(year_gate(), 1).otherwise(0).alias("year_ok"))


# -- D1 / E3 / C9 ---------------------------------------------------------------------
@register("completion_learner")
def q_completion_learner(spark, sf):
    p = pipeline(spark, sf)
    return CMP.completion(p.src, p.users, CMP.LEARNER)


@register("completion_staff")
def q_completion_staff(spark, sf):
    p = pipeline(spark, sf)
    return CMP.completion(p.src, p.users, CMP.STAFF)


@register("completion_dedup")
def q_completion_dedup(spark, sf):
    p = pipeline(spark, sf)
    return CMP.completion_dedup(p.src, p.users)


@register("merged")
def q_merged(spark, sf):
    return pipeline(spark, sf).merged


# -- D2-D10, J4, J5 -----------------------------------------------------------------
@register("user_summary")
def q_user_summary(spark, sf):
    return R.user_summary(pipeline(spark, sf).merged)


@register("subject_allocation")
def q_subject_allocation(spark, sf):
    return R.subject_allocation(pipeline(spark, sf).merged)


@register("subject_completion")
def q_subject_completion(spark, sf):
    return R.subject_completion(pipeline(spark, sf).merged)


@register("completed_rows")
def q_completed_rows(spark, sf):
    return R.completed_rows(pipeline(spark, sf).merged).select(
        "user_id", "subject_id", "lesson_id", "score", "rating", "duration", *R.TOTALS,
        "completion_pct", "subj_total_allocated", "subj_lessons_allocated",
        "subj_assessments_allocated", "subj_total_completed", "subj_lessons_completed",
        "subj_assessments_completed")


@register("zero_completion_rows")
def q_zero_completion_rows(spark, sf):
    return R.zero_completion_rows(pipeline(spark, sf).merged).select(
        "user_id", "subject_id", "subject_name", "subject_order", "year_to_map", "allocation_path")


@register("lesson_output")
def q_lesson_output(spark, sf):
    return R.lesson_output(pipeline(spark, sf).merged).select("user_id", "subject_id", "lesson_id", "completed")


@register("subject_output")
def q_subject_output(spark, sf):
    s = R.subject_stats(pipeline(spark, sf).merged)
    any_done = F.max("subj_total_completed").over(Window.partitionBy("user_id"))
    return (s.withColumn("_u", any_done)
            .where((F.col("_u") == 0) | (F.col("subj_total_completed") > 0))
            .select("user_id", "subject_id", "subject_name", "year_to_map",
                    "subj_total_allocated", "subj_lessons_allocated", "subj_assessments_allocated",
                    "subj_total_completed", "subj_lessons_completed", "subj_assessments_completed",
                    "avg_score", "avg_rating", F.round("avg_duration", 4).alias("avg_duration"), "total_duration"))


def _combos_inline(merged: DataFrame) -> DataFrame:
    return (R.subject_combos(merged).where(F.col("subject_combos").isNotNull())
            .select("user_id", F.inline("subject_combos")))


@register("subject_combos")
def q_subject_combos(spark, sf):
    return _combos_inline(pipeline(spark, sf).merged)


@register("project_combos")
def q_project_combos(spark, sf):
    p = pipeline(spark, sf)
    return PG.project_combos(p.src, p.users).select("user_id", F.inline("project_combos"))


@register("one_user_row")
def q_one_user_row(spark, sf):
    return R.one_user_row(pipeline(spark, sf).users)


_SNAPSHOTS: dict[str, DataFrame] = {}


def stored_snapshot(p: Pipeline) -> DataFrame:
    """The snapshot as a stored table: built once for its sources and read back, column-pruned, by the
    products that start from it.  Other sources (a later state of the tables) have their own."""
    src = p.src
    if src.run not in _SNAPSHOTS:
        path = src.derived_at("user_snapshot")
        p.user_snapshot().write.mode("overwrite").parquet(path)
        _SNAPSHOTS[src.run] = src.spark.read.parquet(path)
    return _SNAPSHOTS[src.run]


def _snapshot_flat(p: Pipeline) -> DataFrame:
    s = p.user_snapshot()
    return s.select(*[c for c in SNAPSHOT_COLUMNS if not c.endswith("_combos")],
                    _size("project_combos").alias("n_project_combos"),
                    _size("subject_combos").alias("n_subject_combos"))


@register("user_snapshot")
def q_user_snapshot(spark, sf):
    return _snapshot_flat(pipeline(spark, sf))


@register("user_snapshot_loose")
def q_user_snapshot_loose(spark, sf):
    return _snapshot_flat(pipeline(spark, sf, ple_rule="loose"))


@register("lesson_progress")
def q_lesson_progress(spark, sf):
    return pipeline(spark, sf).lesson_progress()


@register("subject_progress")
def q_subject_progress(spark, sf):
    sp = pipeline(spark, sf).subject_progress()
    return sp.select(*[c for c in sp.columns if c != "lessons"], _size("lessons").alias("n_lessons"))


@register("subject_lessons")
def q_subject_lessons(spark, sf):
    """The nested lessons of the subject product, one row each."""
    sp = pipeline(spark, sf).subject_progress()
    return sp.select("user_id", "subject_id", "batch_id", F.inline("lessons"))


@register("subject_combos_loose")
def q_subject_combos_loose(spark, sf):
    return _combos_inline(pipeline(spark, sf, ple_rule="loose").merged)


@register("no_allocation_users")
def q_no_allocation_users(spark, sf):
    p = pipeline(spark, sf)
    return (p.users.select("user_id").distinct()
            .join(p.allocation.select("user_id"), "user_id", "left_anti"))


# -- C27-C29, D17, D18 ---------------------------------------------------------------
@register("centre_programme")
def q_centre_programme(spark, sf):
    return PG.centre_programme(pipeline(spark, sf).src)


@register("user_batches")
def q_user_batches(spark, sf):
    return PG.user_batches(pipeline(spark, sf).users)


@register("phase_batch")
def q_phase_batch(spark, sf):
    p = pipeline(spark, sf)
    return PG.phase_batch(p.src, p.users)


@register("phase_direct")
def q_phase_direct(spark, sf):
    p = pipeline(spark, sf)
    return PG.phase_direct(p.src, p.users)


@register("phase_rows")
def q_phase_rows(spark, sf):
    p = pipeline(spark, sf)
    return PG.phase_rows(p.src, p.users)


# -- B1: scoped runs ------------------------------------------------------------------
def _scoped_merged(spark, sf, field):
    p = pipeline(spark, sf, params=Params(**{field: SCOPE_VALUES[field]}))
    return p.merged.select("user_id", "subject_id", "lesson_id", "completed")


def _scoped_phase(spark, sf, field):
    p = pipeline(spark, sf, params=Params(**{field: SCOPE_VALUES[field]}))
    return PG.phase_rows(p.src, p.users, p.params)


for _f in ("centre_id", "user_id", "batch_id", "trade_id", "subject_id"):
    register("scope_" + _f[:-3])(lambda spark, sf, _f=_f: _scoped_merged(spark, sf, _f))
for _f in ("project_id", "program_id", "phase_id"):
    register("scope_" + _f[:-3])(lambda spark, sf, _f=_f: _scoped_phase(spark, sf, _f))


# -- P5 / P6 / P7 / J11 -----------------------------------------------------------------

DASH_COLUMN_FILTERS = {"state_name": ["AFRICA", "EUROPE", "ASIA"], "gender": ["Male", "Female"],
                       "user_type": ["Learner", "Alumni"]}
DASH_SLOT_FILTERS = {"phase": ["Phase_2", "Phase_4"], "sub_name": ["Brand#12", "Brand#23", "Brand#34"],
                     "year_category": [1, 2]}


@register("user_addon")
def q_user_addon(spark, sf):
    return AD.user_addon(pipeline(spark, sf).src)


@register("first_login")
def q_first_login(spark, sf):
    return AD.first_login(pipeline(spark, sf).src)


@register("labels")
def q_labels(spark, sf):
    p = pipeline(spark, sf)
    snap = stored_snapshot(p).select("user_id", "user_type", "is_ple")
    return (snap.join(AD.user_addon(p.src), "user_id", "left")
            .select("user_id", user_type_label().alias("user_type_e"),
                    yes_no_label("is_ple", ("PLE", "Non-PLE")).alias("is_ple_e"),
                    yes_no_label("ple_enabled", ("PLE Centre", "Non-PLE Centre")).alias("ple_enabled_e"),
                    batch_status_label().alias("batch_status_e")))


@register("first_slot")
def q_first_slot(spark, sf):
    snap = stored_snapshot(pipeline(spark, sf)).where(F.col("project_combos").isNotNull())
    return snap.select("user_id", first_slot("project_combos", "prog_name").alias("prog_name"),
                       first_slot("project_combos", "proj_name").alias("proj_name"),
                       first_slot("project_combos", "phase").alias("phase"))


@register("filter_dims")
def q_filter_dims(spark, sf):
    p = pipeline(spark, sf)
    return FL.filter_dims(stored_snapshot(p), AD.user_addon(p.src), p.consts)


def _dash(spark, sf, filters=None):
    p = pipeline(spark, sf)
    d = FL.dash_dataset(stored_snapshot(p), AD.user_addon(p.src), p.consts, filters)
    return d.select(*[F.col(c).cast("bigint").alias(c) if c == "rounded_completion" else c
                      for c in d.columns if not c.endswith("_combos")],
                    _size("project_combos").alias("n_project_combos"),
                    _size("subject_combos").alias("n_subject_combos"))


@register("dash_dataset")
def q_dash_dataset(spark, sf):
    return _dash(spark, sf)


@register("dash_column_filters")
def q_dash_column_filters(spark, sf):
    return _dash(spark, sf, DASH_COLUMN_FILTERS)


# every filter of the dashboard, each leaving some users out
DASH_ALL_FILTERS = {
    "state_name": ["AFRICA", "MIDDLE EAST"], "district_name": [f"NATION_{k}" for k in range(20)],
    "centre_type": ["Type 0", "Type 1"], "trade": [f"Trade {k}" for k in range(6)],
    "centre_name": [f"NATION_{k}" for k in range(1, 21)], "org_name": ["AFRICA", "MIDDLE EAST"],
    "user_type": ["Learner", "Alumni", "Admin"], "gender": ["Female", "Other"],
    "ple_enabled": ["PLE Centre", "Non-PLE Centre"], "is_ple": ["Non-PLE", "PLE"], "prog_name": ["Program A", "Program B"],
    "proj_name": [f"Project NATION_{k}" for k in range(1, 19)], "phase": [f"Phase_{k}" for k in range(1, 5)],
    "sub_name": [f"Brand#{k}" for k in range(11, 56)], "year_category": [0, 1, 2, 3]}


@register("dash_all_filters")
def q_dash_all_filters(spark, sf):
    return _dash(spark, sf, DASH_ALL_FILTERS)


@register("dash_any_slot")
def q_dash_any_slot(spark, sf):
    return _dash(spark, sf, DASH_SLOT_FILTERS)


def _export(p: Pipeline) -> DataFrame:
    return AD.lesson_export(p.lesson_progress(), p.src, AD.user_addon(p.src))


@register("lesson_export")
def q_lesson_export(spark, sf):
    return _export(pipeline(spark, sf))


@register("export_missing_users")
def q_export_missing_users(spark, sf):
    p = pipeline(spark, sf)
    requested = p.src.users.select(F.col("id").alias("user_id"))
    return AD.export_missing_users(requested, p.lesson_progress())


@register("lesson_type_dist")
def q_lesson_type_dist(spark, sf):
    return (_export(pipeline(spark, sf)).groupBy("lesson_type")
            .agg(F.count(F.lit(1)).alias("rows")))


# -- 2I incremental maintenance, A2-A4, A7, B15, D22, F3 ---------------------------------

PINNED_CUTOFF = "2001-07-15 00:00:00"
SNAP_SCALARS = [c for c in SNAPSHOT_COLUMNS if not c.endswith("_combos")]


_PREVIOUS: dict[str, DataFrame] = {}


def previous_snapshot(p: Pipeline) -> DataFrame:
    """The existing target table the incremental keys start from (fixture, 2I).

    Derived once per session and written beside the source tables (it plays the
    snapshot table already stored in the warehouse); later calls read it back.
    """
    src = p.src
    if src.run not in _PREVIOUS:
        path = src.derived_at("previous_snapshot")
        _derive_previous_snapshot(Pipeline(src)).write.mode("overwrite").parquet(path)
        _PREVIOUS[src.run] = src.spark.read.parquet(path)
    return _PREVIOUS[src.run]


def _derive_previous_snapshot(p: Pipeline) -> DataFrame:
    """The snapshot without users ``id % 10 = 7`` (gap hits), with users ``id % 4 = 1`` still in their former
    centre (moved users), plus stale zero rows for every inactive user (cleanup hits)."""
    snap = stored_snapshot(p).where(F.col("user_id") % 10 != 7).withColumn(
        "centre_id", F.when(F.col("user_id") % 4 == 1, (F.col("centre_id") + 1) % 25).otherwise(F.col("centre_id")))
    u = (p.src.users.where(F.col("type").isin(1, 2, 3, 4) & is_inactive())
         .select(F.col("id").alias("user_id"), F.col("type").alias("user_type"), "centre_id",
                 "organisation_id", "is_ple", "created_at"))
    sd = p.src.student_details.select("user_id", "batch_id", "trade_id")
    stale = u.join(sd, "user_id", "left").select(
        *SNAP_SCALARS[:8], *[F.lit(0).cast("bigint").alias(c) for c in R.TOTALS],
        F.lit(0).cast("decimal(5,2)").alias("completion_pct"),
        F.lit(None).cast(snap.schema["project_combos"].dataType).alias("project_combos"),
        F.lit(None).cast(snap.schema["subject_combos"].dataType).alias("subject_combos"))
    return snap.unionByName(stale)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*SNAP_SCALARS, _size("project_combos").alias("n_project_combos"),
                     _size("subject_combos").alias("n_subject_combos"))


def _raw_ids(src, number: str | None = None) -> DataFrame:
    """A4 fixture: UUID text per customer, blank / NULL / malformed for key % 50 in 0, 1, 2; ``number`` names a
    column for the customer's own id."""
    c = F.col("c_custkey")
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(c.cast("string"), 12, "0"))
    return src.base("customer", "c_custkey").select(
        F.when(c % 50 == 0, F.lit("  ")).when(c % 50 == 1, F.lit(None).cast("string"))
         .when(c % 50 == 2, F.concat(F.lit("bad-"), c.cast("string"))).otherwise(uuid).alias("id"), *([c.cast("bigint").alias(number)] if number else []))


@register("watermark")
def q_watermark(spark, sf):
    return INC.watermark(previous_snapshot(pipeline(spark, sf)))


@register("changed_users")
def q_changed_users(spark, sf):
    p = pipeline(spark, sf)
    return INC.changed_users(p.src, INC.watermark_value(previous_snapshot(p)))


@register("changed_users_since")
def q_changed_users_since(spark, sf):
    return INC.changed_users(pipeline(spark, sf).src, INC.cutoff_literal("2001-07-15"))


@register("gap_users")
def q_gap_users(spark, sf):
    p = pipeline(spark, sf)
    return INC.gap_users(p.src, previous_snapshot(p))


def _refresh_keys(p: Pipeline, centre_id=None) -> DataFrame:
    prev = previous_snapshot(p)
    return INC.refresh_keys(p.src, prev, INC.watermark_value(prev), centre_id)


@register("refresh_keys")
def q_refresh_keys(spark, sf):
    return _refresh_keys(pipeline(spark, sf))


@register("refresh_keys_valid")
def q_refresh_keys_valid(spark, sf):
    p = pipeline(spark, sf)
    text = _raw_ids(p.src, "user_id").join(_refresh_keys(p), "user_id", "left_semi").select(F.col("id").alias("user_id"))
    valid, rejected = INC.valid_keys(text)
    return valid.withColumn("valid", F.lit(1)).unionByName(rejected.withColumn("valid", F.lit(0)))


@register("changed_users_centre")
def q_changed_users_centre(spark, sf):
    return _refresh_keys(pipeline(spark, sf), SCOPE_VALUES["centre_id"])


@register("changed_centres")
def q_changed_centres(spark, sf):
    return INC.changed_centres(pipeline(spark, sf).src, PINNED_CUTOFF)


@register("missing_centres")
def q_missing_centres(spark, sf):
    p = pipeline(spark, sf)
    target = INC.cleanup_inactive(p.src, previous_snapshot(p))
    wanted = p.src.centres.select(F.col("id").alias("centre_id"))
    return INC.missing_keys(wanted, target, "centre_id")


@register("refresh_users")
def q_refresh_users(spark, sf):
    p = pipeline(spark, sf)
    prev = previous_snapshot(p)
    keys = INC.refresh_keys(p.src, prev, INC.watermark_value(prev))
    return _flat(INC.refresh_users(p.src, prev, keys))


@register("refresh_centres")
def q_refresh_centres(spark, sf):
    p = pipeline(spark, sf)
    prev = previous_snapshot(p)
    return _flat(INC.refresh_centres(p.src, prev, INC.changed_centres(p.src, PINNED_CUTOFF)))


def _versioned_target(p: Pipeline) -> VersionedTable:
    """The previous snapshot as a stored table of its own, laid out by ``user_id``."""
    target = VersionedTable(p.src.spark, f"ll_snapshot_{uuid.uuid4().hex[:12]}", "user_id", 64)
    target.publish(previous_snapshot(p))
    return target


@register("refresh_users_stored")
def q_refresh_users_stored(spark, sf):
    p = pipeline(spark, sf)
    target, prev = _versioned_target(p), previous_snapshot(p)
    INC.refresh_users_in(target, p.src, INC.refresh_keys(p.src, prev, INC.watermark_value(prev)))
    return _flat(target.table())


@register("refresh_centres_stored")
def q_refresh_centres_stored(spark, sf):
    p = pipeline(spark, sf)
    target = _versioned_target(p)
    INC.refresh_centres_in(target, p.src, INC.changed_centres(p.src, PINNED_CUTOFF))
    return _flat(target.table())


@register("cleanup_stored")
def q_cleanup_stored(spark, sf):
    p = pipeline(spark, sf)
    target = _versioned_target(p)
    INC.cleanup_inactive_in(target, p.src)
    return _flat(target.table())


@register("replace_keys_user")
def q_replace_keys_user(spark, sf):
    p = pipeline(spark, sf)
    prev = previous_snapshot(p)
    scope = INC.gap_users(p.src, prev).unionByName(INC.inactive_users(p.src))
    fresh = Pipeline(p.src, user_keys=scope).user_snapshot()
    return _flat(INC.replace_keys(prev, fresh, scope, "user_id"))


@register("replace_keys_centre")
def q_replace_keys_centre(spark, sf):
    p = pipeline(spark, sf)
    prev = previous_snapshot(p)
    centres = INC.inactive_centres(p.src).unionByName(
        spark.range(1).select(F.lit(SCOPE_VALUES["centre_id"]).cast("bigint").alias("centre_id")))
    return _flat(INC.refresh_centres(p.src, prev, centres))


@register("cleanup_inactive")
def q_cleanup_inactive(spark, sf):
    p = pipeline(spark, sf)
    return _flat(INC.cleanup_inactive(p.src, previous_snapshot(p)))


@register("cleanup_preview")
def q_cleanup_preview(spark, sf):
    p = pipeline(spark, sf)
    return INC.cleanup_preview(p.src, previous_snapshot(p))


@register("inactive_keys")
def q_inactive_keys(spark, sf):
    src = pipeline(spark, sf).src
    return (INC.inactive_users(src).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"))
            .unionByName(INC.inactive_centres(src).select(F.lit("centre").alias("kind"),
                                                          F.col("centre_id").alias("id"))))


@register("users_per_key")
def q_users_per_key(spark, sf):
    src = pipeline(spark, sf).src
    return INC.users_per_key(src, src.centres.select("id"), "centre")


@register("limit_centres")
def q_limit_centres(spark, sf):
    return pipeline(spark, sf).src.centres.select("id").orderBy("id").limit(10)


@register("id_list")
def q_id_list(spark, sf):
    return IDS.id_list(_raw_ids(pipeline(spark, sf).src))


@register("validate_ids")
def q_validate_ids(spark, sf):
    ids = IDS.id_list(_raw_ids(pipeline(spark, sf).src))
    valid, rejected = IDS.validate_ids(ids)
    return (valid.withColumn("valid", F.lit(1)).unionByName(rejected.withColumn("valid", F.lit(0))))


@register("restrict_ids")
def q_restrict_ids(spark, sf):
    src = pipeline(spark, sf).src
    ids = src.phase_users.where(F.col("deleted_at").isNull()).select(F.col("user_id").alias("id"))
    return IDS.restrict_ids(src.learning_activities.select("user_id", "lesson_id", "completed"),
                            ids, "user_id")


# -- P8-P10 assessments ---------------------------------------------------------------------

# Fixture registration window (half-open) for the population filters.
POPULATION_WINDOW = ("1996-01-01 00:00:00", "1999-01-01 00:00:00")


def _cands(spark, sf, pop=AS.DEFAULT_POPULATION):
    p = pipeline(spark, sf)
    return p, AS.candidates(p.src, pop, p.consts)


def _all_users(p: Pipeline) -> DataFrame:
    return p.src.users.select(F.col("id").alias("user_id"))


@register("assessment_set")
def q_assessment_set(spark, sf):
    return AS.assessment_set(pipeline(spark, sf).src)


@register("be_candidates")
def q_be_candidates(spark, sf):
    return _cands(spark, sf)[1]


@register("first_baseline")
def q_first_baseline(spark, sf):
    return AS.first_baseline(_cands(spark, sf)[1])


@register("first_endline")
def q_first_endline(spark, sf):
    return AS.first_endline(_cands(spark, sf)[1])


@register("be_stage_attempts")
def q_be_stage_attempts(spark, sf):
    c = _cands(spark, sf)[1]
    return AS.stage_attempts(AS.first_baseline(c), AS.first_endline(c))


@register("be_status")
def q_be_status(spark, sf):
    c = _cands(spark, sf)[1]
    return AS.user_status(AS.stage_attempts(AS.first_baseline(c), AS.first_endline(c)))


@register("question_catalog")
def q_question_catalog(spark, sf):
    return AS.question_catalog(pipeline(spark, sf).src)


@register("be_translate")
def q_be_translate(spark, sf):
    cat = AS.question_catalog(pipeline(spark, sf).src)
    return AS.translation(cat).select("question_id", "assessment_id", "language_id",
                                      "question_position", "english_question_id")


@register("be_answer_keys")
def q_be_answer_keys(spark, sf):
    p, c = _cands(spark, sf)
    return AS.answer_keys(p.src, AS.paired_attempts(c))


@register("be_responses")
def q_be_responses(spark, sf):
    p = pipeline(spark, sf)
    return AS.responses(p.src, AS.DEFAULT_POPULATION, p.consts)


@register("be_centre_type")
def q_be_centre_type(spark, sf):
    p = pipeline(spark, sf)
    return AS.responses(p.src, AS.Population(centre_types=None), p.consts)


@register("be_paired_only")
def q_be_paired_only(spark, sf):
    p = pipeline(spark, sf)
    return AS.responses(p.src, AS.Population(paired_only=True), p.consts)


@register("duplicate_option_orders")
def q_duplicate_option_orders(spark, sf):
    return AS.duplicate_option_orders(pipeline(spark, sf).src)


@register("population_window")
def q_population_window(spark, sf):
    return AS.population_window(pipeline(spark, sf).src, POPULATION_WINDOW)


@register("be_user_status")
def q_be_user_status(spark, sf):
    p = pipeline(spark, sf)
    return AS.user_status_report(p.src, _all_users(p), p.consts)


@register("population_check")
def q_population_check(spark, sf):
    p = pipeline(spark, sf)
    return AS.population_check(p.src, _all_users(p), POPULATION_WINDOW)


@register("centre_type_dist")
def q_centre_type_dist(spark, sf):
    p = pipeline(spark, sf)
    return AS.centre_type_distribution(p.src, _all_users(p))


@register("attempt_counts")
def q_attempt_counts(spark, sf):
    p = pipeline(spark, sf)
    return AS.attempt_counts(p.src, _all_users(p), p.consts)


# -- 2K diagnostics, 2L KPIs, 2M quality, J18, B3 ------------------------------------------

MAIN_PROGRAM_IDS = (0, 1)
MAIN_REGISTERED_SINCE = "1996-01-01 00:00:00"


@register("debug_centre_status")
def q_debug_centre_status(spark, sf):
    return DG.centre_status(pipeline(spark, sf))


@register("debug_active_users")
def q_debug_active_users(spark, sf):
    return DG.active_users_by_type(pipeline(spark, sf))


@register("debug_subjects")
def q_debug_subjects(spark, sf):
    return DG.centre_subjects(pipeline(spark, sf))


@register("debug_lessons")
def q_debug_lessons(spark, sf):
    return DG.centre_lessons(pipeline(spark, sf))


@register("debug_non_ple")
def q_debug_non_ple(spark, sf):
    return DG.path_reach(pipeline(spark, sf), "non_ple")


@register("debug_staff")
def q_debug_staff(spark, sf):
    return DG.path_reach(pipeline(spark, sf), "staff")


@register("debug_ple")
def q_debug_ple(spark, sf):
    return DG.ple_reach(pipeline(spark, sf))


@register("debug_ple_paths")
def q_debug_ple_paths(spark, sf):
    return DG.ple_paths(pipeline(spark, sf))


@register("debug_activity")
def q_debug_activity(spark, sf):
    return DG.activity_by_centre(pipeline(spark, sf))


@register("debug_matched")
def q_debug_matched(spark, sf):
    return DG.matched_completions(pipeline(spark, sf))


@register("centre_totals")
def q_centre_totals(spark, sf):
    return DG.centre_totals(stored_snapshot(pipeline(spark, sf)))


@register("debug_flags")
def q_debug_flags(spark, sf):
    return DG.centre_flags(pipeline(spark, sf)).select("centre_id", F.explode("flags").alias("flag"))


def _dash_full(spark, sf) -> DataFrame:
    p = pipeline(spark, sf)
    return FL.dash_dataset(stored_snapshot(p), AD.user_addon(p.src), p.consts)


@register("kpi_headline")
def q_kpi_headline(spark, sf):
    return KPI.headline(_dash_full(spark, sf))


@register("kpi_lessons")
def q_kpi_lessons(spark, sf):
    return KPI.lessons(_dash_full(spark, sf))


@register("kpi_assessments")
def q_kpi_assessments(spark, sf):
    return KPI.assessments(_dash_full(spark, sf))


@register("kpi_completion_hist")
def q_kpi_completion_hist(spark, sf):
    return KPI.completion_hist(_dash_full(spark, sf))


@register("kpi_distributions")
def q_kpi_distributions(spark, sf):
    return KPI.distributions(_dash_full(spark, sf))


@register("kpi_monthly")
def q_kpi_monthly(spark, sf):
    return KPI.monthly(_dash_full(spark, sf))


@register("kpi_details")
def q_kpi_details(spark, sf):
    return KPI.details(_dash_full(spark, sf))


@register("kpi_top_subjects")
def q_kpi_top_subjects(spark, sf):
    return KPI.top_subjects(_dash_full(spark, sf))


@register("dq_checks")
def q_dq_checks(spark, sf):
    p = pipeline(spark, sf)
    return DQ.checks(stored_snapshot(p), p.src.centres, AD.user_addon(p.src), p.users)


@register("dq_centre_drop")
def q_dq_centre_drop(spark, sf):
    p = pipeline(spark, sf)
    prev = previous_snapshot(p)
    return DQ.centre_drop(INC.cleanup_inactive(p.src, prev), prev)


@register("audit_rows")
def q_audit_rows(spark, sf):
    return DQ.audit_rows(stored_snapshot(pipeline(spark, sf)), "fixture-run")


@register("run_drift")
def q_run_drift(spark, sf):
    """Two runs of the snapshot product: the second has lost a column, widened another and cleaned up."""
    p = pipeline(spark, sf)
    first = previous_snapshot(p).select(*SNAP_SCALARS)
    second = (INC.cleanup_inactive(p.src, first).drop("trade_id")
              .withColumn("user_type", F.col("user_type").cast("bigint")))
    history = f"ll_history_{uuid.uuid4().hex[:12]}"
    for run_id, day, df in (("run-1", 1, first), ("run-2", 2, second)):
        HIST.record_run(history, "user_snapshot", run_id, dt.datetime(2001, 7, day), df)
    return HIST.drift(spark.table(history), "user_snapshot", "run-2")


@register("schema_drift")
def q_schema_drift(spark, sf):
    """The learner log read under a declaration that it does not meet in three ways."""
    from pyspark.sql.types import StructType

    logs = pipeline(spark, sf).src.learning_activities
    met = REG.SCHEMAS["learning_activities"].replace("score decimal(10,2)", "score double").replace("completed int, ", "")
    return HIST.declared_drift(logs, StructType.fromDDL(met + ", device string"))


@register("choose_mode")
def q_choose_mode(spark, sf):
    """The mode of a run before and after its target is written, with the rows the target then has."""
    p = pipeline(spark, sf)
    name = f"ll_mode_{uuid.uuid4().hex[:12]}"
    modes = [SINKS.choose_mode(spark, name)]
    SINKS.write_replace(previous_snapshot(p).select("user_id"), name)
    modes.append(SINKS.choose_mode(spark, name))
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.lit(modes[0]).alias("before"), F.lit(modes[1]).alias("after"))


@register("null_normalise")
def q_null_normalise(spark, sf):
    """Learner logs with a ratio that is NaN where nothing was scored."""
    logs = pipeline(spark, sf).src.learning_activities
    ratio = (F.col("rating").cast("double") / F.when(F.col("score") == 0, float("nan")).otherwise(F.col("score").cast("double")))
    return (SINKS.null_normalise(logs.where(F.col("score").isNotNull()).select("completed", ratio.alias("ratio")))
            .groupBy("completed").agg(F.count(F.lit(1)).alias("rows"), F.count("ratio").alias("with_ratio")))


# -- H15 / H18 / H21 --------------------------------------------------------------------------
def _combos_text(p: Pipeline) -> DataFrame:
    """Snapshot users with their subjects as JSON text: cut short for ids % 13 = 0, NULL for % 17 = 0."""
    text = F.to_json("subject_combos", {"ignoreNullFields": "false"})
    u = F.col("user_id")
    return stored_snapshot(p).select("user_id", F.when(u % 17 == 0, None).when(u % 13 == 0, F.regexp_replace(text, ".{2}$", ""))
                                     .otherwise(text).alias("combos"))


@register("json_valid")
def q_json_valid(spark, sf):
    return _combos_text(pipeline(spark, sf)).select("user_id", JT.json_valid("combos").alias("valid"))


@register("json_table")
def q_json_table(spark, sf):
    p = pipeline(spark, sf)
    element = stored_snapshot(p).schema["subject_combos"].dataType.elementType.simpleString()
    return JT.inline_json(_combos_text(p), "combos", element, "user_id")[0]


@register("collated_join")
def q_collated_join(spark, sf):
    """Customers by nation, joined by a name that differs in case, accents and trailing blanks."""
    src = pipeline(spark, sf).src
    k, name = F.col("c_custkey") % 4, F.col("n_name")
    spelt = (F.when(k == 0, F.lower(name)).when(k == 1, F.translate(name, "AEI", "ÁÈÏ"))
             .when(k == 2, F.concat(F.initcap(name), F.lit("  "))).otherwise(name))
    nation = src.spark.read.parquet(f"{src.sf_dir.rstrip('/')}/nation.parquet").select("n_nationkey", "n_name")
    people = src.base("customer", "c_custkey", "c_nationkey").join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))      # 25 nations
    said = people.select(F.collate(spelt, REG.LOOSE).alias("code"))
    codes = nation.select(F.col("n_nationkey").cast("bigint").alias("nation_id"), F.collate("n_name", REG.LOOSE).alias("code"))
    return said.join(F.broadcast(codes), "code").groupBy("nation_id").agg(F.count(F.lit(1)).alias("customers"))


def _appended(p: Pipeline) -> DataFrame:
    """What an append-only refresh would leave: previous rows plus fresh rows of the keys."""
    prev = previous_snapshot(p)
    keys = INC.refresh_keys(p.src, prev, INC.watermark_value(prev))
    return prev.unionByName(Pipeline(p.src, user_keys=keys).user_snapshot())


@register("dup_users")
def q_dup_users(spark, sf):
    return DQ.dup_users(_appended(pipeline(spark, sf)))


@register("multi_centre_users")
def q_multi_centre_users(spark, sf):
    return DQ.multi_centre_users(_appended(pipeline(spark, sf)))


@register("main_centre_list")
def q_main_centre_list(spark, sf):
    return PG.main_centres(pipeline(spark, sf).src, MAIN_PROGRAM_IDS, MAIN_REGISTERED_SINCE)


@register("active_dims")
def q_active_dims(spark, sf):
    src = pipeline(spark, sf).src
    parts = [(n, getattr(src, n).where(is_active())) for n in
             ("centres", "organisations", "subjects", "lessons", "projects", "programs")]
    parts += [(n, getattr(src, n).where(F.col("deleted_at").isNull())) for n in
              ("batches", "phases", "ple_career_paths")]
    out = None
    for name, df in parts:
        d = df.select(F.lit(name).alias("dim"), F.col("id").cast("string").alias("id"))
        out = d if out is None else out.unionByName(d)
    return out
