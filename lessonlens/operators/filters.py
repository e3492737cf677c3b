"""Dashboard filter table (P6, J12) and dashboard dataset."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.config import DEFAULT, Constants
from lessonlens.functions.columns import (any_slot, first_slot, user_type_label, yes_no_label)

FILTER_DIM_GROUP = ["user_type_e", "is_ple_e", "rounded_completion", "gender", "centre_name",
                    "org_name", "state_name", "district_name", "trade", "batch_name",
                    "batch_status", "centre_type", "subject_name", "year_category", "proj_name",
                    "phase", "prog_name"]
FILTER_DIM_COLUMNS = ["user_type", "user_type_e", "is_ple", "is_ple_e", "ple_enabled",
                      "ple_enabled_e", "rounded_completion", "gender", "centre_name", "org_name",
                      "state_name", "district_name", "trade", "batch_name", "batch_status",
                      "centre_type", "subject_name", "year_category", "proj_name", "phase",
                      "prog_name"]
# Columns cast to int with NULL -> 0 after grouping.
FILTER_DIM_INT_COLUMNS = ["rounded_completion", "year_category", "batch_status"]

DASH_COLUMNS = ["tlo_users_id", "created_at", "user_type", "user_type_e", "ple_enabled_e",
                "is_ple_e", "is_ple", "project_combos", "a_overa_less_asses_c",
                "a_overa_assess_c", "a_overa_lesson_c", "c_overa_less_asses_c", "c_overa_asse_c",
                "c_overa_less_c", "rounded_completion", "user_name", "gender", "centre_name",
                "org_name", "state_name", "district_name", "trade", "batch_name", "batch_status",
                "centre_type", "platform", "ple_enabled", "first_login", "subject_combos",
                "is_master_trainer"]

# Widget name -> dataset column it filters.
COLUMN_FILTERS = {"state_name": "state_name", "district_name": "district_name",
                  "centre_type": "centre_type", "trade": "trade", "centre_name": "centre_name",
                  "org_name": "org_name", "user_type": "user_type_e", "gender": "gender",
                  "ple_enabled": "ple_enabled_e", "is_ple": "is_ple_e"}
# Widget name -> (array column, element field).  The subject widget
# matches ``subject_name`` and the year widget compares integers.
SLOT_FILTERS = {"prog_name": ("project_combos", "prog_name"),
                "proj_name": ("project_combos", "proj_name"),
                "phase": ("project_combos", "phase"),
                "sub_name": ("subject_combos", "subject_name"),
                "year_category": ("subject_combos", "year_category")}


def filter_dims(snapshot: DataFrame, addon: DataFrame, consts: Constants = DEFAULT) -> DataFrame:
    """Distinct dimension combinations for the dashboard filters.

    Users in scope by the programme of their *first* project entry; subject and
    project arrays are expanded (a NULL array drops the user).  Subject rows
    are de-duplicated before the project array is expanded, so the expansion
    works on distinct (labels, subject, project list) keys.  Four columns that
    are not grouped take their minimum; three int columns map NULL to 0 last.
    """
    scoped = snapshot.where(first_slot("project_combos", "prog_name").isin(*consts.programme_scope))
    rows = (scoped.join(addon, "user_id", "left")
            .select(F.col("user_type"),
                    user_type_label().alias("user_type_e"),
                    "is_ple", yes_no_label("is_ple", C.PLE_LABELS).alias("is_ple_e"),
                    "ple_enabled", yes_no_label("ple_enabled", C.PLE_CENTRE_LABELS).alias("ple_enabled_e"),
                    F.round("completion_pct", 0).cast("bigint").alias("rounded_completion"),
                    "gender", "centre_name", "org_name", "state_name", "district_name", "trade",
                    "batch_name", "batch_status", "centre_type",
                    F.explode("subject_combos").alias("s"), "project_combos")
            .select("*", F.col("s.subject_name").alias("subject_name"),
                    F.col("s.year_category").alias("year_category"))
            .drop("s"))
    keys = [c for c in FILTER_DIM_GROUP if c not in ("proj_name", "phase", "prog_name")]
    # MIN of the centre label without a string buffer: the smaller label
    # ('Non-PLE Centre') wins as soon as one row is not a PLE centre
    non_ple_centre = F.col("ple_enabled").isNull() | (F.col("ple_enabled") != 1)
    subj = (rows.groupBy(*keys, "project_combos")
            .agg(F.min("user_type").alias("user_type"), F.min("is_ple").alias("is_ple"),
                 F.min("ple_enabled").alias("ple_enabled"),
                 F.count_if(non_ple_centre).alias("_non_ple_centre")))
    expanded = (subj.select("*", F.explode("project_combos").alias("p"))
                .select("*", F.col("p.proj_name").alias("proj_name"), F.col("p.phase").alias("phase"),
                        F.col("p.prog_name").alias("prog_name")))
    out = (expanded.groupBy(*FILTER_DIM_GROUP)
           .agg(F.min("user_type").alias("user_type"), F.min("is_ple").alias("is_ple"),
                F.min("ple_enabled").alias("ple_enabled"),
                F.sum("_non_ple_centre").alias("_non_ple_centre"))
           .withColumn("ple_enabled_e",
                       F.when(F.col("_non_ple_centre") > 0, C.PLE_CENTRE_LABELS[1])
                       .otherwise(C.PLE_CENTRE_LABELS[0])))
    for c in FILTER_DIM_INT_COLUMNS:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("int"), F.lit(0)))
    return out.select(*FILTER_DIM_COLUMNS)


def dash_dataset(snapshot: DataFrame, addon: DataFrame, consts: Constants = DEFAULT,
                 filters: Mapping[str, Iterable] | None = None) -> DataFrame:
    """Snapshot JOIN attributes for users with any project in the programme scope,
    then the optional column (B20) and any-slot (B21) filters; empty lists are skipped."""
    j = (snapshot.where(any_slot("project_combos", "prog_name", consts.programme_scope))
         .join(addon, "user_id"))
    out = j.select(
        F.col("user_id").alias("tlo_users_id"), "created_at", "user_type",
        user_type_label().alias("user_type_e"),
        yes_no_label("ple_enabled", C.PLE_CENTRE_LABELS).alias("ple_enabled_e"),
        yes_no_label("is_ple", C.PLE_LABELS).alias("is_ple_e"), "is_ple", "project_combos",
        F.col("total_allocated").alias("a_overa_less_asses_c"),
        F.col("total_assessments_allocated").alias("a_overa_assess_c"),
        F.col("total_lessons_allocated").alias("a_overa_lesson_c"),
        F.col("total_completed").alias("c_overa_less_asses_c"),
        F.col("total_assessments_completed").alias("c_overa_asse_c"),
        F.col("total_lessons_completed").alias("c_overa_less_c"),
        F.round("completion_pct", 0).alias("rounded_completion"),
        F.col("username").alias("user_name"), "gender", "centre_name", "org_name", "state_name",
        "district_name", "trade", "batch_name", "batch_status", "centre_type", "platform",
        "ple_enabled", "first_login", "subject_combos", "is_master_trainer")
    return apply_dash_filters(out, filters or {})


def apply_dash_filters(df: DataFrame, filters: Mapping[str, Iterable]) -> DataFrame:
    for widget, values in filters.items():
        vals = [v for v in values if v is not None]
        if not vals:
            continue
        if widget in COLUMN_FILTERS:
            df = df.where(F.col(COLUMN_FILTERS[widget]).isin(vals))
        elif widget in SLOT_FILTERS:
            arr, field = SLOT_FILTERS[widget]
            if field == "year_category":
                vals = [int(v) for v in vals]
            df = df.where(F.col(arr).isNotNull() & any_slot(arr, field, vals))
        else:
            raise ValueError(f"unknown dashboard filter {widget!r}")
    return df
