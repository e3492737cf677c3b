"""User attributes (P5, J10) and the lesson export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.functions.columns import gender_label, is_active
from lessonlens.operators.joins import bounded_broadcast, one_plan
from lessonlens.sources.fixtures import Sources

ADDON_COLUMNS = ["user_id", "username", "gender", "centre_name", "org_name", "state_name",
                 "district_name", "trade", "batch_name", "is_master_trainer", "batch_status",
                 "centre_type", "ple_enabled", "platform", "first_login"]

# Readable columns moved to the front of the lesson export.
EXPORT_FRONT = ["username", "centre_name", "state_name", "district_name", "trade", "gender"]


def _key(src: Sources, name) -> tuple:
    return (src.sf_dir, name)


def first_login(src: Sources) -> DataFrame:
    """Earliest login per user (hash aggregate, combined map-side)."""
    return src.login_logs.groupBy("user_id").agg(F.min("created_at").alias("first_login"))


def centre_attributes(src: Sources) -> DataFrame:
    """Active centres of active organisations with their readable names (dimension-sized)."""
    org = src.organisations.where(is_active()).select(
        F.col("id").alias("organisation_id"), F.col("name").alias("org_name"))
    st = src.states.select(F.col("id").alias("state_id"), F.col("name").alias("state_name"))
    di = src.districts.select(F.col("id").alias("district_id"), F.col("name").alias("district_name"))
    ct = src.centre_types.select(F.col("id").alias("centre_type_id"),
                                 F.col("name").alias("centre_type"),
                                 F.col("type").alias("centre_type_code"))
    return (src.centres.where(is_active())
            .select(F.col("id").alias("centre_id"), F.col("name").alias("centre_name"),
                    "organisation_id", "state_id", "district_id", "centre_type_id", "ple_enabled")
            .join(org, "organisation_id")
            .join(st, "state_id", "left").join(di, "district_id", "left")
            .join(ct, "centre_type_id", "left"))


@one_plan
def user_addon(src: Sources) -> DataFrame:
    """One row per active user (x profile rows) at an active centre.

    Centre and organisation must be active (the reference's left joins are
    turned inner by its WHERE clause); batch name only for live, non-archived
    batches, and ``batch_status`` says whether that batch was found.
    """
    u = (src.users.where(is_active())
         .select(F.col("id").alias("user_id"), F.col("name").alias("username"),
                 F.col("gender").alias("user_gender"), "centre_id", "is_master_trainer",
                 F.col("created_platform").alias("platform")))
    sd = src.student_details.select("user_id", "batch_id", "trade_id",
                                    F.col("gender").alias("profile_gender"))
    tr = src.trades.select(F.col("id").alias("trade_id"), F.col("name").alias("trade"))
    b = (src.batches.where(F.col("deleted_at").isNull() & (F.col("status") != C.ARCHIVED_BATCH_STATUS))
         .select(F.col("id").alias("batch_id"), F.col("name").alias("batch_name"),
                 F.lit(1).alias("_b")))
    centres = bounded_broadcast(centre_attributes(src), _key(src, "centre_attributes"))
    return (u.join(centres, "centre_id")
            .join(sd, "user_id", "left")
            .join(first_login(src), "user_id", "left")
            .join(bounded_broadcast(tr, _key(src, "trades_names")), "trade_id", "left")
            .join(bounded_broadcast(b, _key(src, "batches_live")), "batch_id", "left")
            .select("user_id", "username",
                    gender_label("profile_gender", "user_gender").alias("gender"),
                    "centre_name", "org_name", "state_name", "district_name", "trade",
                    "batch_name", "is_master_trainer",
                    F.when(F.col("_b").isNotNull(), 1).otherwise(0).cast("int").alias("batch_status"),
                    "centre_type", "ple_enabled", "platform", "first_login"))


def batch_names(src: Sources) -> DataFrame:
    """Batch id -> name, deleted and archived batches included, one row per id."""
    return (src.batches.groupBy(F.col("id").alias("batch_id"))
            .agg(F.min("name").alias("batch_name")))


@one_plan
def lesson_export(progress: DataFrame, src: Sources, addon: DataFrame) -> DataFrame:
    """Lesson progress + batch name + readable addon columns in front.

    The addon side is reduced to one row per user (deterministically, the
    smallest username) before the left join, so it can never multiply rows.
    """
    a = (addon.groupBy("user_id")
         .agg(F.min(F.struct(*EXPORT_FRONT)).alias("_a"))
         .select("user_id", *[F.col("_a." + c).alias(c) for c in EXPORT_FRONT])
         .hint("shuffle_hash"))        # the progress rows pass it unsorted
    out = (progress.join(bounded_broadcast(batch_names(src), _key(src, "batch_names")),
                         "batch_id", "left")
           .join(a, "user_id", "left"))
    front = ["user_id", *EXPORT_FRONT, "batch_name"]
    return out.select(*front, *[c for c in progress.columns if c not in front])


def export_missing_users(requested: DataFrame, progress: DataFrame) -> DataFrame:
    """Requested user ids that produced no lesson rows."""
    return (requested.select("user_id").distinct()
            .join(progress.select("user_id"), "user_id", "left_anti"))
