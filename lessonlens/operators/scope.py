"""Scoping (B1), active users (B2) and active dimensions."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.functions.columns import is_active
from lessonlens.sources.fixtures import Sources


@dataclass(frozen=True)
class Params:
    """Eight optional equality filters; ``None`` means "no filter".

    Each set field becomes a literal predicate that Catalyst pushes into the
    scan, instead of a cross join against a one-row parameter relation.
    """

    user_id: int | None = None
    centre_id: int | None = None
    batch_id: int | None = None
    trade_id: int | None = None
    subject_id: int | None = None
    project_id: int | None = None
    program_id: int | None = None
    phase_id: int | None = None

    def is_empty(self) -> bool:
        return all(getattr(self, f.name) is None for f in fields(self))


NO_SCOPE = Params()


def scope_filter(df: DataFrame, params: Params, mapping: dict[str, str]) -> DataFrame:
    """Apply the set fields of ``params`` to the columns named in ``mapping``."""
    for field_name, column in mapping.items():
        value = getattr(params, field_name)
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def scope_rows(src: Sources, params: Params = NO_SCOPE) -> DataFrame:
    """Rows of the active users of types 1-4, as far as the scope is known from the user row."""
    return scope_filter(src.users.where(F.col("type").isin(*C.USER_TYPES) & is_active()), params,
                        {"user_id": "id", "centre_id": "centre_id"})


def active_users(src: Sources, params: Params = NO_SCOPE, user_keys: DataFrame | None = None
                 ) -> DataFrame:
    """B2: active users of types 1-4 with their profile (left join).

    ``user_keys`` (one column ``user_id``) restricts the population with a
    semi join — the set-based form of the per-user refresh loop.
    """
    u = (scope_rows(src, params)
         .select(F.col("id").alias("user_id"), F.col("name").alias("user_name"),
                 "email", "mobile", F.col("type").alias("user_type"), "is_master_trainer",
                 "centre_id", "project_id", "organisation_id", "is_ple", "created_at"))
    if user_keys is not None:
        u = u.join(user_keys.select("user_id").distinct(), "user_id", "left_semi")
    sd = src.student_details.select(
        "user_id", "batch_id", "trade_id", "educational_qualification_id",
        "placement_status_id", "active_year", "year_of_admission")
    if params.user_id is not None:
        sd = sd.where(F.col("user_id") == params.user_id)
    out = u.join(sd, "user_id", "left")
    return scope_filter(out, params, {"batch_id": "batch_id", "trade_id": "trade_id"})


def active_centres(src: Sources, params: Params = NO_SCOPE) -> DataFrame:
    c = src.centres.where(is_active()).select(
        F.col("id").alias("centre_id"), "organisation_id", F.col("name").alias("centre_name"),
        "centre_type_id", "ple_enabled")
    return scope_filter(c, params, {"centre_id": "centre_id"})


def active_projects(src: Sources, params: Params = NO_SCOPE) -> DataFrame:
    p = src.projects.where(is_active()).select(
        F.col("id").alias("project_id"), "program_id", F.col("name").alias("project_name"))
    return scope_filter(p, params, {"program_id": "program_id", "project_id": "project_id"})


def active_programs(src: Sources) -> DataFrame:
    return src.programs.where(is_active()).select(
        F.col("id").alias("program_id"), F.col("name").alias("program_name"))
