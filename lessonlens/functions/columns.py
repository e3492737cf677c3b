"""Column expressions shared by the operators (all built-in, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lessonlens import config as C


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- B3 / B15: activity status ------------------------------------------------
def is_active(status: str = "status", deleted_at: str = "deleted_at") -> Column:
    """``status = 1 AND deleted_at IS NULL``."""
    return (F.col(status) == 1) & F.col(deleted_at).isNull()


def not_deleted(deleted_at: str = "deleted_at") -> Column:
    return F.col(deleted_at).isNull()


def is_inactive(status: str = "status", deleted_at: str = "deleted_at") -> Column:
    """``status <> 1 OR deleted_at IS NOT NULL`` under three-valued logic.

    A NULL status alone yields NULL (not true), so such a row is not inactive.
    Deliberately not written as ``~is_active``.
    """
    return (F.col(status) != 1) | F.col(deleted_at).isNotNull()


# -- B9 / B10: lesson flags ----------------------------------------------------
def assessment_flag(flag: str = "is_assessment", name: str = "name") -> Column:
    """1 when the flag is 1 or the upper-cased name contains ASSESSMENT."""
    hit = (F.col(flag) == 1) | F.upper(F.col(name)).contains("ASSESSMENT")
    return F.when(hit, 1).otherwise(0).cast("int")


def toolkit_type(student="student_access", facilitator="facilitator_access",
                 master="mastertrainer_access") -> Column:
    return (F.when(F.col(student) == 1, "student")
            .when(F.col(facilitator) == 1, "facilitator")
            .when(F.col(master) == 1, "master"))


# -- B8: lesson-type exclusion ---------------------------------------------------
def type_not_excluded(lesson_type: Column | str, excluded: Iterable[str]) -> Column:
    """``COALESCE(LOWER(TRIM(type)), '') NOT IN (...)``; an empty list keeps everything."""
    excluded = [e.strip().lower() for e in excluded]
    if not excluded:
        return F.lit(True)
    return ~F.coalesce(F.lower(F.trim(col(lesson_type))), F.lit("")).isin(excluded)


# -- B5: year gate ---------------------------------------------------------------
def year_gate(year_to_map: str = "year_to_map", duration: str = "trade_duration") -> Column:
    y, d = F.col(year_to_map), F.col(duration)
    return y.isNull() | (y == 0) | d.isNull() | (y <= d)


# -- B6: staff access ------------------------------------------------------------
def staff_access(user_type="user_type", master="is_master_trainer",
                 facilitator_access="facilitator_access",
                 mastertrainer_access="mastertrainer_access") -> Column:
    t, m = F.col(user_type), F.col(master)
    return ((t == 1)
            | ((t == 2) & (m.isNull() | (m != 1)) & (F.col(facilitator_access) == 1))
            | ((t == 2) & (m == 1) & (F.col(mastertrainer_access) == 1)))


# -- B11 / B12 / B13: labels -----------------------------------------------------
def user_type_label(user_type="user_type", master="is_master_trainer") -> Column:
    t = F.col(user_type)
    return (F.when(t == 1, C.USER_TYPE_LABELS[1])
            .when((t == 2) & (F.col(master) == 1), C.MASTER_TRAINER_LABEL)
            .when(t == 2, C.USER_TYPE_LABELS[2])
            .when(t == 3, C.USER_TYPE_LABELS[3])
            .when(t == 4, C.USER_TYPE_LABELS[4])
            .otherwise(C.MISSING_LABEL))


def yes_no_label(c: str, labels: tuple[str, str]) -> Column:
    """1 -> first label; anything else, NULL included -> second label."""
    return F.when(F.col(c) == 1, labels[0]).otherwise(labels[1])


def batch_status_label(c: str = "batch_status") -> Column:
    return (F.when(F.col(c) == 1, C.BATCH_LABELS[0])
            .when(F.col(c) == 0, C.BATCH_LABELS[1])
            .otherwise(C.MISSING_LABEL))


def gender_label(profile_gender: str, user_gender: str) -> Column:
    g = F.lower(F.coalesce(F.col(profile_gender), F.col(user_gender)))
    return (F.when(g == "male", C.GENDER_LABELS[0])
            .when(g == "female", C.GENDER_LABELS[1])
            .otherwise(C.GENDER_LABELS[2]))


# -- H4 / H6 / H8: numeric helpers -----------------------------------------------
def pct(done: Column | str, total: Column | str, scale: int = 2) -> Column:
    """``ROUND(done / NULLIF(total, 0) * 100, 2)`` in exact decimal arithmetic."""
    d = col(done).cast("decimal(20,0)")
    n = F.nullif(col(total).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(d * 100 / n, scale).cast("decimal(5,2)")


def round_avg(c: Column | str, scale: int = 2) -> Column:
    """``ROUND(AVG(x), 2)`` for DECIMAL(10,2) inputs, kept as DECIMAL(10,2)."""
    return F.round(F.avg(col(c)), scale).cast("decimal(10,2)")


def count_when(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def null_if_blank(c: Column | str) -> Column:
    """``NULLIF(NULLIF(TRIM(x), ''), '.')``."""
    t = F.trim(col(c))
    return F.when((t == "") | (t == "."), None).otherwise(t)


def any_slot(arr: str, field: str, values: Iterable) -> Column:
    """True when any element's ``field`` is in ``values``."""
    vals = list(values)
    return F.exists(F.col(arr), lambda x: x[field].isin(vals))


def first_slot(arr: str, field: str) -> Column:
    """The ``field`` of the first element (B22); arrays are kept sorted."""
    return F.get(F.col(arr), 0)[field]
