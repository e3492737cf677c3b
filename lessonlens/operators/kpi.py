"""Dashboard KPIs (2L).  The reference defines them only as tooltip text; the
formulas below are the literal reading of those texts over the dashboard
dataset (P7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C

_LEARNER = lambda: F.col("user_type").isin(*C.LEARNER_TYPES)


def _ratio(num: F.Column, den: F.Column, scale: int = 2) -> F.Column:
    """``ROUND(num / NULLIF(den, 0), scale)`` in exact decimal arithmetic."""
    n = num.cast("decimal(38,0)")
    d = F.nullif(den.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return F.round(n / d, scale).cast("decimal(20,2)")


def headline(dash: DataFrame) -> DataFrame:
    """L1-L4: accessed, unique logins, engaged, females per 100 males."""
    return dash.agg(
        F.countDistinct("tlo_users_id").cast("bigint").alias("accessed"),
        F.countDistinct(F.when(F.col("first_login").isNotNull(), F.col("tlo_users_id")))
        .cast("bigint").alias("unique_logins"),
        F.countDistinct(F.when(F.col("c_overa_less_c") > 0, F.col("tlo_users_id")))
        .cast("bigint").alias("engaged"),
        _ratio(100 * F.count_if(F.col("gender") == "Female"),
               F.count_if(F.col("gender") == "Male")).alias("females_per_100_males"))


def _averages(dash: DataFrame, done: str, alloc: str, prefix: str) -> DataFrame:
    """Per learner who accessed: average completed, average allocated, and
    their ratio (%)."""
    d = dash.where(_LEARNER())
    n = F.count(F.lit(1))
    return d.agg(_ratio(F.sum(done), n).alias(f"avg_{prefix}_completed"),
                 _ratio(F.sum(alloc), n).alias(f"avg_{prefix}_allocated"),
                 _ratio(100 * F.sum(done), F.sum(alloc)).alias(f"{prefix}_completion_pct"))


def lessons(dash: DataFrame) -> DataFrame:
    return _averages(dash, "c_overa_less_c", "a_overa_lesson_c", "lessons")


def assessments(dash: DataFrame) -> DataFrame:
    return _averages(dash, "c_overa_asse_c", "a_overa_assess_c", "assessments")


def completion_hist(dash: DataFrame) -> DataFrame:
    """Users per rounded completion percentage."""
    return (dash.groupBy(F.col("rounded_completion").cast("bigint").alias("rounded_completion"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("users")))


def distributions(dash: DataFrame) -> DataFrame:
    """Users by location (state), device (platform) and user type.

    One pass: each row is unpivoted into its three (dimension, value) pairs and
    a single grouped count follows (the dataset is planned once, not per chart).
    """
    pairs = F.array(*[F.struct(F.lit(dim).alias("dimension"), F.col(c).alias("value"))
                      for dim, c in (("state", "state_name"), ("platform", "platform"),
                                     ("user_type", "user_type_e"))])
    return (dash.select(F.inline(pairs)).groupBy("dimension", "value")
            .agg(F.count(F.lit(1)).cast("bigint").alias("users")))


def monthly(dash: DataFrame) -> DataFrame:
    """Registrations per month."""
    return (dash.groupBy(F.date_trunc("month", "created_at").cast("timestamp_ntz").alias("month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("users")))


def _subject_rows(dash: DataFrame) -> DataFrame:
    return dash.select("tlo_users_id", "centre_name", F.inline("subject_combos"))


def details(dash: DataFrame) -> DataFrame:
    """Completion per centre x subject (users, allocated, completed)."""
    s = _subject_rows(dash)
    return (s.groupBy("centre_name", "subject_name")
            .agg(F.countDistinct("tlo_users_id").cast("bigint").alias("users"),
                 F.sum("allocated_lessons_and_assessments").cast("bigint").alias("allocated"),
                 F.sum("completed_lessons_and_assessments").cast("bigint").alias("completed")))


def top_subjects(dash: DataFrame, k: int = 10) -> DataFrame:
    """The k subjects with the most completed items (ties by name)."""
    s = _subject_rows(dash)
    return (s.groupBy("subject_name")
            .agg(F.sum("completed_lessons_and_assessments").cast("bigint").alias("completed"))
            .orderBy(F.col("completed").desc(), F.col("subject_name").asc())
            .limit(k))
