"""Roll-ups of the merged user x lesson relation.

Every aggregate here is keyed by ``user_id`` (optionally with ``subject_id``),
so all of them run on the ``user_id`` hash partitioning the merge produced:
the user x lesson rows are shuffled at most once in a whole product.
Nested arrays are bounded by the curriculum (subjects per user, lessons per
subject), never by activity volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lessonlens.functions.columns import count_when, pct, round_avg



def _lesson():
    return F.col("is_assessment") == 0


def _assess():
    return F.col("is_assessment") == 1


def _done():
    return F.col("completed") == 1


TOTALS = ["total_allocated", "total_lessons_allocated", "total_assessments_allocated",
          "total_completed", "total_lessons_completed", "total_assessments_completed"]


def user_summary(merged: DataFrame) -> DataFrame:
    """Allocated / completed counts per user, lesson vs assessment, and pct."""
    return (merged.groupBy("user_id")
            .agg(F.count("lesson_id").alias("total_allocated"),
                 count_when(_lesson()).alias("total_lessons_allocated"),
                 count_when(_assess()).alias("total_assessments_allocated"),
                 F.sum("completed").cast("bigint").alias("total_completed"),
                 count_when(_done() & _lesson()).alias("total_lessons_completed"),
                 count_when(_done() & _assess()).alias("total_assessments_completed"))
            .withColumn("completion_pct", pct("total_completed", "total_allocated")))


def subject_allocation(merged: DataFrame) -> DataFrame:
    """D3: allocation counts per user x subject."""
    return (merged.groupBy("user_id", "subject_id")
            .agg(F.count("lesson_id").alias("subj_total_allocated"),
                 count_when(_lesson()).alias("subj_lessons_allocated"),
                 count_when(_assess()).alias("subj_assessments_allocated")))


def subject_completion(merged: DataFrame) -> DataFrame:
    """Completion counts per user x subject (only subjects with a completion)."""
    return (merged.where(_done()).groupBy("user_id", "subject_id")
            .agg(F.count("lesson_id").alias("subj_total_completed"),
                 count_when(_lesson()).alias("subj_lessons_completed"),
                 count_when(_assess()).alias("subj_assessments_completed")))


def subject_stats(merged: DataFrame) -> DataFrame:
    """D3 + D4 + D5 folded into one pass per user x subject.

    Averages and sums are over completed rows only, as in the subject output
    of the snapshot.
    """
    done = lambda c: F.when(_done(), F.col(c))
    # subject_name / year_to_map depend on subject_id alone: grouping by them
    # keeps the same groups and a hash aggregate (a string ``first`` would
    # force a sort-based aggregate over the whole fan-out)
    return (merged.groupBy("user_id", "subject_id", "subject_name", "year_to_map")
            .agg(F.count("lesson_id").alias("subj_total_allocated"),
                 count_when(_lesson()).alias("subj_lessons_allocated"),
                 count_when(_assess()).alias("subj_assessments_allocated"),
                 count_when(_done()).alias("subj_total_completed"),
                 count_when(_done() & _lesson()).alias("subj_lessons_completed"),
                 count_when(_done() & _assess()).alias("subj_assessments_completed"),
                 round_avg(done("score")).alias("avg_score"),
                 round_avg(done("rating")).alias("avg_rating"),
                 F.avg(done("duration")).alias("avg_duration"),
                 F.sum(done("duration")).cast("bigint").alias("total_duration")))


_LESSON_COLUMNS = {"lesson_id": "bigint", "lesson_name": "string", "lesson_order": "int",
                   "lesson_type": "string", "is_assessment": "int", "toolkit_type": "string",
                   "score": "decimal(10,2)", "rating": "decimal(10,2)", "duration": "bigint"}


def _first_of_subject():
    """Rank of a row within its user and subject, by subject order, then lesson id."""
    return F.row_number().over(Window.partitionBy("user_id", "subject_id").orderBy(
        F.col("subject_order").asc_nulls_first(), F.col("lesson_id").asc_nulls_first()))


def _with_totals(rows: DataFrame) -> DataFrame:
    """Every row with its user's and subject's totals.

    The subject's sums come first: rows sorted by user and subject serve the user's sums as they
    are, so both windows share one sort of the fan-out.
    """
    def sums(w, conditions):
        return {name: F.sum(F.when(c, 1).otherwise(0)).over(w).cast("bigint") for name, c in conditions.items()}

    kinds = {"allocated": F.lit(True), "lessons_allocated": _lesson(), "assessments_allocated": _assess(),
             "completed": _done(), "lessons_completed": _done() & _lesson(),
             "assessments_completed": _done() & _assess()}
    of_subject = {"subj_total_" + k if "_" not in k else "subj_" + k: c for k, c in kinds.items()}
    of_user = {"total_" + k: c for k, c in kinds.items()}
    return (rows.withColumns(sums(Window.partitionBy("user_id", "subject_id"), of_subject))
            .withColumns(sums(Window.partitionBy("user_id"), of_user))
            .withColumn("completion_pct", pct("total_completed", "total_allocated")))


def completed_rows(merged: DataFrame) -> DataFrame:
    """J4 (C16): completed rows with user and subject totals attached."""
    return _with_totals(merged).where(_done())


def lesson_output(merged: DataFrame) -> DataFrame:
    """The completed rows, and for users with nothing completed one placeholder row per
    subject, in one pass over the user x lesson rows."""
    rows = _with_totals(merged.withColumn("_rank", _first_of_subject()))
    placeholder = (F.col("total_completed") == 0) & (F.col("_rank") == 1)
    return (rows.where(_done() | placeholder)
            .withColumns({c: F.when(_done(), F.col(c).cast(t)) for c, t in _LESSON_COLUMNS.items()})
            .drop("_rank"))


def zero_completion_rows(merged: DataFrame) -> DataFrame:
    """J5 (E4): for users with nothing completed, one placeholder row per subject.

    The first row by subject order (then lesson id) carries the subject's
    attributes; lesson-level columns are NULL.
    """
    z = (merged.withColumn("_done", F.sum("completed").over(Window.partitionBy("user_id")))
         .where(F.col("_done") == 0)
         .withColumn("_rank", _first_of_subject())
         .where(F.col("_rank") == 1))
    return (z.withColumns({c: F.lit(None).cast(t) for c, t in _LESSON_COLUMNS.items()})
            .drop("_done", "_rank"))


def subject_combos(merged: DataFrame) -> DataFrame:
    """D7 + D2: per-user totals and the subject array.

    The array lists subjects with at least one completed item and exists only
    when the user completed at least one *lesson* (assessments alone leave it
    NULL).  Two aggregation levels on the same partitioning: user x subject,
    then user.
    """
    s = subject_stats(merged)
    item = F.struct(
        F.col("subject_id"), F.col("subject_name"), F.col("avg_score"), F.col("avg_rating"),
        F.col("subj_total_completed").alias("completed_lessons_and_assessments"),
        F.col("subj_total_allocated").alias("allocated_lessons_and_assessments"),
        F.col("subj_assessments_allocated").alias("allocated_assessments"),
        F.col("subj_lessons_allocated").alias("allocated_lessons"),
        F.col("subj_assessments_completed").alias("completed_assessments"),
        F.col("subj_lessons_completed").alias("completed_lessons"),
        F.col("year_to_map").alias("year_category"))
    u = (s.groupBy("user_id")
         .agg(F.sum("subj_total_allocated").cast("bigint").alias("total_allocated"),
              F.sum("subj_lessons_allocated").cast("bigint").alias("total_lessons_allocated"),
              F.sum("subj_assessments_allocated").cast("bigint").alias("total_assessments_allocated"),
              F.sum("subj_total_completed").cast("bigint").alias("total_completed"),
              F.sum("subj_lessons_completed").cast("bigint").alias("total_lessons_completed"),
              F.sum("subj_assessments_completed").cast("bigint").alias("total_assessments_completed"),
              F.collect_list(F.when(F.col("subj_total_completed") > 0, item)).alias("_items")))
    return (u.withColumn("completion_pct", pct("total_completed", "total_allocated"))
            .withColumn("subject_combos",
                        F.when(F.col("total_lessons_completed") > 0, F.array_sort("_items")))
            .drop("_items"))


USER_ATTRS = ["user_name", "email", "mobile", "user_type", "is_master_trainer", "centre_id",
              "project_id", "organisation_id", "is_ple", "created_at", "batch_id", "trade_id",
              "educational_qualification_id", "placement_status_id", "active_year",
              "year_of_admission"]


def one_user_row(users: DataFrame) -> DataFrame:
    """Collapse duplicate profile rows with MAX per attribute."""
    return users.groupBy("user_id").agg(*[F.max(c).alias(c) for c in USER_ATTRS])
