"""Data products P1-P4 as compositions of the operators.

A :class:`Pipeline` holds the sources, scope and constants of one run and
memoises the shared intermediate relations, so the allocation / completion
plan is declared once and reused by every product built from it.
"""

from __future__ import annotations

from functools import cached_property, wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.config import DEFAULT, Constants
from lessonlens.operators import allocation as A
from lessonlens.operators import completion as CMP
from lessonlens.operators import programme as PG
from lessonlens.operators import rollup as R
from lessonlens.operators.joins import BroadcastBudget, may_broadcast, within
from lessonlens.operators.scope import NO_SCOPE, Params, active_users, scope_rows
from lessonlens.session import checkpoint_partitioned, user_partitions
from lessonlens.sources.fixtures import Sources

SNAPSHOT_COLUMNS = ["user_id", "user_type", "centre_id", "organisation_id", "is_ple", "created_at",
                    "batch_id", "trade_id", *R.TOTALS, "completion_pct", "project_combos",
                    "subject_combos"]

LESSON_PROGRESS_COLUMNS = [
    "user_id", "organisation_id", "user_type", "centre_id", "is_ple", "batch_id", "trade_id",
    "career_path_id", "career_path_name", "subject_id", "subject_name", "subject_is_ple",
    "year_category", "subject_order", "lesson_id", "lesson_name", "lesson_order", "lesson_type",
    "is_assessment", "toolkit_type", "allocation_path", "completed", "score", "rating", "duration"]

SUBJECT_KEYS = ["user_id", "organisation_id", "user_type", "centre_id", "is_ple", "batch_id",
                "trade_id", "career_path_id", "career_path_name", "subject_id", "subject_name",
                "subject_is_ple", "year_category", "subject_order", "allocation_path"]


def _within_budget(build):
    """The broadcasts of all products of a pipeline share its budget."""
    @wraps(build)
    def declared(self):
        with within(self.budget):
            return build(self)
    return declared


class Pipeline:
    def __init__(self, src: Sources, params: Params = NO_SCOPE, consts: Constants = DEFAULT,
                 ple_rule: str = "strict", excluded_types=None,
                 user_keys: DataFrame | None = None):
        self.src = src
        self.params = params
        self.consts = consts
        self.ple_rule = ple_rule
        self.excluded_types = excluded_types
        self.user_keys = user_keys
        self.budget = BroadcastBudget()

    @cached_property
    @_within_budget
    def users(self) -> DataFrame:
        """Active users (with profile), hash-partitioned on ``user_id``.

        The explicit partitioning is the one shuffle of the user relation; the
        allocation fan-out, the completion join and all roll-ups reuse it.  The
        partition count is explicit: the user relation is small next to the
        user x lesson fan-out produced from it, and AQE would otherwise
        coalesce this shuffle into a handful of tasks by its input size.

        The partitioned relation is checkpointed (eagerly, into the session's
        ``spark.checkpoint.dir``): every branch of a product (allocation, user
        row, phase routes) prunes different columns below a plain repartition,
        which would defeat exchange reuse and shuffle the users once per
        branch.  The checkpoint keeps the ``user_id`` partitioning, is read by
        all branches, and cuts the lineage.
        """
        return checkpoint_partitioned(active_users(self.src, self.params, self.user_keys),
                                      "user_id", self.partitions)

    @cached_property
    def partitions(self) -> int:
        """Partitions of the users and of all that is joined to them, by the most rows these can come to:
        every user of the scope with every lesson of the catalogue, and in a full run the logs."""
        users = scope_rows(self.src, self.params).count()
        fan_out = users * A.catalogue_rows(self.src, self.consts, self.excluded_types)
        if self.user_keys is None and self.params.is_empty():
            fan_out += self.src.learning_activities.count() + self.src.facilitator_learning_activities.count()
        return user_partitions(self.src.spark, fan_out)

    @cached_property
    def scoped_users(self) -> DataFrame | None:
        """The users of a restricted run; None for a full run."""
        p = self.params
        if self.user_keys is None and p.user_id is None and p.centre_id is None \
                and p.batch_id is None and p.trade_id is None:
            return None
        return self.users.select("user_id").distinct()

    @cached_property
    @_within_budget
    def scope_ids(self) -> DataFrame | None:
        """The users of a restricted run, if they are proven few enough to broadcast; None
        for a full run, or where the scope is larger."""
        ids = self.scoped_users
        return ids if ids is not None and may_broadcast(ids, ("log_keys",)) else None

    @cached_property
    def log_keys(self) -> tuple[DataFrame, ...]:
        """What restricts both activity logs below their aggregates: the scope's users, however many,
        and the lessons of a scoped subject."""
        keys = () if self.scoped_users is None else (self.scoped_users,)
        if self.params.subject_id is not None:
            keys += (self.src.lessons.where(F.col("subject_id") == self.params.subject_id)
                     .select(F.col("id").alias("lesson_id")).distinct(),)
        return keys

    @cached_property
    @_within_budget
    def allocation(self) -> DataFrame:
        return A.allocation(self.src, self.users, self.params, self.consts, self.ple_rule,
                            self.excluded_types, self.scope_ids)

    @cached_property
    @_within_budget
    def merged(self) -> DataFrame:
        return CMP.merge(self.allocation, self.src, self.partitions, self.log_keys)

    # -- P1 / P2 ------------------------------------------------------------
    @_within_budget
    def user_snapshot(self) -> DataFrame:
        """One row per active user with totals and the two nested arrays."""
        base = R.one_user_row(self.users)
        combos = R.subject_combos(self.merged)
        projects = PG.project_combos(self.src, self.users, self.params)
        # one row per user on every side, a partition's users fit in memory: hashed, none is sorted
        out = (base.join(projects.hint("shuffle_hash"), "user_id", "left")
               .join(combos.hint("shuffle_hash"), "user_id", "left"))
        for c in R.TOTALS:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("bigint")))
        out = out.withColumn("completion_pct",
                             F.coalesce(F.col("completion_pct"), F.lit(0).cast("decimal(5,2)")))
        return out.select(*SNAPSHOT_COLUMNS)

    # -- P3 ---------------------------------------------------------------
    @_within_budget
    def lesson_progress(self) -> DataFrame:
        """One row per user x allocated lesson (re-joined to the profile rows)."""
        # a partition's users fit in memory: the user x lesson rows pass them unsorted
        prof = self.users.select("user_id", "organisation_id", "is_ple").hint("shuffle_hash")
        return (self.merged.drop("is_ple").join(prof, "user_id")
                .withColumnRenamed("year_to_map", "year_category")
                .select(*LESSON_PROGRESS_COLUMNS))

    # -- P4 ---------------------------------------------------------------
    @_within_budget
    def subject_progress(self) -> DataFrame:
        """J9 (D8 + D9): one row per user x subject with a nested lessons array."""
        lp = self.lesson_progress()
        done = F.col("completed") == 1
        lesson = F.struct("lesson_id", "lesson_name", "lesson_order", "lesson_type",
                          "is_assessment", "toolkit_type", "completed", "score", "rating",
                          "duration")
        return (lp.groupBy(*SUBJECT_KEYS)
                .agg(F.count("lesson_id").alias("total_allocated"),
                     F.count_if(F.col("is_assessment") == 0).cast("bigint").alias("lessons_allocated"),
                     F.count_if(F.col("is_assessment") == 1).cast("bigint").alias("assessments_allocated"),
                     F.sum("completed").cast("bigint").alias("total_completed"),
                     F.count_if(done & (F.col("is_assessment") == 0)).cast("bigint")
                      .alias("lessons_completed"),
                     F.count_if(done & (F.col("is_assessment") == 1)).cast("bigint")
                      .alias("assessments_completed"),
                     F.round(F.avg(F.when(done, F.col("score"))), 2).cast("decimal(10,2)")
                      .alias("avg_score"),
                     F.round(F.avg(F.when(done, F.col("rating"))), 2).cast("decimal(10,2)")
                      .alias("avg_rating"),
                     F.sum("duration").cast("bigint").alias("total_duration_seconds"),
                     F.array_sort(F.collect_list(lesson)).alias("lessons"))
                .withColumn("subject_completion_pct",
                            R.pct("total_completed", "total_allocated")))
