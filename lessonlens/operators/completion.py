"""Completion (D1, E3, G2) and the allocation-completion merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.operators.joins import bitmap_semi_join, may_broadcast
from lessonlens.sources.fixtures import Sources

LEARNER, STAFF = "learner", "staff"


def _aggregate(activity: DataFrame, keys: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Completed activity per (user, lesson): max score, max rating, summed duration.

    ``keys``: one-column relations (``user_id``, ``lesson_id``) that restrict a scoped run's log
    below the aggregate, so what is out of scope is never shuffled: by a broadcast semi join where
    the keys are proven few, else by a bitmap of fixed size (which lets a small share of other
    rows pass; the join with the allocation drops them).

    A plain hash aggregate: partial aggregation runs map-side, so even a user
    holding a third of all activity rows reaches the shuffle as at most one
    row per (map task, lesson).
    """
    activity = activity.where(F.col("completed") == 1)
    for k in keys:
        if may_broadcast(k, ("log_keys",)):
            activity = activity.join(F.broadcast(k), k.columns, "left_semi")
        else:
            activity = bitmap_semi_join(activity, k, k.columns[0])
    return (activity.groupBy("user_id", "lesson_id")
            .agg(F.max("score").alias("score"), F.max("rating").alias("rating"),
                 F.sum("duration").cast("bigint").alias("duration")))


def completion(src: Sources, users: DataFrame, kind: str) -> DataFrame:
    """D1 + C15: learner completions from learner logs for active learners/alumni,
    staff completions from facilitator logs for active staff."""
    if kind == LEARNER:
        act, who = src.learning_activities, F.col("user_type").isin(*C.LEARNER_TYPES)
    elif kind == STAFF:
        act, who = src.facilitator_learning_activities, ~F.col("user_type").isin(*C.LEARNER_TYPES)
    else:
        raise ValueError(kind)
    ids = users.where(who).select("user_id").distinct()
    return _aggregate(act).join(ids, "user_id", "left_semi")


def completion_dedup(src: Sources, users: DataFrame) -> DataFrame:
    """G2 + E3: learner and staff completions in one relation.

    The two sets are disjoint by construction (user type decides the log), so
    the reference's ``ROW_NUMBER() ... score DESC`` keeps every row; the union
    is the result and no window is planned.
    """
    return completion(src, users, LEARNER).unionByName(completion(src, users, STAFF))


def merge(allocation: DataFrame, src: Sources, partitions: int | None = None,
          keys: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Allocation LEFT JOIN completion on (user, lesson); completed = match found.

    Both activity logs are aggregated with a ``source`` tag and joined on
    (user, lesson, source), where the allocation row's source follows its user
    type.  Because the allocation already holds only active users, this equals
    the semi-join-restricted completion above without joining users again.
    The aggregated completion is hash-partitioned on ``user_id`` so the join
    reuses the allocation's partitioning and the per-user roll-ups downstream
    need no further shuffle of the user x lesson rows.  The join hashes a partition's
    completion (one row per user and lesson) and lets the allocation, the far larger
    side, pass unsorted.  ``keys`` restrict both logs of a scoped run before they are aggregated.
    """
    comp = (_aggregate(src.learning_activities, keys).withColumn("_src", F.lit(LEARNER))
            .unionByName(_aggregate(src.facilitator_learning_activities, keys)
                         .withColumn("_src", F.lit(STAFF)))
            .withColumn("_hit", F.lit(1)))
    comp = comp.repartition(partitions, "user_id") if partitions else comp.repartition("user_id")
    alloc = allocation.withColumn(
        "_src", F.when(F.col("user_type").isin(*C.LEARNER_TYPES), LEARNER).otherwise(STAFF))
    return (alloc.join(comp.hint("shuffle_hash"), ["user_id", "lesson_id", "_src"], "left")
            .withColumn("completed", F.when(F.col("_hit").isNull(), 0).otherwise(1).cast("int"))
            .drop("_src", "_hit"))
