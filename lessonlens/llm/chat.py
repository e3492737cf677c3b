"""Chat logs: cumulative snapshots collapse to maximal conversations, which are rendered.

A service that logs a conversation after every turn leaves many logs that begin a longer one.
Every turn gets a hash of its role and text; a running XOR over a log of the turns' hashes,
each mixed with its position, is the rolling hash of the prefix that ends there (two
independent 64-bit hashes side by side, and the prefix length).  A log whose whole hash is a
proper prefix hash of another one is dropped by an anti join; of equal logs the smallest
conv_id stays.  Texts are not moved for any of this, only hashes; the turns of the logs that
stay are then gathered and rendered.  DataFrame functions only.

Defined cases
    null conv_id        each such row is a log of one turn (no window or group holds them together); equal
                        ones are copies, of which one is shown, with a null id if no log with an id equals it
    null or tied turn   null turns come first; ties are ordered by the hashes of role and text
    null role, text     differ from empty ones when logs are compared; rendered as empty
    repeated rows       are turns like any other
    empty table         no rows
    further columns     not read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lessonlens.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"


def turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("role").isNull(), F.coalesce("role", F.lit("")),
                      F.col("text").isNull(), F.coalesce("text", F.lit("")))


def prefixes(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n``, ``p``, ``q``: the rolling hash of the first ``n`` turns, for each turn."""
    every = conversations.select("conv_id", "turn", turn_hash(1).alias("a"), turn_hash(2).alias("b"))
    turns, lone = every.where(F.col("conv_id").isNotNull()), every.where(F.col("conv_id").isNull())
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select("conv_id", "turn", "a", "b", F.row_number().over(order).cast("long").alias("n"))
    logs = placed.select("conv_id", "n", F.bit_xor(F.xxhash64("n", "a")).over(upto).alias("p"),
                         F.bit_xor(F.xxhash64(F.lit(3), "n", "b")).over(upto).alias("q"))
    return logs.unionByName(lone.select("conv_id", F.lit(1).cast("long").alias("n"), *alone()))


def alone() -> tuple[Column, Column]:
    """The rolling hash of a log of one turn."""
    one = F.lit(1).cast("long")
    return F.xxhash64(one, F.col("a")).alias("p"), F.xxhash64(F.lit(3), one, F.col("b")).alias("q")


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` of the logs that no other log continues, and their hash (``p``, ``q``)."""
    steps = stored(prefixes(conversations))
    ends = (steps.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.max(F.struct("n", "p", "q")).alias("end"))
            .select("conv_id", "end.n", "end.p", "end.q")
            .unionByName(steps.where(F.col("conv_id").isNull())))
    classes = ends.groupBy("n", "p", "q").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    first = classes.select(F.col("conv_id").alias("c"), F.col("n").alias("whole"))
    begun = (steps.join(first, (steps["conv_id"] == first["c"]) & (steps["n"] < first["whole"]), "left_semi")
             .select("n", "p", "q").distinct())
    return (classes.join(begun, ["n", "p", "q"], "left_anti")
            .select("conv_id", F.col("n").alias("n_turns"), "n_copies", "p", "q"))


def safe(text: Column) -> Column:
    """Text without the markers' opening, so that none can be forged."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rendered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies``, ``chat`` of every maximal log."""
    kept = maximal(conversations).withColumnRenamed("conv_id", "kept_id")
    turns = conversations.select("conv_id", "turn", turn_hash(1).alias("a"), turn_hash(2).alias("b"), "role", "text")
    chats = (turns.join(kept.drop("p", "q"), turns["conv_id"] == kept["kept_id"])
             .groupBy("conv_id", "n_turns", "n_copies")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "a", "b", "role", "text"))).alias("turns")))
    # rows without a log are found again by their hash; equal ones are one
    lone = (turns.where(F.col("conv_id").isNull()).groupBy("a", "b")
            .agg(F.any_value("role").alias("role"), F.any_value("text").alias("text")).select("a", "b", "role", "text", *alone()))
    lone = lone.join(kept.where(F.col("kept_id").isNull()), ["p", "q"]).select(
        F.col("kept_id").alias("conv_id"), "n_turns", "n_copies",
        F.array(F.struct(F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), "a", "b", "role", "text")).alias("turns"))
    chats = chats.unionByName(lone)
    block = F.transform("turns", lambda t: F.concat(F.lit(START), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(END)))
    return chats.select("conv_id", "n_turns", "n_copies", F.array_join(block, "\n").alias("chat"))


ORACLE = f"""
WITH logs AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST) AS l, count(*) AS n
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations)
  GROUP BY conv_id, lone),
classes AS (SELECT l, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM logs GROUP BY l, n)
SELECT a.conv_id, a.n::BIGINT AS n_turns, a.n_copies::BIGINT AS n_copies,
  array_to_string(list_transform(a.l, lambda x: '{START}' || replace(coalesce(x.r, ''), '<|', '< |') || chr(10)
    || replace(coalesce(x.t, ''), '<|', '< |') || '{END}'), chr(10)) AS chat
FROM classes a
WHERE NOT EXISTS (SELECT 1 FROM classes b WHERE b.n > a.n AND b.l[1] IS NOT DISTINCT FROM a.l[1]
  AND list_slice(b.l, 1, a.n) = a.l)
"""
