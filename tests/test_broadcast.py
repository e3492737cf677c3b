"""Bounds of broadcasts: of one relation by its measured size, of one plan by the sum."""

from pyspark.sql import functions as F

from lessonlens.operators import joins
from lessonlens.operators.joins import BroadcastBudget, bounded_broadcast, measured, may_broadcast, one_plan, within
from lessonlens.plans.products import Pipeline


def _broadcasts(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")


def test_texts_are_measured_by_their_length(spark):
    short = spark.range(10).select("id", F.lit("ab").alias("t"))
    long = spark.range(10).select("id", F.repeat(F.lit("ab"), 5000).alias("t"), F.array("id").alias("a"))
    assert measured(short) == (10, 10 * (16 + 8 + 16 + 2))
    assert measured(long) == (10, 10 * (16 + 8 + 16 + 1024 + 10_000))
    assert measured(short.limit(0)) == (0, 0)
    assert measured(short.select(F.lit(None).cast("string").alias("t"))) == (10, 10 * 32)


def test_a_relation_of_long_texts_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 50_000)
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    assert not may_broadcast(wide) and may_broadcast(wide.select("id"))


def test_sum_of_a_plan_is_bounded(spark):
    one, two = (spark.range(100).select("id", (F.col("id") + k).alias("v")) for k in (1, 2))
    size = measured(one)[1]
    big = spark.range(1000)

    def joined(limit):
        with within(BroadcastBudget(limit)):
            return (big.join(bounded_broadcast(one), "id").join(bounded_broadcast(two).withColumnRenamed("v", "w"), "id")
                    .join(bounded_broadcast(one).withColumnRenamed("v", "again"), "id"))
    both, single = joined(2 * size), joined(2 * size - 1)
    assert (_broadcasts(both), _broadcasts(single)) == (3, 2)      # the first relation again costs nothing
    assert sorted(both.collect()) == sorted(single.collect())


def test_plans_in_a_plan_share_its_budget(spark):
    seen = []

    @one_plan
    def inner():
        seen.append(joins._BUDGET.get())

    @one_plan
    def outer():
        inner()
        inner()
    outer()
    outer()
    assert seen[0] is seen[1] and seen[2] is seen[3] and seen[0] is not seen[2] and joins._BUDGET.get() is None


def test_size_is_measured_anew_after_a_while(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "t"), ("grows",)
    spark.range(5).write.parquet(path)
    assert measured(spark.read.parquet(path), key)[0] == 5
    spark.range(7).write.mode("append").parquet(path)
    monkeypatch.setattr(joins, "SIZE_SECONDS", 0)
    assert measured(spark.read.parquet(path), key)[0] == 12


def test_products_without_any_broadcast_are_the_same(sources):
    full, none = Pipeline(sources), Pipeline(sources)
    none.budget = BroadcastBudget(0)
    columns = ["user_id", "subject_id", "lesson_id", "allocation_path", "completed"]
    a, b = (p.merged.select(*columns) for p in (full, none))
    assert _broadcasts(a) > 0 and _broadcasts(b) == 0
    assert 0 < sum(full.budget.spent.values()) <= full.budget.limit and not none.budget.spent
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
