"""Run history (M8, M9): what every run wrote, and how it differs from the run before.

One append-only table holds, for each run of a product, its rows per centre (``kind`` ``rows``) and its
columns with their types (``kind`` ``column``).  A run is compared with the product's last run
before it, and its schema with the declared one if there is one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lessonlens.operators.quality import schema_drift
from lessonlens.sources.sinks import table_exists, write_append


def run_record(product: str, run_id: str, run_at: dt.datetime, df: DataFrame, by: str = "centre_id") -> DataFrame:
    """The history rows of one run: one per value of ``by`` (item NULL for NULL) and one per column."""
    said = [F.lit(run_id).alias("run_id"), F.lit(product).alias("product"),
            F.lit(run_at).cast("timestamp_ntz").alias("run_at")]
    counts = df.groupBy(F.col(by).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None)
    columns = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                              "item string, type string")
    return (counts.select(*said, F.lit("rows").alias("kind"), "item", none.cast("string").alias("type"), "rows")
            .unionByName(columns.select(*said, F.lit("column").alias("kind"), "item", "type",
                                        none.cast("bigint").alias("rows"))))


def record_run(history: str, product: str, run_id: str, run_at: dt.datetime, df: DataFrame, by: str = "centre_id") -> None:
    """Appends a run to the history; a run that is recorded already (a job begun again) is left as it is."""
    spark = df.sparkSession
    if table_exists(spark, history):
        met = spark.table(history).where((F.col("product") == product) & (F.col("run_id") == run_id))
        if not met.isEmpty():
            return
    write_append(run_record(product, run_id, run_at, df, by).coalesce(1), history)


def run_before(history: DataFrame, product: str, run_id: str) -> str | None:
    """Id of the product's last run before ``run_id`` (by time, then id)."""
    runs = history.where(F.col("product") == product).groupBy("run_id").agg(F.min("run_at").alias("run_at"))
    own = runs.where(F.col("run_id") == run_id).select(F.struct("run_at", "run_id").alias("own"))
    # one row on the right
    earlier = runs.join(F.broadcast(own), F.struct("run_at", "run_id") < F.col("own"))
    last = earlier.agg(F.max(F.struct("run_at", "run_id")).alias("last")).first()["last"]
    return last["run_id"] if last else None


def drift(history: DataFrame, product: str, run_id: str, before: str | None = None) -> DataFrame:
    """What changed since the run before (or ``before``): ``kind``, ``item``, ``change`` (``added``, ``removed``, ``type``,
    ``rows``), ``was``, ``now``.  No rows for a first run."""
    before = before or run_before(history, product, run_id)
    own = history.where(F.col("product") == product)
    value = F.coalesce("type", F.col("rows").cast("string"))
    def of(run):
        return own.where(F.col("run_id") == F.lit(run)).select("kind", "item", value.alias("value"))
    a = of(before).withColumnsRenamed({"kind": "k", "item": "i", "value": "was"})
    b = of(run_id).withColumnRenamed("value", "now")
    if before is None:
        b = b.limit(0)
    both = a.join(b, (F.col("k") == F.col("kind")) & F.col("i").eqNullSafe(F.col("item")), "full")
    change = (F.when(F.col("kind").isNull(), "removed").when(F.col("k").isNull(), "added")
              .when(F.col("was") != F.col("now"), F.when(F.col("kind") == "column", "type").otherwise("rows")))
    return (both.withColumn("change", change).where(F.col("change").isNotNull())
            .select(F.coalesce("kind", "k").alias("kind"), F.when(F.col("kind").isNull(), F.col("i")).otherwise(F.col("item")).alias("item"),
                    "change", "was", "now"))


def declared_drift(df: DataFrame, declared: StructType) -> DataFrame:
    """The differences of a table's schema from the declared one, one row each: ``difference``, and ``rows``, the
    number of rows that it concerns.  Nothing where the table is as declared."""
    found = df.sparkSession.createDataFrame([(d,) for d in schema_drift(df, declared)], "difference string")
    return df.agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(found)).select("difference", "rows")  # one row x columns
