"""Sinks: the only module that writes.

Tables are Spark catalog tables (parquet), optionally partitioned by
``centre_id``.  A replacement never overwrites the table it reads from: the
new version is written beside the live table and swapped in by rename
(stage-and-swap), which also keeps the live table readable during the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from lessonlens import config as C


def table_exists(spark: SparkSession, name: str) -> bool:
    """Decides full or incremental mode."""
    return spark.catalog.tableExists(name)


def enforce_schema(df: DataFrame, schema: StructType, zero_fill: tuple = ()) -> DataFrame:
    """Select and cast to a declared schema (never inferred); ``zero_fill``
    columns map NULL to 0 first.  Missing columns are an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in zero_fill:
            c = F.coalesce(c, F.lit(0))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def null_normalise(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL (other types are NULL-native)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), None).otherwise(c).alias(f.name)
        out.append(c)
    return df.select(*out)


def skip_if_empty(df: DataFrame) -> bool:
    """True when the result is empty (an empty result never replaces a table)."""
    return df.isEmpty()


def write_append(df: DataFrame, name: str, partition_by: tuple = ()) -> None:
    """Create if missing, then append."""
    w = df.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def recover(spark: SparkSession, name: str) -> None:
    """Finish or undo a swap that was interrupted; afterwards only the live table is left.

    The former table is complete until it is dropped, so if the live one is
    missing it is put back (the new version is built again by its job); if the
    live one is there, the swap had come through.  A staging table that nobody
    renamed is dropped: it may be half written.
    """
    old = f"{name}__old"
    if table_exists(spark, old):
        if table_exists(spark, name):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__staging")


def choose_mode(spark: SparkSession, name: str) -> str:
    """``full`` where the target is missing (after recovery), else ``incremental``."""
    recover(spark, name)
    return "incremental" if table_exists(spark, name) else "full"


def stage(df: DataFrame, name: str, partition_by: tuple = ()) -> str:
    """Write ``df`` beside the live table; returns the staging table's name."""
    recover(df.sparkSession, name)
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{name}__staging")
    return f"{name}__staging"


def swap(spark: SparkSession, name: str) -> None:
    """Rename the staged version in.  The former one goes only after the new one is live."""
    if table_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    spark.sql(f"ALTER TABLE {name}__staging RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__old")


def stage_and_swap(df: DataFrame, name: str, partition_by: tuple = ()) -> None:
    """A5 + A11: write ``name__staging``, then swap it in by rename.

    The frame may read the live table (keyed replacement): the staging write
    is complete before the live table is dropped, so the swap never reads and
    overwrites the same files in one plan.  Whatever step an earlier call was
    stopped at, ``recover`` has put a whole table in place first.
    """
    stage(df, name, partition_by)
    swap(df.sparkSession, name)


def write_replace(df: DataFrame, name: str, partition_by: tuple = (),
                  allow_empty: bool = False) -> bool:
    """A5 + A9: replace the table unless the result is empty; returns True if written.

    The result is computed once: it is staged, and an empty staging table is dropped."""
    spark = df.sparkSession
    staged = stage(df, name, partition_by)
    if not allow_empty and skip_if_empty(spark.table(staged)):
        spark.sql(f"DROP TABLE {staged}")
        return False
    swap(spark, name)
    return True


def to_json_columns(df: DataFrame, columns: tuple) -> DataFrame:
    """Render nested array columns as JSON text at a sink, keeping NULL members."""
    out = df
    for c in columns:
        out = out.withColumn(c, F.to_json(F.col(c), {"ignoreNullFields": "false"}))
    return out


# Output orders (F1): by user; then subject and lesson, with ids to settle ties.
ORDERS: dict[str, tuple[str, ...]] = {
    "user_snapshot": ("user_id",),
    "lesson_progress": ("user_id", "subject_order", "subject_id", "lesson_order", "lesson_id"),
    "subject_progress": ("user_id", "subject_order", "subject_id"),
    "be_responses": ("user_id", "stage", "question_position"),
}


def stage_rank(stage: str = "stage") -> Column:
    """the stages in their own order, anything else after them."""
    rank = F.lit(len(C.STAGES))
    for k, name in reversed(list(enumerate(C.STAGES))):
        rank = F.when(F.col(stage) == name, k).otherwise(rank)
    return rank


def write_ordered(df: DataFrame, path: str, order: tuple, files: int | None = None, fmt: str = "parquet",
                  **options) -> None:
    """F1 / F2: a sorted result, written in parallel.  Ranges of the order go to one file each and are sorted
    within, and files are named by range: read in the order of their names they give the whole order.
    NULLs come first.  ``order``: columns or expressions; a complete order (ending in a key) also splits a
    user who holds a large share of the rows over several files."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *by).sortWithinPartitions(*by)
     .write.mode("overwrite").format(fmt).options(**options).save(path))


def write_csv(df: DataFrame, path: str, gzip: bool = False, nested: tuple = ()) -> None:
    """A10: CSV with header, optional gzip; nested columns are written as JSON text."""
    w = to_json_columns(df, nested).write.mode("overwrite").option("header", True)
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)
