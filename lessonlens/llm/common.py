"""Helpers shared by the operators: session set-up, checkpoints, Arrow batches, components."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
BATCH_ROWS = 512  # rows of an Arrow batch; whole texts travel, so a batch stays a few MB


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (texts may be very long) and a reliable checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``; a scratch folder is set only
    for a local master that names none (tests).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    # Python workers of a local session import the package from where the driver has it; on a
    # cluster it is installed or sent along (--py-files).
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        named = tempfile.mkdtemp(prefix="llm-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)      # ours alone: a local run's scratch
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Cuts the lineage like a checkpoint, but compressed and column-pruned when read; a lost
    executor loses none of it.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)],
                                      schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``; longs): rows ``node``, ``root``, where
    ``root`` is the smallest node reachable.  Nodes without an edge do not appear.

    Large-star / small-star rounds; every round is a stored table of at most as many rows as
    edges, so a component of any size is never gathered in one task.
    """
    current = stored(edges.where("a <> b")
                     .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct())
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        current = stored(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(small.select("u", F.col("m").alias("v")))
                         .where("u <> v").distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
