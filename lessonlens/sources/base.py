"""Readers for the supplied base tables (TPC-H-style parquet)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# One relation per (session, path): file listing and footer/schema reads happen
# once per session instead of once per reference.  The DataFrames stay lazy.
_RELATIONS: dict[tuple, DataFrame] = {}
_LOCK = threading.Lock()


def read_base(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one base table; listing columns keeps the parquet ReadSchema narrow."""
    if name not in BASE_TABLES:
        raise ValueError(f"unknown base table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    with _LOCK:
        df = _RELATIONS.get(key)
    if df is None:
        df = spark.read.parquet(path)
        with _LOCK:
            _RELATIONS[key] = df
    return df.select(*columns) if columns else df
