"""Id lists: extraction (A3), validation (A4) and restriction (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.operators.joins import bounded_broadcast


def id_list(df: DataFrame, column: str | None = None) -> DataFrame:
    """Column ``id`` (or the first column) as text; NULL and blank dropped, de-duplicated."""
    c = column or ("id" if "id" in df.columns else df.columns[0])
    v = F.col(c).cast("string")
    return (df.select(v.alias("id"))
            .where(F.col("id").isNotNull() & (F.trim(F.col("id")) != ""))
            .distinct())


def validate_ids(df: DataFrame, column: str = "id", pattern: str = C.UUID_PATTERN
                 ) -> tuple[DataFrame, DataFrame]:
    """Split ids by the UUID pattern into (valid, rejected); rejects are kept, not fatal."""
    ok = F.coalesce(F.trim(F.col(column)).rlike(pattern), F.lit(False))
    return df.where(ok), df.where(~ok)


def restrict_ids(df: DataFrame, ids: DataFrame, column: str, id_column: str = "id",
                 size_key: tuple | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the id list: one semi join, the id
    list broadcast only when its size is proven small (no chunking)."""
    keys = ids.select(F.col(id_column).alias(column)).distinct()
    return df.join(bounded_broadcast(keys, size_key), column, "left_semi")
