"""Build a Sources object from hand-written rows (other tables empty, same schemas)."""

from __future__ import annotations

from pyspark.sql.types import StructField, StructType

from lessonlens.sources.fixtures import TABLES, Sources

_SCHEMAS: dict = {}


def schemas(real: Sources) -> dict:
    if not _SCHEMAS:
        for name in TABLES:
            _SCHEMAS[name] = StructType([StructField(f.name, f.dataType, True)
                                         for f in getattr(real, name).schema.fields])
    return _SCHEMAS


def make_sources(spark, real: Sources, tag: str, **tables) -> Sources:
    """``tables`` maps a source table to a list of dicts (missing columns = NULL)."""
    sch = schemas(real)
    src = Sources(spark, f"unit://{tag}")
    for name in TABLES:
        rows = tables.get(name, [])
        fields = [f.name for f in sch[name].fields]
        data = [tuple(r.get(f) for f in fields) for r in rows]
        src.__dict__[name] = spark.createDataFrame(data, sch[name])
    return src
