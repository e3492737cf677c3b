"""Named source tables: where a deployment's tables lie and what they must hold.

A deployment names, for each of the source tables, a catalogue table or files (``Location``), with
the stored names of columns that are called otherwise there.  ``load`` checks what it finds
against the declared schema before any query runs: a missing column or a type that does not fit
is an error that names table and column.  Reads select the declared columns only, so nothing else
is scanned, and every column has its declared type whatever the store infers.

    src = registered(spark, locations(spark, "hdfs:///etc/lessonlens/sources.json"))
    use_sources(spark, "production", src)        # every registered query then runs on it
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType, StructType, TimestampNTZType, TimestampType)

from lessonlens.sources.fixtures import CHANGED_DAY, TABLES, Sources

# Declared schemas of the source tables.
SCHEMAS: dict[str, str] = {
    "users": (
        "id bigint, name string, email string, mobile string, type int, is_master_trainer int, centre_id bigint, "
        "project_id bigint, organisation_id bigint, is_ple int, status int, gender string, "
        "created_platform string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz"),
    "student_details": (
        "user_id bigint, batch_id bigint, trade_id bigint, gender string, educational_qualification_id bigint, "
        "placement_status_id bigint, active_year int, year_of_admission int, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"),
    "login_logs": "user_id bigint, created_at timestamp_ntz",
    "centres": (
        "id bigint, name string, organisation_id bigint, centre_type_id bigint, ple_enabled int, status int, "
        "state_id bigint, district_id bigint, deleted_at timestamp_ntz"),
    "organisations": "id bigint, name string, status int, deleted_at timestamp_ntz",
    "states": "id bigint, name string",
    "districts": "id bigint, name string",
    "centre_types": "id bigint, type string, name string",
    "subjects": (
        "id bigint, name string, is_ple int, ple_career_path_id bigint, year_to_map int, status int, "
        "deleted_at timestamp_ntz"),
    "lessons": (
        "id bigint, name string, subject_id bigint, lesson_order int, is_assessment int, student_access int, "
        "facilitator_access int, mastertrainer_access int, lesson_category_id bigint, lesson_type_id string, "
        "status int, deleted_at timestamp_ntz"),
    "lesson_types": "id string, name string",
    "centre_subject": "centre_id bigint, subject_id bigint, subject_order int",
    "batches": "id bigint, name string, status int, deleted_at timestamp_ntz",
    "batch_subject": "batch_id bigint, subject_id bigint",
    "trades": "id bigint, name string, duration int",
    "subject_trade": "trade_id bigint, subject_id bigint",
    "learning_activities": (
        "user_id bigint, lesson_id bigint, completed int, score decimal(10,2), rating decimal(10,2), "
        "duration int, created_at timestamp_ntz, updated_at timestamp_ntz"),
    "facilitator_learning_activities": (
        "user_id bigint, lesson_id bigint, completed int, score decimal(10,2), rating decimal(10,2), "
        "duration int, created_at timestamp_ntz, updated_at timestamp_ntz"),
    "ple_career_paths": "id bigint, name string, deleted_at timestamp_ntz",
    "ple_career_path_user": (
        "id bigint, user_id bigint, job_type_id bigint, status int, updated_at timestamp_ntz, "
        "deleted_at timestamp_ntz"),
    "subject_ple_career_path": "ple_career_path_id bigint, subject_id bigint",
    "programs": "id bigint, name string, status int, deleted_at timestamp_ntz",
    "projects": "id bigint, program_id bigint, name string, status int, deleted_at timestamp_ntz",
    "centre_project": "centre_id bigint, project_id bigint",
    "phases": "id bigint, name string, deleted_at timestamp_ntz",
    "phase_project": "phase_id bigint, project_id bigint",
    "centre_phase": "centre_id bigint, phase_id bigint, deleted_at timestamp_ntz",
    "batch_phase": "batch_id bigint, phase_id bigint, deleted_at timestamp_ntz",
    "phase_users": "user_id bigint, phase_id bigint, deleted_at timestamp_ntz",
    "languages": "id bigint, name string",
    "ple_assessments": "id bigint, stage string, pathway string, title string, deleted_at timestamp_ntz",
    "ple_assessment_pages": (
        "id bigint, assessment_id bigint, page_title string, sort_order int, deleted_at timestamp_ntz"),
    "ple_assessment_questions": (
        "id bigint, assessment_page_id bigint, language_id bigint, question string, question_type string, "
        "option_type string, response_type string, sort_order int, created_at timestamp_ntz, "
        "deleted_at timestamp_ntz"),
    "ple_assessment_options": (
        "id bigint, assessment_question_id bigint, sort_order int, opt string, is_correct_option int, "
        "score decimal(10,2), deleted_at timestamp_ntz"),
    "ple_assessment_responses": (
        "id bigint, user_id bigint, assessment_id bigint, is_complete int, final_score decimal(10,2), "
        "rating decimal(10,2), created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz"),
    "ple_assessment_response_keys": (
        "assessment_responses_id bigint, assessment_question_id bigint, assessment_option_id bigint, "
        "response_text string, deleted_at timestamp_ntz"),
}

# Compares text regardless of case, accents and trailing blanks.
LOOSE = "UNICODE_CI_AI_RTRIM"

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


class SourceError(ValueError):
    """A source table is not what is declared."""


@dataclass(frozen=True)
class Location:
    """``table`` (of the catalogue) or ``path`` with ``format`` and reader ``options``; ``columns``: stored name by
    declared name, where they differ; ``absent``: declared columns the store does not have (read as NULL);
    ``collate``: collation by declared text column, with which it then compares and joins; ``day``: stored column
    (a partition column, for it to help) with the day of a row's last change, neither before its
    ``created_at`` nor its ``updated_at``: change scans then read the days from their cutoff on."""
    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    columns: dict[str, str] = field(default_factory=dict)
    absent: tuple[str, ...] = ()
    collate: dict[str, str] = field(default_factory=dict)
    day: str | None = None


def declared(name: str) -> StructType:
    if name not in SCHEMAS:
        raise SourceError(f"unknown source table {name!r}")
    return StructType.fromDDL(SCHEMAS[name])


def fits(found: DataType, wanted: DataType) -> bool:
    """Whether every value of ``found`` that is in the range of ``wanted`` reads as itself.  Whole numbers
    beyond the range fail when they are read (ANSI casts), they are not cut."""
    if isinstance(wanted, StringType):
        return isinstance(found, StringType)
    if isinstance(wanted, _WHOLE):
        return isinstance(found, _WHOLE) or isinstance(found, DecimalType) and found.scale == 0
    if isinstance(wanted, DecimalType):
        return isinstance(found, _WHOLE) or isinstance(found, DecimalType) and found.scale <= wanted.scale
    if isinstance(wanted, (DoubleType, FloatType)):
        return isinstance(found, (DoubleType, FloatType, DecimalType, *_WHOLE))
    if isinstance(wanted, (TimestampNTZType, TimestampType)):
        return isinstance(found, (TimestampNTZType, TimestampType, DateType))
    return found == wanted


def load(spark: SparkSession, name: str, at: Location) -> DataFrame:
    """The table ``name`` with its declared columns, checked against what is stored at ``at``."""
    schema = declared(name)
    where = at.table or at.path
    if (at.table is None) == (at.path is None):
        raise SourceError(f"{name}: give a catalogue table or a path")
    stray = sorted((set(at.columns) | set(at.absent) | set(at.collate)) - set(schema.fieldNames()))
    if stray:
        raise SourceError(f"{name}: not declared: {', '.join(stray)}")
    raw = spark.table(at.table) if at.table else spark.read.format(at.format).options(**at.options).load(at.path)
    there = {f.name.lower(): f for f in raw.schema.fields}
    stored = {c: at.columns.get(c, c) for c in schema.fieldNames() if c not in at.absent}
    if at.day is not None and at.day.lower() not in there:
        raise SourceError(f"{name}: {where} has no {at.day}; it has {', '.join(raw.columns)}")
    missing = [f"{c} (as {s})" if s != c else c for c, s in stored.items() if s.lower() not in there]
    if missing:
        raise SourceError(f"{name}: {where} has no {', '.join(missing)}; it has {', '.join(raw.columns)}")
    wrong = [f"{c} is {there[s.lower()].dataType.simpleString()}, not {schema[c].dataType.simpleString()}"
             for c, s in stored.items() if not fits(there[s.lower()].dataType, schema[c].dataType)]
    if wrong:
        raise SourceError(f"{name}: in {where} {'; '.join(wrong)}")
    out = []
    for f in schema.fields:
        value = F.lit(None) if f.name in at.absent else raw[there[stored[f.name].lower()].name]
        value = value.cast(f.dataType)
        if f.name in at.collate:
            value = F.collate(value, at.collate[f.name])
        out.append(value.alias(f.name))
    if at.day is not None:
        out.append(raw[there[at.day.lower()].name].cast("date").alias(CHANGED_DAY))
    return raw.select(*out)


def write_by_day(df: DataFrame, path: str) -> Location:
    """Files of ``df`` (with ``created_at`` and ``updated_at``) laid out by the day of the last change, one directory a
    day; days that hold much are split over files."""
    changed = F.greatest("created_at", "updated_at").cast("date")        # of one alone if the other is NULL
    (df.withColumn("day", changed).hint("rebalance", "day")
     .write.mode("overwrite").partitionBy("day").parquet(path))
    return Location(path=path, day="day")


def locations(spark: SparkSession, path: str) -> dict[str, Location]:
    """Locations from a JSON file, by table: the fields of :class:`Location`.  Read by Spark, so the file may
    lie wherever the tables lie."""
    said = json.loads(spark.read.text(path, wholetext=True).first()[0])
    try:
        return {name: Location(**{k: tuple(v) if k == "absent" else v for k, v in at.items()}) for name, at in said.items()}
    except TypeError as e:
        raise SourceError(f"{path}: {e}") from None


def registered(spark: SparkSession, at: dict[str, Location], base_dir: str = "") -> Sources:
    """:class:`Sources` over the tables at their locations; all of them must be named.  ``base_dir``: folder
    of the base tables, for the few queries that read those."""
    unnamed = [n for n in TABLES if n not in at]
    if unnamed:
        raise SourceError(f"no location for {', '.join(unnamed)}")
    unknown = [n for n in at if n not in TABLES]
    if unknown:
        raise SourceError(f"unknown source tables: {', '.join(unknown)}")
    src = Sources(spark, base_dir)
    for name in TABLES:
        src.__dict__[name] = load(spark, name, at[name])
    return src
