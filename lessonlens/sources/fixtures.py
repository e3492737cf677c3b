"""The learning-management source tables, derived from the base tables.

The derivation rules are the ones written down in FIXTURES.md §2 (modulus rules
that give every nullable flag a NULL, every soft delete a hit and every gate a
pass and a fail).  In a deployment these DataFrames come from the real source
tables instead (``spark.read.jdbc`` / parquet); every operator takes them
through :class:`Sources`, so nothing downstream knows the difference.

All ids are BIGINT, flags INT, scores DECIMAL(10,2), times TIMESTAMP_NTZ.

The mapping tables of FIXTURES.md are defined as filtered products of two or
three dimension tables (nation / region / subjects / batches / phases /
projects / languages, at most 50 rows each at every scale factor); those are
the only cross joins in the code base and none touches a table that grows
with the data.
"""

from __future__ import annotations

import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonlens.session import deal, ensure_checkpoint_dir
from lessonlens.sources.base import read_base

SOFT_DELETE_TS = "2002-01-01 00:00:00"
QUESTION_CREATED_TS = "2001-01-01 00:00:00"
# Day of a row's last change, in tables that are laid out by it.
CHANGED_DAY = "changed_day"


def _ts(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def _big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _flag(cond: Column, yes: int = 1, no: int | None = 0) -> Column:
    out = F.when(cond, F.lit(yes))
    return (out.otherwise(F.lit(no)) if no is not None else out).cast("int")


class Sources:
    """Lazily built source tables for one scale-factor directory.

    Attributes are plain DataFrames (not cached): Catalyst prunes columns and
    pushes filters through them into the parquet scans of each query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run = uuid.uuid4().hex         # what is derived from these sources is theirs alone

    def derived_at(self, name: str) -> str:
        """Folder for a product of these sources, beside the session's checkpoints."""
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/lessonlens_sources/{self.run}/{name}"

    def base(self, name: str, *cols: str) -> DataFrame:
        return read_base(self.spark, self.sf_dir, name, *cols)

    @cached_property
    def log_rows(self) -> int:
        """Rows of the largest log, by which exchanges are sized."""
        return self.learning_activities.count()

    # -- helpers -----------------------------------------------------------
    def folded(self, table: str, key: str, k: int) -> DataFrame:
        """The distinct values ``n`` of ``key % k`` over all rows of a table."""
        return self.base(table, key).select((F.col(key) % k).alias("n")).distinct()

    @cached_property
    def _order_span(self) -> DataFrame:
        return (self.base("orders", "o_custkey", "o_orderdate")
                .groupBy("o_custkey")
                .agg(F.min("o_orderdate").alias("created_at"),
                     F.max("o_orderdate").alias("updated_at")))

    # -- people ------------------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        c = F.col("c_custkey")
        cust = self.base("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        return (cust.join(self._order_span, cust.c_custkey == F.col("o_custkey"), "left")
                .select(
                    _big(c).alias("id"),
                    F.col("c_name").alias("name"),
                    _null("string").alias("email"),
                    _null("string").alias("mobile"),
                    F.when(c % 20 == 0, 1).when((c % 20).isin(1, 2), 2)
                     .when(c % 20 == 3, 4).otherwise(3).cast("int").alias("type"),
                    F.when(c % 20 == 2, 1).when(c % 40 == 1, None).otherwise(0)
                     .cast("int").alias("is_master_trainer"),
                    F.when(c % 97 == 0, None).otherwise(F.col("c_nationkey"))
                     .cast("bigint").alias("centre_id"),
                    _null("bigint").alias("project_id"),
                    _big(F.col("c_nationkey") % 5).alias("organisation_id"),
                    F.when(c % 3 == 0, 1).when(c % 3 == 1, 0).cast("int").alias("is_ple"),
                    _flag(c % 31 == 0, 0, 1).alias("status"),
                    F.when(c % 4 == 0, "male").when(c % 4 == 1, "FEMALE")
                     .when(c % 4 == 2, "x").alias("gender"),
                    F.col("c_mktsegment").alias("created_platform"),
                    "created_at", "updated_at",
                    F.when(c % 37 == 0, _ts(SOFT_DELETE_TS)).alias("deleted_at"),
                ))

    @cached_property
    def student_details(self) -> DataFrame:
        c = F.col("c_custkey")
        cust = (self.base("customer", "c_custkey", "c_nationkey")
                .where((F.col("c_custkey") % 20 >= 3) & (F.col("c_custkey") % 11 != 0))
                # some learners have a second profile, in the centre's other batch
                .withColumn("twin", F.explode(F.when(c % 50 == 8, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))))
        return (cust.join(self._order_span, cust.c_custkey == F.col("o_custkey"), "left")
                .select(
                    _big(c).alias("user_id"),
                    F.when(c % 3 == 2, None).otherwise(F.col("c_nationkey") * 10 + (c + F.col("twin")) % 2)
                     .cast("bigint").alias("batch_id"),
                    F.when(c % 5 == 0, c % 6).cast("bigint").alias("trade_id"),
                    F.when(c % 7 == 0, F.lit("Female")).alias("gender"),
                    _big(c % 9).alias("educational_qualification_id"),
                    _big(c % 4).alias("placement_status_id"),
                    (2000 + c % 2).cast("int").alias("active_year"),
                    (1998 + c % 3).cast("int").alias("year_of_admission"),
                    "created_at", "updated_at",
                ))

    @cached_property
    def login_logs(self) -> DataFrame:
        return self.base("events", "user_id", "ts").select(
            _big("user_id").alias("user_id"), F.col("ts").alias("created_at"))

    # -- places ------------------------------------------------------------
    @cached_property
    def centres(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.base("nation", "n_nationkey", "n_name", "n_regionkey").select(
            _big(n).alias("id"),
            F.col("n_name").alias("name"),
            _big("n_regionkey").alias("organisation_id"),
            _big(n % 3).alias("centre_type_id"),
            (n % 2).cast("int").alias("ple_enabled"),
            _flag(n == 24, 0, 1).alias("status"),
            _big("n_regionkey").alias("state_id"),
            _big(n).alias("district_id"),
            F.when(n == 23, _ts(SOFT_DELETE_TS)).alias("deleted_at"),
        )

    @cached_property
    def organisations(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.base("region", "r_regionkey", "r_name").select(
            _big(r).alias("id"), F.col("r_name").alias("name"),
            _flag(r == 3, 0, 1).alias("status"),
            _null("timestamp_ntz").alias("deleted_at"))

    @cached_property
    def states(self) -> DataFrame:
        return self.base("region", "r_regionkey", "r_name").select(
            _big("r_regionkey").alias("id"), F.col("r_name").alias("name"))

    @cached_property
    def districts(self) -> DataFrame:
        return self.base("nation", "n_nationkey", "n_name").select(
            _big("n_nationkey").alias("id"), F.col("n_name").alias("name"))

    @cached_property
    def centre_types(self) -> DataFrame:
        k = F.col("n_nationkey") % 3
        return (self.base("nation", "n_nationkey")
                .select(_big(k).alias("id"),
                        F.when(k == 0, "iti").when(k == 1, "ngo").otherwise("vti").alias("type"),
                        F.concat(F.lit("Type "), k.cast("string")).alias("name"))
                .distinct())

    # -- curriculum --------------------------------------------------------
    @cached_property
    def subjects(self) -> DataFrame:
        b = F.col("b")
        brands = (self.base("part", "p_brand").distinct()
                  .select("p_brand",
                          F.regexp_replace("p_brand", "Brand#", "").cast("int").alias("b")))
        return brands.select(
            _big(b).alias("id"), F.col("p_brand").alias("name"),
            (b % 3).cast("int").alias("is_ple"),
            _null("bigint").alias("ple_career_path_id"),
            F.when(b % 4 == 0, None).otherwise(b % 4 - 1).cast("int").alias("year_to_map"),
            _flag(b == 25, 0, 1).alias("status"),
            F.when(b == 24, _ts(SOFT_DELETE_TS)).alias("deleted_at"))

    @cached_property
    def lessons(self) -> DataFrame:
        # every part row reaches the lesson its activity rows are booked on (l_partkey % 500)
        p = F.col("p")
        return (self.base("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
                .groupBy((F.col("p_partkey") % 500).alias("p"))
                .agg(*[F.min(c).alias(c) for c in ("p_name", "p_brand", "p_type", "p_size")])
                .select(
                    _big(p).alias("id"),
                    F.when(p % 13 == 0, F.concat("p_name", F.lit(" assessment")))
                     .otherwise(F.col("p_name")).alias("name"),
                    F.regexp_replace("p_brand", "Brand#", "").cast("bigint").alias("subject_id"),
                    F.col("p_size").cast("int").alias("lesson_order"),
                    _flag(p % 10 == 0).alias("is_assessment"),
                    _flag(p % 8 == 0, 0, 1).alias("student_access"),
                    (p % 2).cast("int").alias("facilitator_access"),
                    _flag(p % 3 == 0).alias("mastertrainer_access"),
                    _flag(p % 29 == 0).cast("bigint").alias("lesson_category_id"),
                    F.col("p_type").alias("lesson_type_id"),
                    _flag(p % 41 == 0, 0, 1).alias("status"),
                    F.when(p % 43 == 0, _ts(SOFT_DELETE_TS)).alias("deleted_at")))

    @cached_property
    def lesson_types(self) -> DataFrame:
        t = F.col("p_type")
        return (self.base("part", "p_type").where(t != "PROMO").distinct()
                .select(t.alias("id"),
                        F.when(t == "SMALL", " PDF ").when(t == "LARGE", "mp4")
                         .when(t == "STANDARD", "Pdf Web").when(t == "MEDIUM", "quiz")
                         .otherwise("video").alias("name")))

    @cached_property
    def centre_subject(self) -> DataFrame:
        n = self.base("nation", "n_nationkey")
        s = self.subjects.select(F.col("id").alias("sid"))
        return (n.crossJoin(s).where((F.col("n_nationkey") + F.col("sid")) % 3 != 0)
                .select(_big("n_nationkey").alias("centre_id"),
                        F.col("sid").alias("subject_id"),
                        F.col("sid").cast("int").alias("subject_order")))

    # -- cohorts -----------------------------------------------------------
    @cached_property
    def batches(self) -> DataFrame:
        b = F.col("batch_id")
        return (self.student_details.select("batch_id").where(b.isNotNull()).distinct()
                .select(b.alias("id"),
                        F.concat(F.lit("Batch "), b.cast("string")).alias("name"),
                        F.when(b % 70 == 0, 4).otherwise(1).cast("int").alias("status"),
                        F.when(b % 110 == 1, _ts(SOFT_DELETE_TS)).alias("deleted_at")))

    @cached_property
    def batch_subject(self) -> DataFrame:
        b = self.batches.select(F.col("id").alias("batch_id"))
        s = self.subjects.select(F.col("id").alias("subject_id"))
        return b.crossJoin(s).where((F.col("batch_id") + F.col("subject_id")) % 4 != 0)

    @cached_property
    def trades(self) -> DataFrame:
        k = F.col("c_custkey") % 6
        return (self.base("customer", "c_custkey")
                .select(_big(k).alias("id"),
                        F.concat(F.lit("Trade "), k.cast("string")).alias("name"),
                        F.when(k == 0, None).otherwise(1 + F.col("c_custkey") % 2)
                         .cast("int").alias("duration"))
                .distinct())

    @cached_property
    def subject_trade(self) -> DataFrame:
        t = self.trades.select(F.col("id").alias("trade_id"))
        s = self.subjects.select(F.col("id").alias("subject_id"))
        return t.crossJoin(s).where((F.col("trade_id") + F.col("subject_id")) % 2 == 0)

    # -- activity ----------------------------------------------------------
    @cached_property
    def learning_activities(self) -> DataFrame:
        li = self.base("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                       "l_linestatus", "l_shipdate")
        o = self.base("orders", "o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(
                    _big("o_custkey").alias("user_id"),
                    _big(F.col("l_partkey") % 500).alias("lesson_id"),
                    _flag(F.col("l_linestatus") == "F").alias("completed"),
                    (F.col("l_quantity") * 2).cast("decimal(10,2)").alias("score"),
                    F.when(F.col("l_linenumber") == 7, None)
                     .otherwise(F.col("l_linenumber") % 5 + 1).cast("decimal(10,2)").alias("rating"),
                    (F.col("l_quantity").cast("int") * 60).cast("int").alias("duration"),
                    F.col("l_shipdate").alias("created_at"),
                    F.col("l_shipdate").alias("updated_at")))

    @cached_property
    def facilitator_learning_activities(self) -> DataFrame:
        return self.learning_activities.where(F.col("lesson_id") % 2 == 1)

    # -- career path -------------------------------------------------------
    @cached_property
    def ple_career_paths(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.base("region", "r_regionkey", "r_name").select(
            _big(r).alias("id"), F.col("r_name").alias("name"),
            F.when(r == 4, _ts(SOFT_DELETE_TS)).alias("deleted_at"))

    @cached_property
    def ple_career_path_user(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.base("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").select(
            _big(k).alias("id"), _big("o_custkey").alias("user_id"),
            _big(k % 5).alias("job_type_id"),
            _flag(F.col("o_orderstatus") == "P", 0, 1).alias("status"),
            F.col("o_orderdate").alias("updated_at"),
            F.when(k % 17 == 0, F.col("o_orderdate")).alias("deleted_at"))

    @cached_property
    def subject_ple_career_path(self) -> DataFrame:
        r = self.base("region", "r_regionkey").select(_big("r_regionkey").alias("ple_career_path_id"))
        s = self.subjects.select(F.col("id").alias("subject_id"))
        return r.crossJoin(s).where((F.col("ple_career_path_id") + F.col("subject_id")) % 2 == 0)

    # -- programme and phase -----------------------------------------------
    @cached_property
    def programs(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.base("region", "r_regionkey", "r_name").select(
            _big(r).alias("id"),
            F.when(r == 0, "Program A").when(r == 1, "Program B").otherwise(F.col("r_name")).alias("name"),
            _flag(r == 4, 0, 1).alias("status"),
            _null("timestamp_ntz").alias("deleted_at"))

    @cached_property
    def projects(self) -> DataFrame:
        n = F.col("n")
        return (self.base("nation", "n_nationkey", "n_name", "n_regionkey")
                .groupBy((F.col("n_nationkey") % 10).alias("n"))
                .agg(F.min("n_name").alias("n_name"), F.min("n_regionkey").alias("n_regionkey"))
                .select(_big(n).alias("id"), _big("n_regionkey").alias("program_id"),
                        F.concat(F.lit("Project "), F.col("n_name")).alias("name"),
                        _flag(n == 9, 0, 1).alias("status"),
                        _null("timestamp_ntz").alias("deleted_at")))

    @cached_property
    def centre_project(self) -> DataFrame:
        n = self.base("nation", "n_nationkey").select(_big("n_nationkey").alias("centre_id"))
        p = self.projects.select(F.col("id").alias("project_id"))
        return n.crossJoin(p).where((F.col("centre_id") + F.col("project_id")) % 5 == 0)

    @cached_property
    def phases(self) -> DataFrame:
        n = F.col("n")
        return (self.folded("nation", "n_nationkey", 6)
                .select(_big(n).alias("id"),
                        F.concat(F.lit("Phase_"), n.cast("string")).alias("name"),
                        _null("timestamp_ntz").alias("deleted_at")))

    @cached_property
    def phase_project(self) -> DataFrame:
        ph = self.phases.select(F.col("id").alias("phase_id"))
        p = self.projects.select(F.col("id").alias("project_id"))
        return ph.crossJoin(p).where((F.col("phase_id") + F.col("project_id")) % 2 == 0)

    @cached_property
    def centre_phase(self) -> DataFrame:
        n = self.base("nation", "n_nationkey").select(_big("n_nationkey").alias("centre_id"))
        ph = self.phases.select(F.col("id").alias("phase_id"))
        return (n.crossJoin(ph).where((F.col("centre_id") + F.col("phase_id")) % 2 == 0)
                .select("centre_id", "phase_id",
                        F.when(F.col("centre_id") == 3, _ts(SOFT_DELETE_TS)).alias("deleted_at")))

    @cached_property
    def batch_phase(self) -> DataFrame:
        b = self.batches.select(F.col("id").alias("batch_id"))
        ph = self.phases.select(F.col("id").alias("phase_id"))
        return (b.crossJoin(ph).where((F.col("batch_id") + F.col("phase_id")) % 3 == 0)
                .select("batch_id", "phase_id", _null("timestamp_ntz").alias("deleted_at")))

    @cached_property
    def phase_users(self) -> DataFrame:
        c = F.col("c_custkey")
        return (self.base("customer", "c_custkey")
                .select(_big(c).alias("user_id"), _big(c % 6).alias("phase_id"),
                        F.when((c % 23 == 0) | (c % 2 == 1), _ts(SOFT_DELETE_TS)).alias("deleted_at")))

    # -- assessments -------------------------------------------------------
    @cached_property
    def languages(self) -> DataFrame:
        return (self.base("region", "r_regionkey", "r_name")
                .groupBy((F.col("r_regionkey") % 3).alias("r")).agg(F.min("r_name").alias("name"))
                .select(_big("r").alias("id"), "name"))

    @cached_property
    def ple_assessments(self) -> DataFrame:
        n = F.col("n")
        return (self.folded("nation", "n_nationkey", 6)
                .select(_big(n).alias("id"),
                        F.when(n < 3, "baseline").otherwise("endline").alias("stage"),
                        F.concat(F.lit("Pathway "), (n % 3).cast("string")).alias("pathway"),
                        _null("string").alias("title"),
                        _null("timestamp_ntz").alias("deleted_at")))

    @cached_property
    def ple_assessment_pages(self) -> DataFrame:
        a = self.ple_assessments.select(F.col("id").alias("aid"))
        n = self.folded("nation", "n_nationkey", 2)
        return a.crossJoin(n).select(
            _big(F.col("aid") * 10 + F.col("n")).alias("id"),
            F.col("aid").alias("assessment_id"),
            F.concat(F.lit("Page "), F.col("n").cast("string")).alias("page_title"),
            F.col("n").cast("int").alias("sort_order"),
            _null("timestamp_ntz").alias("deleted_at"))

    @cached_property
    def ple_assessment_questions(self) -> DataFrame:
        pg = self.ple_assessment_pages.select(
            F.col("id").alias("pg_id"), F.col("assessment_id").alias("pg_aid"),
            F.col("sort_order").alias("pg_sort"))
        lang = self.languages.select(F.col("id").alias("lang_id"), F.col("name").alias("lang_name"))
        n = self.folded("nation", "n_nationkey", 4)
        k = F.col("n")
        return (pg.crossJoin(lang).crossJoin(n).where(F.col("pg_sort") == k % 2)
                .select(
                    _big(F.col("pg_aid") * 100 + F.col("lang_id") * 10 + k).alias("id"),
                    F.col("pg_id").alias("assessment_page_id"),
                    F.col("lang_id").alias("language_id"),
                    F.concat(F.lit("Q"), k.cast("string"), F.lit(" "), F.col("lang_name")).alias("question"),
                    _null("string").alias("question_type"),
                    _null("string").alias("option_type"),
                    _null("string").alias("response_type"),
                    F.lit(1).cast("int").alias("sort_order"),
                    _ts(QUESTION_CREATED_TS).alias("created_at"),
                    _null("timestamp_ntz").alias("deleted_at")))

    @cached_property
    def ple_assessment_options(self) -> DataFrame:
        q = self.ple_assessment_questions.select(F.col("id").alias("qid"))
        n = self.folded("nation", "n_nationkey", 4)
        k = F.col("n")
        return q.crossJoin(n).select(
            _big(F.col("qid") * 10 + k).alias("id"),
            F.col("qid").alias("assessment_question_id"),
            # the last option of every fifth question stands where another does
            F.when((k == 3) & (F.col("qid") % 5 == 0), 1).otherwise(k).cast("int").alias("sort_order"),
            F.concat(F.lit("Option "), k.cast("string")).alias("opt"),
            _flag(k == 1).alias("is_correct_option"),
            (k.cast("decimal(10,2)") / 2).cast("decimal(10,2)").alias("score"),
            _null("timestamp_ntz").alias("deleted_at"))

    @cached_property
    def ple_assessment_responses(self) -> DataFrame:
        e = self.base("events", "event_id", "ts", "user_id", "event_type", "value")
        et, uid, eid = F.col("event_type"), F.col("user_id"), F.col("event_id")
        # users without an attempt have theirs withdrawn, not left out
        gone = F.when(et == "signup", uid % 5 == 0).otherwise(uid % 4 == 0)
        return e.where(et.isin("signup", "purchase")).select(
            _big(eid).alias("id"), _big(uid).alias("user_id"),
            F.when(et == "signup", uid % 3).otherwise(3 + eid % 3).cast("bigint").alias("assessment_id"),
            _flag(F.col("value") > 5).alias("is_complete"),
            F.col("value").cast("decimal(10,2)").alias("final_score"),
            _null("decimal(10,2)").alias("rating"),
            F.col("ts").alias("created_at"),
            F.when(eid % 3 == 0, None).otherwise(F.col("ts")).alias("updated_at"),
            F.when(gone, _ts(SOFT_DELETE_TS)).alias("deleted_at"))

    @cached_property
    def ple_assessment_response_keys(self) -> DataFrame:
        r = self.ple_assessment_responses.select(
            F.col("id").alias("rid"), F.col("user_id").alias("ruid"),
            F.col("assessment_id").alias("raid"))
        pg = self.ple_assessment_pages.select(F.col("id").alias("pgid"),
                                              F.col("assessment_id").alias("pgaid"))
        q = self.ple_assessment_questions.select(
            F.col("id").alias("qid"), F.col("assessment_page_id").alias("qpg"),
            F.col("language_id").alias("qlang"))
        j = (r.join(pg, F.col("pgaid") == F.col("raid"))
             .join(q, (F.col("qpg") == F.col("pgid")) & (F.col("qlang") == F.col("ruid") % 3)))
        mix = (F.col("rid") + F.col("qid"))
        free = mix % 4 == 3
        return j.select(
            F.col("rid").alias("assessment_responses_id"),
            F.col("qid").alias("assessment_question_id"),
            F.when(free, None).otherwise(F.col("qid") * 10 + mix % 3)
             .cast("bigint").alias("assessment_option_id"),
            F.when(free, F.when(F.col("rid") % 3 == 0, " . ")
                   .when(F.col("rid") % 3 == 1, " free text ").otherwise("")).alias("response_text"),
            _null("timestamp_ntz").alias("deleted_at"))


_SOURCES: dict[tuple, "Sources"] = {}
_SOURCES_LOCK = threading.Lock()


def materialize(src: Sources) -> Sources:
    """Write every derived source table once to parquet and read it back.

    The tables go to ``<spark.checkpoint.dir>/lessonlens_sources/<run>/`` — the
    shared folder the cluster names (a scratch folder only in local tests) —
    so queries read plain parquet tables, as they would read the real source
    tables, and survive executor loss.  A table derived from another is read from it.  Returns a
    new :class:`Sources`.
    """
    out = Sources(src.spark, src.sf_dir)
    deal(src.spark, src.base("lineitem", "l_orderkey").count())

    def store(name: str) -> None:
        path = out.derived_at(name)
        df = getattr(out, name)
        if name not in GROWING_TABLES:
            df = df.repartition(1)      # dimension-sized: one file; the scan above stays parallel
        df.write.mode("overwrite").parquet(path)
        out.__dict__[name] = src.spark.read.parquet(path)

    with ThreadPoolExecutor(4) as some:     # most tables are small: their jobs fill the cluster together
        for names in ([t for t in TABLES if t not in OF_STORED], OF_STORED):
            list(some.map(store, names))
    return out


def use_sources(spark: SparkSession, sf_dir: str, src: Sources) -> None:
    """From now on ``sf_dir`` means ``src``; what was derived from other sources is not used again."""
    with _SOURCES_LOCK:
        for materialized in (True, False):
            _SOURCES[(spark.sparkContext.applicationId, sf_dir, materialized)] = src


def forget_sources(spark: SparkSession, sf_dir: str) -> None:
    """The next run over ``sf_dir`` reads its tables anew (they have changed)."""
    with _SOURCES_LOCK:
        for materialized in (True, False):
            _SOURCES.pop((spark.sparkContext.applicationId, sf_dir, materialized), None)


def sources_for(spark: SparkSession, sf_dir: str, materialized: bool | None = None) -> Sources:
    """The memoised :class:`Sources` of one session and directory.

    By default the derived tables are materialised once per session (set
    ``LESSONLENS_MATERIALIZE=0`` to keep them as lazy derivations).
    """
    if materialized is None:
        materialized = os.environ.get("LESSONLENS_MATERIALIZE", "1") != "0"
    key = (spark.sparkContext.applicationId, sf_dir, materialized)
    with _SOURCES_LOCK:
        src = _SOURCES.get(key)
        if src is None:
            src = Sources(spark, sf_dir)
            if materialized:
                src = materialize(src)
            _SOURCES[key] = src
    deal(spark, src.log_rows)
    return src


# Source tables whose size grows with the data (everything else is dimension-sized).
GROWING_TABLES = frozenset({
    "users", "student_details", "login_logs", "learning_activities",
    "facilitator_learning_activities", "ple_career_path_user", "phase_users",
    "ple_assessment_responses", "ple_assessment_response_keys"})

# Growing tables that are derived from another one.
OF_STORED = ("facilitator_learning_activities", "ple_assessment_response_keys")

TABLES = (
    "users", "student_details", "login_logs", "centres", "organisations", "states",
    "districts", "centre_types", "subjects", "lessons", "lesson_types", "centre_subject",
    "batches", "batch_subject", "trades", "subject_trade", "learning_activities",
    "facilitator_learning_activities", "ple_career_paths", "ple_career_path_user",
    "subject_ple_career_path", "programs", "projects", "centre_project", "phases",
    "phase_project", "centre_phase", "batch_phase", "phase_users", "languages",
    "ple_assessments", "ple_assessment_pages", "ple_assessment_questions",
    "ple_assessment_options", "ple_assessment_responses", "ple_assessment_response_keys",
)
