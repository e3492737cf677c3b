"""Baseline / endline assessments.

Every "first attempt" is an aggregate (``min`` of an ordering struct) rather
than a window, so it combines map-side and a user with a huge history never
lands whole in one task.  The question translation is an equi join on the
ordinal position column produced by one small window per (assessment,
language) — bounded by the question count, not by responses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lessonlens import config as C
from lessonlens.config import DEFAULT, Constants
from lessonlens.functions.columns import null_if_blank
from lessonlens.operators.joins import bounded_broadcast, one_plan
from lessonlens.session import checkpoint_partitioned
from lessonlens.sources.fixtures import Sources

BASELINE, ENDLINE = C.STAGES


@dataclass(frozen=True)
class Population:
    """Optional filters of the export (all default to "no restriction" except centre type).

    ``centre_types``: codes allowed at both centre-type join sites (None = all).
    ``window``: half-open registration window applied with type 3/4 (None = off).
    ``paired_only``: keep users with both stages.
    """

    centre_types: tuple | None = DEFAULT.default_centre_types
    window: tuple | None = None
    paired_only: bool = False


DEFAULT_POPULATION = Population()


def _key(src: Sources, name) -> tuple:
    return (src.sf_dir, name)


# -- A15 --------------------------------------------------------------------------
def assessment_set(src: Sources, consts: Constants = DEFAULT) -> DataFrame:
    """The configured (stage, pathway, assessment) rows."""
    return (src.ple_assessments.where(F.col("id").isin(*consts.assessment_ids))
            .select(F.col("stage").alias("assessment_stage"), "pathway",
                    F.col("id").alias("assessment_id")))


def _users(src: Sources, pop: Population) -> DataFrame:
    u = src.users.where(F.col("deleted_at").isNull())
    if pop.window is not None:
        lo, hi = pop.window
        u = u.where(F.col("type").isin(*C.LEARNER_TYPES)
                    & (F.col("created_at") >= F.to_timestamp_ntz(F.lit(lo)))
                    & (F.col("created_at") < F.to_timestamp_ntz(F.lit(hi))))
    return u


def _centre_dims(src: Sources, pop: Population) -> DataFrame:
    ct = src.centre_types.select(F.col("id").alias("centre_type_id"),
                                 F.col("name").alias("centre_type_name"),
                                 F.col("type").alias("centre_type_code"))
    if pop.centre_types is not None:
        ct = ct.where(F.col("centre_type_code").isin(*pop.centre_types))
    st = src.states.select(F.col("id").alias("state_id"), F.col("name").alias("state_name"))
    return (src.centres.select(F.col("id").alias("centre_id"), F.col("name").alias("centre_name"),
                               "state_id", "centre_type_id")
            .join(ct, "centre_type_id").join(st, "state_id", "left"))


# -- B16 ----------------------------------------------------------------------------
def population_window(src: Sources, window: tuple) -> DataFrame:
    """Learners/alumni registered in the half-open window."""
    lo, hi = window
    return (src.users.where(F.col("type").isin(*C.LEARNER_TYPES)
                            & (F.col("created_at") >= F.to_timestamp_ntz(F.lit(lo)))
                            & (F.col("created_at") < F.to_timestamp_ntz(F.lit(hi))))
            .select(F.col("id").alias("user_id")))


# -- J14 ----------------------------------------------------------------------------
@one_plan
def candidates(src: Sources, pop: Population = DEFAULT_POPULATION, consts: Constants = DEFAULT,
               user_ids: DataFrame | None = None) -> DataFrame:
    """Completed, live responses to a configured assessment by a live user whose
    centre has an allowed type (and who passes the population window, if set)."""
    r = src.ple_assessment_responses.where((F.col("is_complete") == 1) & F.col("deleted_at").isNull())
    if user_ids is not None:
        r = r.join(user_ids.select("user_id").distinct(), "user_id", "left_semi")
    aset = bounded_broadcast(assessment_set(src, consts), _key(src, "assessment_set"))
    u = _users(src, pop).select(F.col("id").alias("user_id"), "centre_id")
    centres = bounded_broadcast(_centre_dims(src, pop).select("centre_id"),
                                _key(src, ("be_centres", pop.centre_types)))
    return (r.join(aset, "assessment_id").join(u, "user_id").join(centres, "centre_id")
            .select(F.col("id").alias("assessment_response_id"), "user_id", "assessment_id",
                    "assessment_stage", "pathway",
                    F.col("created_at").alias("response_created_at"),
                    F.coalesce("updated_at", "created_at").alias("completed_at"),
                    "final_score", "rating"))


_ATTEMPT = ["assessment_response_id", "assessment_id", "pathway", "response_created_at",
            "completed_at", "final_score", "rating"]


def _first(df: DataFrame) -> DataFrame:
    """Earliest attempt per user by (completed_at, response id)."""
    best = F.min(F.struct(*[F.col(c) for c in ["completed_at", "assessment_response_id"]
                            + [c for c in _ATTEMPT if c not in ("completed_at",
                                                                 "assessment_response_id")]]))
    return df.groupBy("user_id").agg(best.alias("b")).select(
        "user_id", *[F.col("b." + c).alias(c) for c in _ATTEMPT])


# -- E5 / E6 / C19 ---------------------------------------------------------------------
def first_baseline(cands: DataFrame) -> DataFrame:
    return _first(cands.where(F.col("assessment_stage") == BASELINE))


def first_endline(cands: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Earliest endline strictly after the user's first baseline (any endline if the
    user has no baseline)."""
    b = (first_baseline(cands) if baseline is None else baseline).select(
        "user_id", F.col("completed_at").alias("_b_at"))
    e = cands.where(F.col("assessment_stage") == ENDLINE).join(b, "user_id", "left")
    e = e.where(F.col("_b_at").isNull() | (F.col("completed_at") > F.col("_b_at")))
    return _first(e)


# -- G5 / D14 ------------------------------------------------------------------------
def stage_attempts(fb: DataFrame, fe: DataFrame) -> DataFrame:
    return (fb.withColumn("assessment_stage", F.lit(BASELINE))
            .unionByName(fe.withColumn("assessment_stage", F.lit(ENDLINE))))


def user_status(attempts: DataFrame) -> DataFrame:
    hb = F.max(F.when(F.col("assessment_stage") == BASELINE, 1).otherwise(0))
    he = F.max(F.when(F.col("assessment_stage") == ENDLINE, 1).otherwise(0))
    return (attempts.groupBy("user_id").agg(hb.alias("has_baseline"), he.alias("has_endline"))
            .withColumn("attempt_status",
                        F.when((F.col("has_baseline") == 1) & (F.col("has_endline") == 1),
                               "baseline_and_endline")
                        .when(F.col("has_baseline") == 1, "baseline_only")
                        .otherwise("endline_only")))


def attempt_pairs(cands: DataFrame) -> DataFrame:
    """One row per user with both selected attempts as structs (``fb`` first baseline, ``fe`` first endline
    after it), NULL where there is none: E5, E6 and C19 in one pass.

    A window over the user's attempts tells each the time of the first baseline; one aggregate
    then takes both minima.  On candidates partitioned by user nothing is shuffled."""
    stage, at = F.col("assessment_stage"), F.col("completed_at")
    after = F.min(F.when(stage == BASELINE, at)).over(Window.partitionBy("user_id"))
    attempt = F.struct("completed_at", "assessment_response_id",
                       *[c for c in _ATTEMPT if c not in ("completed_at", "assessment_response_id")])
    later = F.col("_after").isNull() | (at > F.col("_after"))
    return (cands.withColumn("_after", after).groupBy("user_id")
            .agg(F.min(F.when(stage == BASELINE, attempt)).alias("fb"),
                 F.min(F.when((stage == ENDLINE) & later, attempt)).alias("fe"))
            .where(F.col("fb").isNotNull() | F.col("fe").isNotNull()))


def paired_attempts(cands: DataFrame, paired_only: bool = False) -> DataFrame:
    """One row per selected attempt, with the user's status and both sides beside it."""
    pairs = attempt_pairs(cands)
    has_b, has_e = F.col("fb").isNotNull(), F.col("fe").isNotNull()
    if paired_only:
        pairs = pairs.where(has_b & has_e)
    status = (F.when(has_b & has_e, "baseline_and_endline").when(has_b, "baseline_only").otherwise("endline_only"))
    sides = [F.col(f"{side}.{c}").alias(f"{name}_{c}") for side, name in (("fb", "baseline"), ("fe", "endline"))
             for c in ("pathway", "response_created_at", "completed_at", "final_score", "rating")]
    chosen = F.filter(F.array(F.struct(F.lit(BASELINE).alias("assessment_stage"), F.col("fb").alias("a")),
                              F.struct(F.lit(ENDLINE).alias("assessment_stage"), F.col("fe").alias("a"))),
                      lambda x: x["a"].isNotNull())
    return (pairs.select("user_id", has_b.cast("int").alias("has_baseline"), has_e.cast("int").alias("has_endline"),
                         status.alias("attempt_status"), *sides, F.explode(chosen).alias("c"))
            .select("user_id", *[F.col(f"c.a.{c}").alias(c) for c in _ATTEMPT], F.col("c.assessment_stage"),
                    "has_baseline", "has_endline", "attempt_status",
                    *[f"{name}_{c}" for name in ("baseline", "endline")
                      for c in ("pathway", "response_created_at", "completed_at", "final_score", "rating")])
            .withColumnRenamed("response_created_at", "assessment_response_created_at"))


# -- E7 / C17 --------------------------------------------------------------------------
def question_catalog(src: Sources, consts: Constants = DEFAULT) -> DataFrame:
    """Ordinal position of every live question per (assessment, language):
    page order, question order, created_at, id."""
    pg = (src.ple_assessment_pages.where(F.col("deleted_at").isNull()
                                         & F.col("assessment_id").isin(*consts.assessment_ids))
          .select(F.col("id").alias("assessment_page_id"), "assessment_id", "page_title",
                  F.col("sort_order").alias("page_sort_order")))
    q = (src.ple_assessment_questions.where(F.col("deleted_at").isNull())
         .select(F.col("id").alias("question_id"), "assessment_page_id", "language_id", "question",
                 "question_type", "option_type", "response_type",
                 F.col("sort_order").alias("question_sort_order"), F.col("created_at").alias("_qc")))
    w = Window.partitionBy("assessment_id", "language_id").orderBy(
        "page_sort_order", "question_sort_order", "_qc", "question_id")
    return (pg.join(q, "assessment_page_id")
            .withColumn("question_position", F.row_number().over(w).cast("bigint")).drop("_qc"))


def translation(catalog: DataFrame, consts: Constants = DEFAULT) -> DataFrame:
    """C17: each question -> the English question at the same position."""
    en = catalog.where(F.col("language_id") == consts.english_language_id).select(
        "assessment_id", "question_position", F.col("question_id").alias("english_question_id"),
        F.col("question").alias("question_english"))
    return catalog.join(en, ["assessment_id", "question_position"])


# -- D17 ---------------------------------------------------------------------------------
def answer_keys(src: Sources, attempts: DataFrame) -> DataFrame:
    """Distinct live answer rows of the selected attempts, free text normalised."""
    ids = attempts.select(F.col("assessment_response_id").alias("assessment_responses_id")).distinct()
    return (src.ple_assessment_response_keys.where(F.col("deleted_at").isNull())
            .join(ids, "assessment_responses_id", "left_semi")
            .select("assessment_responses_id", "assessment_question_id", "assessment_option_id",
                    null_if_blank("response_text").alias("response_text"))
            .distinct())


def duplicate_option_orders(src: Sources) -> DataFrame:
    """Live options that share their question's ``sort_order`` with another: an answer that is translated
    through them counts once for each (``question_id``, ``sort_order``, ``options``)."""
    return (src.ple_assessment_options.where(F.col("deleted_at").isNull())
            .groupBy(F.col("assessment_question_id").alias("question_id"), "sort_order")
            .agg(F.count(F.lit(1)).cast("bigint").alias("options")).where(F.col("options") > 1))


RESPONSE_COLUMNS = [
    "user_id", "name", "email", "mobile", "gender", "user_registered_at", "centre_id",
    "centre_name", "state_id", "state_name", "centre_type_id", "centre_type_name",
    "centre_type_code", "pathway", "baseline_pathway", "endline_pathway", "attempt_status",
    "has_baseline", "has_endline", "assessment_stage", "assessment_id", "assessment_title",
    "assessment_response_id", "assessment_response_created_at", "completed_at", "final_score",
    "rating", "selected_language_id", "selected_language", "question_position",
    "selected_language_question_id", "english_question_id", "question_english",
    "selected_options_english", "free_text_response", "response_english", "is_correct_option",
    "score", "rounded_score"]


def _ordered_distinct_join(pairs: F.Column, sep: str) -> F.Column:
    """``GROUP_CONCAT(DISTINCT v ORDER BY k SEPARATOR sep)`` over an array of
    (k, v) structs: sort by (k, v), keep each v at its first (smallest k)
    position, join; NULL when there is nothing to join."""
    vals = F.array_distinct(F.transform(F.array_sort(pairs), lambda x: x["v"]))
    return F.when(F.size(vals) > 0, F.array_join(vals, sep))


@one_plan
def responses(src: Sources, pop: Population = DEFAULT_POPULATION, consts: Constants = DEFAULT,
              user_ids: DataFrame | None = None) -> DataFrame:
    """One row per user x selected attempt x answered question, in English.

    Answers are aggregated by (attempt, question), three numbers wide; the names and texts
    that depend on the pair are joined to the aggregated rows.  Duplicate English ``sort_order`` values fan out
    and inflate the sums, as in the reference; ``duplicate_option_orders`` lists them.
    """
    # partitioned by user once and checkpointed: the first-attempt aggregates,
    # the status and the pairing joins are all per user and reuse it
    cands = checkpoint_partitioned(candidates(src, pop, consts, user_ids), "user_id")
    pa = paired_attempts(cands, pop.paired_only)
    users = (src.users.where(F.col("deleted_at").isNull())
             .select(F.col("id").alias("user_id"), "name", "email", "mobile", "gender",
                     F.col("created_at").alias("user_registered_at"), "centre_id"))
    centres = bounded_broadcast(_centre_dims(src, pop), _key(src, ("be_centre_dims", pop.centre_types)))
    titles = (src.ple_assessments.where(F.col("deleted_at").isNull())
              .select(F.col("id").alias("assessment_id"), F.col("title").alias("assessment_title")))
    cat = translation(question_catalog(src, consts), consts)
    langs = src.languages.select(F.col("id").alias("language_id"),
                                 F.col("name").alias("selected_language"))
    cat = bounded_broadcast(cat.join(langs, "language_id"), _key(src, "be_catalog"))
    # one exchange by attempt serves the join, the de-duplication and the aggregate
    keys = (src.ple_assessment_response_keys.where(F.col("deleted_at").isNull())
            .select(F.col("assessment_responses_id").alias("assessment_response_id"),
                    F.col("assessment_question_id").alias("question_id"), "assessment_option_id",
                    null_if_blank("response_text").alias("response_text"))
            .join(pa.select("assessment_response_id", "assessment_id"), "assessment_response_id").distinct())
    opts = src.ple_assessment_options.where(F.col("deleted_at").isNull())
    so = opts.select(F.col("id").alias("assessment_option_id"),
                     F.col("assessment_question_id").alias("question_id"),
                     F.col("sort_order").alias("_so_sort"), F.col("id").alias("_so_id"),
                     F.col("is_correct_option").alias("_so_correct"), F.col("score").alias("_so_score"))
    eo = opts.select(F.col("assessment_question_id").alias("english_question_id"),
                     F.col("sort_order").alias("_so_sort"), F.col("sort_order").alias("_eo_sort"),
                     F.col("opt").alias("_eo_opt"))
    rows = (keys.join(cat.select("question_id", "assessment_id", "english_question_id"), ["question_id", "assessment_id"])
            .join(bounded_broadcast(so, _key(src, "be_options")), ["assessment_option_id", "question_id"], "left")
            .join(bounded_broadcast(eo, _key(src, "be_en_options")), ["english_question_id", "_so_sort"], "left"))
    opt_pair = F.when(F.col("_eo_opt").isNotNull(),
                      F.struct(F.col("_eo_sort").alias("k"), F.col("_eo_opt").alias("v")))
    txt_pair = F.when(F.col("response_text").isNotNull(),
                      F.struct(F.col("response_text").alias("k"), F.col("response_text").alias("v")))
    g = (rows.groupBy("assessment_response_id", "question_id")
         .agg(F.collect_list(opt_pair).alias("_opts"), F.collect_list(txt_pair).alias("_txt"),
              F.count("_so_id").alias("_n"), F.min("_so_correct").alias("_min_correct"),
              F.sum("_so_score").alias("score"),
              F.sum(F.ceil("_so_score")).cast("bigint").alias("rounded_score")))
    g = (g.join(pa, "assessment_response_id").join(cat, ["question_id", "assessment_id"])
         .join(users, "user_id").join(centres, "centre_id").join(titles, "assessment_id")
         .withColumnsRenamed({"question_id": "selected_language_question_id", "language_id": "selected_language_id"}))
    sel = _ordered_distinct_join(F.col("_opts"), C.LIST_SEPARATOR)
    free = _ordered_distinct_join(F.col("_txt"), C.LIST_SEPARATOR)
    return (g.withColumn("selected_options_english", sel)
            .withColumn("free_text_response", free)
            .withColumn("response_english",
                        F.coalesce(F.nullif(F.col("selected_options_english"), F.lit("")),
                                   F.nullif(F.col("free_text_response"), F.lit(""))))
            .withColumn("is_correct_option",
                        F.when(F.col("_n") == 0, F.lit(None))
                        .when(F.col("_min_correct") == 1, 1).otherwise(0).cast("int"))
            .select(*RESPONSE_COLUMNS))


# -- J16 ---------------------------------------------------------------------------------
@one_plan
def user_status_report(src: Sources, requested: DataFrame, consts: Constants = DEFAULT) -> DataFrame:
    """Every requested user with first baseline / first later endline and a status.
    No centre-type or population filter, on purpose."""
    wanted = requested.select("user_id").distinct()
    is_b = F.col("assessment_id").isin(*consts.baseline_assessment_ids)
    is_e = F.col("assessment_id").isin(*consts.endline_assessment_ids)
    done = F.coalesce("updated_at", "created_at")
    # one pass over the requested users' responses: a window tells each when the first baseline was done
    r = (src.ple_assessment_responses
         .where((F.col("is_complete") == 1) & F.col("deleted_at").isNull() & (is_b | is_e))
         .join(wanted, "user_id", "left_semi")
         .select("user_id", F.when(is_b, done).alias("_b"), F.when(is_e, done).alias("_e"), is_e.alias("_is_e"))
         .withColumn("_after", F.min("_b").over(Window.partitionBy("user_id"))))
    attempts = (r.groupBy("user_id").agg(
        F.min("_b").alias("first_baseline_at"),
        F.min(F.when(F.col("_after").isNull() | (F.col("_e") > F.col("_after")), F.col("_e"))).alias("first_endline_at"),
        F.max("_is_e").alias("_any_end")))
    ct = src.centre_types.select(F.col("id").alias("centre_type_id"), F.col("type").alias("centre_type_code"))
    centres = (src.centres.select(F.col("id").alias("centre_id"), F.col("name").alias("centre_name"),
                                  "centre_type_id").join(ct, "centre_type_id", "left"))
    u = (src.users.join(wanted.withColumnRenamed("user_id", "id"), "id", "left_semi")
         .select(F.col("id").alias("user_id"), "name", "email", "mobile", "gender",
                 F.col("created_at").alias("user_registered_at"), "centre_id"))
    out = (u.join(bounded_broadcast(centres, _key(src, "status_centres")), "centre_id", "left")
           .join(attempts, "user_id", "left"))
    has_b, has_e = F.col("first_baseline_at").isNotNull(), F.col("first_endline_at").isNotNull()
    status = (F.when(has_b & has_e, "baseline_and_endline").when(has_b, "baseline_only")
              .when(F.col("_any_end"), "endline_only").otherwise("no_completed_attempt"))
    return out.select("user_id", "name", "email", "mobile", "gender", "user_registered_at",
                      "centre_name", "centre_type_code", "first_baseline_at", "first_endline_at",
                      status.alias("attempt_status"))


# -- J17 ---------------------------------------------------------------------------------
@one_plan
def population_check(src: Sources, requested: DataFrame, window: tuple,
                     centre_types: tuple | None = DEFAULT.default_centre_types) -> DataFrame:
    """One row of survivor counts per predicate for the requested users."""
    ct = src.centre_types.select(F.col("id").alias("centre_type_id"), F.col("type").alias("code"))
    c = src.centres.select(F.col("id").alias("centre_id"), "centre_type_id").join(ct, "centre_type_id", "left")
    u = (src.users.join(requested.select(F.col("user_id").alias("id")), "id", "left_semi")
         .join(bounded_broadcast(c, _key(src, "check_centres")), "centre_id", "left"))
    lo, hi = (F.to_timestamp_ntz(F.lit(x)) for x in window)
    alive = F.col("deleted_at").isNull()
    typ = F.col("type").isin(*C.LEARNER_TYPES)
    win = (F.col("created_at") >= lo) & (F.col("created_at") < hi)
    cen = F.col("code").isin(*centre_types) if centre_types else F.lit(True)
    cnt = lambda cond: F.count_if(F.coalesce(cond, F.lit(False))).cast("bigint")
    return u.agg(F.count(F.lit(1)).cast("bigint").alias("users_found"),
                 cnt(alive).alias("not_deleted"), cnt(typ).alias("type_3_or_4"),
                 cnt(win).alias("in_registration_window"), cnt(cen).alias("matching_centre_type"),
                 cnt(alive & cen).alias("reachable_by_default"),
                 cnt(alive & cen & typ & win).alias("reachable_with_population"))


def centre_type_distribution(src: Sources, requested: DataFrame) -> DataFrame:
    """Requested users per centre-type code, a placeholder for none."""
    ct = src.centre_types.select(F.col("id").alias("centre_type_id"), F.col("type").alias("code"))
    c = src.centres.select(F.col("id").alias("centre_id"), "centre_type_id").join(ct, "centre_type_id", "left")
    u = (src.users.join(requested.select(F.col("user_id").alias("id")), "id", "left_semi")
         .join(c, "centre_id", "left"))
    return (u.groupBy("code").agg(F.count(F.lit(1)).cast("bigint").alias("users"))
            .select(F.coalesce("code", F.lit("(no centre type)")).alias("centre_type"), "users"))


@one_plan
def attempt_counts(src: Sources, requested: DataFrame, consts: Constants = DEFAULT) -> DataFrame:
    """Per configured assessment, distinct users and completed attempts."""
    aset = assessment_set(src, consts)
    r = (src.ple_assessment_responses
         .where((F.col("is_complete") == 1) & F.col("deleted_at").isNull())
         .join(requested.select("user_id"), "user_id", "left_semi")
         .join(bounded_broadcast(aset, _key(src, "assessment_set")), "assessment_id"))
    return (r.groupBy("assessment_stage", "pathway", "assessment_id")
            .agg(F.countDistinct("user_id").cast("bigint").alias("users"),
                 F.count(F.lit(1)).cast("bigint").alias("completed_attempts")))
