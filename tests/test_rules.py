"""Unit rows for the rules of SURVEY 2B-2E: NULL in nullable positions, duplicate
profiles and mappings, window ties, and the documented regressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lessonlens.functions.columns import pct
from lessonlens.functions.ids import id_list, validate_ids
from lessonlens.operators import allocation as A
from lessonlens.operators import programme as PG
from lessonlens.operators.assessment import _ordered_distinct_join
from lessonlens.plans.products import Pipeline
from lessonlens.streaming import incremental as INC
from tests.helpers import make_sources

TS = dt.datetime(2001, 1, 1)


def _lesson(i, subj, order, ltype, name="L", student=1, fac=0, master=0, assess=0):
    return dict(id=i, name=name, subject_id=subj, lesson_order=order, is_assessment=assess,
                student_access=student, facilitator_access=fac, mastertrainer_access=master,
                lesson_category_id=0, lesson_type_id=ltype, status=1, deleted_at=None)


@pytest.fixture(scope="module")
def unit(spark, sources):
    return make_sources(
        spark, sources, "rules",
        centres=[dict(id=1, name="Alpha", organisation_id=10, centre_type_id=0, ple_enabled=1,
                      status=1, state_id=100, district_id=1000, deleted_at=None)],
        organisations=[dict(id=10, name="Org", status=1)],
        centre_types=[dict(id=0, type="iti", name="Type 0")],
        subjects=[dict(id=11, name="S11", is_ple=0, year_to_map=None, status=1),
                  dict(id=12, name="S12", is_ple=1, year_to_map=2, status=1),
                  dict(id=13, name="S13", is_ple=2, year_to_map=0, status=1)],
        lessons=[_lesson(101, 11, 1, "T_QUIZ", "Intro", fac=1),
                 _lesson(102, 11, 2, "T_PDF", "Reading", master=1),
                 _lesson(103, 11, 3, None, "Final assessment"),
                 _lesson(121, 12, 1, "T_QUIZ", fac=1),
                 _lesson(131, 13, 1, "T_QUIZ")],
        lesson_types=[dict(id="T_QUIZ", name="quiz"), dict(id="T_PDF", name=" PDF ")],
        centre_subject=[dict(centre_id=1, subject_id=11, subject_order=1),
                        dict(centre_id=1, subject_id=11, subject_order=5),
                        dict(centre_id=1, subject_id=12, subject_order=2),
                        dict(centre_id=1, subject_id=13, subject_order=3)],
        trades=[dict(id=1, name="T1", duration=1)],
        subject_trade=[dict(trade_id=1, subject_id=11), dict(trade_id=1, subject_id=13)],
        batches=[dict(id=50, name="B50", status=1)],
        batch_subject=[dict(batch_id=50, subject_id=11), dict(batch_id=50, subject_id=11),
                       dict(batch_id=50, subject_id=12)],
        users=[dict(id=1, name="u1", type=3, is_ple=None, centre_id=1, organisation_id=10, status=1,
                    created_at=TS, updated_at=TS),
               dict(id=2, name="u2", type=3, is_ple=1, centre_id=1, organisation_id=10, status=1,
                    created_at=TS),
               dict(id=3, name="u3", type=2, is_master_trainer=None, centre_id=1, status=1,
                    created_at=TS),
               dict(id=4, name="u4", type=3, is_ple=0, centre_id=1, status=1, created_at=TS),
               dict(id=5, name="u5", type=3, is_ple=0, centre_id=1, status=None, created_at=TS)],
        student_details=[dict(user_id=2, batch_id=50), dict(user_id=4, batch_id=50),
                         dict(user_id=4, batch_id=None)],
        ple_career_paths=[dict(id=7, name="P7"), dict(id=8, name="P8")],
        ple_career_path_user=[dict(id=1, user_id=2, job_type_id=7, status=1, updated_at=TS),
                              dict(id=2, user_id=2, job_type_id=8, status=1, updated_at=TS)],
        subject_ple_career_path=[dict(ple_career_path_id=8, subject_id=12)],
        learning_activities=[dict(user_id=1, lesson_id=103, completed=1, duration=60,
                                  created_at=TS, updated_at=TS)],
        phase_users=[dict(user_id=1, phase_id=5)],
        centre_phase=[dict(centre_id=1, phase_id=5)],
        phases=[dict(id=5, name="Phase_5")],
        phase_project=[dict(phase_id=5, project_id=9)],
        projects=[dict(id=9, program_id=3, name="Project 9", status=1)],
        programs=[dict(id=3, name="Program A", status=1)],
        centre_project=[dict(centre_id=1, project_id=9)],
    )


def _lessons(df, user):
    return sorted(r.lesson_id for r in df.where(F.col("user_id") == user).collect())


def test_allocation_paths(unit):
    alloc = Pipeline(unit).allocation
    assert _lessons(alloc, 1) == [101, 103, 131]        # non-PLE, NULL is_ple; PDF type excluded, NULL type kept
    assert _lessons(alloc, 2) == [121]                  # strict PLE: only the mapped subject
    assert _lessons(alloc, 3) == [101, 121]             # facilitator, NULL master flag -> facilitator access
    assert _lessons(alloc, 5) == []                     # NULL status is not active


def test_duplicate_profiles_and_mappings_never_multiply(unit):
    alloc = Pipeline(unit).allocation
    assert _lessons(alloc, 4) == [101, 103, 131]        # union of both profiles, each lesson once
    rows = alloc.groupBy("user_id", "lesson_id").count().where("count > 1").count()
    assert rows == 0
    assert alloc.where("user_id = 4 AND lesson_id = 101").first().subject_order == 1


def test_loose_rule_allocates_unmapped_general_subject(unit):
    loose = Pipeline(unit, ple_rule="loose").allocation
    assert _lessons(loose, 2) == [101, 103, 121]


def test_latest_career_path_tie_takes_highest_id(unit):
    row = A.latest_career_path(unit).where("user_id = 2").first()
    assert row.job_type_id == 8


def test_assessment_only_completion_has_totals_but_no_subject_array(unit):
    snap = Pipeline(unit).user_snapshot().where("user_id = 1").first()
    assert snap.total_completed == 1 and snap.total_assessments_completed == 1
    assert snap.total_lessons_completed == 0
    assert snap.subject_combos is None


def test_direct_phase_survives_without_batch(unit):
    rows = PG.phase_rows(unit, Pipeline(unit).users).where("user_id = 1").collect()
    assert [(r.program_name, r.p_phase_id, r.phase_name) for r in rows] == [("Program A", 5, "Phase_5")]


def test_inactive_is_three_valued(unit):
    ids = sorted(r.user_id for r in INC.inactive_users(unit).collect())
    assert 5 not in ids


def test_pct_rounds_half_up_and_nulls_zero_denominator(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 0)], "d long, n long")
    got = [r.p for r in df.select(pct("d", "n").alias("p")).collect()]
    assert [str(x) if x is not None else None for x in got] == ["12.50", "33.33", "66.67", None]


def test_ordered_distinct_join(spark):
    df = spark.createDataFrame([([(2, "b"), (1, "a"), (3, "a"), (0, "c")],), ([],)],
                               "p array<struct<k:int,v:string>>")
    got = [r.s for r in df.select(_ordered_distinct_join(F.col("p"), " | ").alias("s")).collect()]
    assert got == ["c | a | b", None]


def test_cutoff_literal_validation():
    assert INC.cutoff_literal("2001-07-15") == "2001-07-15 00:00:00"
    assert INC.cutoff_literal(days=1, now=dt.datetime(2001, 1, 2)) == "2001-01-01 00:00:00"
    with pytest.raises(ValueError):
        INC.cutoff_literal("15/07/2001")
    with pytest.raises(ValueError):
        INC.watermark(None, overlap_minutes=-1)


def test_id_list_and_validation(spark):
    df = spark.createDataFrame([("00000000-0000-4000-8000-000000000001",), ("  ",), (None,),
                                ("bad",), ("00000000-0000-4000-8000-000000000001",)], "id string")
    ids = id_list(df)
    assert ids.count() == 2
    valid, rejected = validate_ids(ids)
    assert valid.count() == 1 and rejected.first().id == "bad"


def test_salted_fallback_equals_broadcast_plan(sources):
    """Above the broadcast bound the centre join is salted; the result is unchanged."""
    from lessonlens.config import Constants

    small = Pipeline(sources).allocation
    salted = Pipeline(sources, consts=Constants(broadcast_row_limit=0)).allocation
    key = lambda df: sorted(tuple(r) for r in df.select("user_id", "lesson_id", "subject_order").collect())
    assert key(small) == key(salted)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
