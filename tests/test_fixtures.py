"""The Spark fixture layer equals the DuckDB fixture text, table by table."""

import pytest

from lessonlens.sources.fixtures import TABLES
from oracle.compare import compare
from oracle.fixtures_sql import FIXTURES, with_fixtures


def test_same_table_names():
    assert set(TABLES) == set(FIXTURES)


@pytest.mark.parametrize("name", TABLES)
def test_fixture_matches_oracle(sources, duck_small, name):
    res = compare(getattr(sources, name), duck_small, with_fixtures(f"SELECT * FROM {name}"))
    assert res["cols_match"], res
    assert res["rows_match"] and res["values_match"], res


def test_every_part_row_reaches_a_lesson(sources):
    lessons = sources.lessons.select("id")
    part = sources.base("part", "p_partkey").selectExpr("p_partkey % 500 AS id")
    assert part.join(lessons, "id", "left_anti").count() == 0
    booked = sources.learning_activities.selectExpr("lesson_id AS id").distinct()
    assert booked.count() > 0 and lessons.count() == part.distinct().count()
