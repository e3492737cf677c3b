"""Source registry, JSON text, collation, run history and ordered sinks."""

import datetime as dt
import json
import tempfile
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lessonlens.functions import json_text as JT
from lessonlens.plans import catalog
from lessonlens.plans.products import Pipeline
from lessonlens.sources import fixtures, history, registry, sinks
from lessonlens.sources.registry import Location, SourceError
from tests.conftest import SF_SMALL


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# ---- registry

def test_every_table_is_declared_as_it_is(sources):
    assert tuple(registry.SCHEMAS) == fixtures.TABLES
    for name in fixtures.TABLES:
        found, wanted = getattr(sources, name).schema, registry.declared(name)
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in wanted], name


@pytest.fixture(scope="module")
def elsewhere(spark, sources):
    """The source tables under other names, some columns renamed and narrowed, others added; some
    in the catalogue, the log laid out by month."""
    root, said = tempfile.mkdtemp(prefix="ll-named-"), {}
    for k, name in enumerate(fixtures.TABLES):
        df, columns = getattr(sources, name), {}
        first = df.columns[0]
        if k % 2 == 0:
            columns = {first: f"X_{first}"}
            df = df.withColumnRenamed(first, f"X_{first}")
        df = df.withColumn("loaded_by", F.lit("import"))
        if k % 5 == 3:
            table = f"ll_src_{name}_{uuid.uuid4().hex[:8]}"
            df.write.saveAsTable(table)
            said[name] = {"table": table, "columns": columns}
        else:
            df.write.parquet(f"{root}/lms_{k}.parquet")
            said[name] = {"path": f"{root}/lms_{k}.parquet", "columns": columns}
    at = Path(root, "sources.json")
    at.write_text(json.dumps(said, indent=1))
    return str(at)


def test_queries_run_from_named_tables(spark, sources, elsewhere):
    """Products and operator keys of every section give the same from tables of other names."""
    src = registry.registered(spark, registry.locations(spark, elsewhere), SF_SMALL)
    assert {n: getattr(src, n).columns for n in fixtures.TABLES} == {n: getattr(sources, n).columns for n in fixtures.TABLES}
    keys = ["user_snapshot", "subject_combos", "project_combos", "user_addon", "filter_dims", "be_responses", "be_user_status",
            "debug_flags", "kpi_headline", "refresh_keys", "centre_programme", "scope_centre", "year_gate"]
    expected = {k: rows(catalog.QUERIES[k](spark, SF_SMALL)) for k in keys}
    fixtures.use_sources(spark, SF_SMALL, src)
    try:
        assert catalog.pipeline(spark, SF_SMALL).src is src
        for k in keys:
            assert rows(catalog.QUERIES[k](spark, SF_SMALL)) == expected[k], k
    finally:
        fixtures.use_sources(spark, SF_SMALL, sources)


def test_unfit_tables_are_named(spark, sources):
    root = tempfile.mkdtemp(prefix="ll-unfit-")
    sources.trades.drop("duration").write.parquet(f"{root}/a")
    with pytest.raises(SourceError, match="trades: .*/a has no duration; it has id, name"):
        registry.load(spark, "trades", Location(path=f"{root}/a"))
    with pytest.raises(SourceError, match=r"has no duration \(as len\)"):
        registry.load(spark, "trades", Location(path=f"{root}/a", columns={"duration": "len"}))
    assert registry.load(spark, "trades", Location(path=f"{root}/a", absent=("duration",))).select("duration").distinct().collect() == [(None,)]
    sources.trades.withColumn("id", F.col("id").cast("string")).write.parquet(f"{root}/b")
    with pytest.raises(SourceError, match="id is string, not bigint"):
        registry.load(spark, "trades", Location(path=f"{root}/b"))
    for at, said in ((Location(), "give a catalogue table or a path"), (Location(path=root, columns={"nothing": "x"}), "not declared: nothing")):
        with pytest.raises(SourceError, match=said):
            registry.load(spark, "trades", at)
    with pytest.raises(SourceError, match="no location for"):
        registry.registered(spark, {"users": Location(table="t")})
    with pytest.raises(SourceError, match="unknown source table"):
        registry.declared("nothing")


def test_narrow_types_widen_and_wide_ones_do_not_cut(spark):
    root = tempfile.mkdtemp(prefix="ll-types-")
    spark.sql("SELECT CAST(1 AS TINYINT) id, 'a' name, CAST(5000000000 AS BIGINT) duration, 1 extra").write.parquet(f"{root}/a")
    df = registry.load(spark, "trades", Location(path=f"{root}/a"))
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("duration", "int")]
    assert df.select("id").collect() == [(1,)]
    with pytest.raises(Exception, match="(?i)overflow"):
        df.collect()
    # nothing else is scanned
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:tinyint>" in plan


def test_collated_columns_compare_loosely(spark):
    root = tempfile.mkdtemp(prefix="ll-coll-")
    spark.createDataFrame([(1, "Brésil"), (2, "PERU "), (3, "Chile")], "id long, name string").write.parquet(f"{root}/a")
    df = registry.load(spark, "languages", Location(path=f"{root}/a", collate={"name": registry.LOOSE}))
    said = spark.createDataFrame([("brasil",), ("bresil  ",), ("Peru",), ("chile",)], "name string").select(
        F.collate("name", registry.LOOSE).alias("name"))
    assert rows(df.join(said, "name").select("id")) == [(1,), (2,), (3,)]
    assert df.where("name = 'pérú'").count() == 1


def test_changed_tables_are_read_anew(spark):
    """A later state of the tables has products of its own."""
    first = fixtures.sources_for(spark, SF_SMALL)
    old = catalog.stored_snapshot(catalog.pipeline(spark, SF_SMALL)).count()
    later = fixtures.Sources(spark, SF_SMALL)
    for name in fixtures.TABLES:
        later.__dict__[name] = getattr(first, name)
    later.__dict__["users"] = first.users.where("id % 2 = 0")
    fixtures.use_sources(spark, SF_SMALL, later)
    try:
        assert 0 < catalog.stored_snapshot(catalog.pipeline(spark, SF_SMALL)).count() < old
    finally:
        fixtures.use_sources(spark, SF_SMALL, first)
    assert catalog.stored_snapshot(catalog.pipeline(spark, SF_SMALL)).count() == old


def test_change_scans_read_the_days_from_their_cutoff_on(spark, sources):
    from lessonlens.streaming import incremental as INC

    root = tempfile.mkdtemp(prefix="ll-days-")
    src, plain = fixtures.Sources(spark, SF_SMALL), fixtures.Sources(spark, SF_SMALL)
    for name in fixtures.TABLES:
        src.__dict__[name] = plain.__dict__[name] = getattr(sources, name)
    log = sources.learning_activities.where("greatest(created_at, updated_at) > '2001-06-20' or created_at is null").coalesce(1)
    plain.__dict__["learning_activities"] = log
    src.__dict__["learning_activities"] = registry.load(spark, "learning_activities", registry.write_by_day(log, f"{root}/log"))
    assert src.learning_activities.select(fixtures.CHANGED_DAY).distinct().count() > 5
    for cutoff in ("1970-01-01 00:00:00", "2001-07-15 12:30:00", "2100-01-01 00:00:00"):
        assert rows(INC.changed_users(src, cutoff)) == rows(INC.changed_users(plain, cutoff))
    late = INC._since(src.learning_activities, "2001-07-15 00:00:00", "created_at", "updated_at")
    assert "PartitionFilters: [isnotnull(day" in late._jdf.queryExecution().executedPlan().toString()
    assert rows(src.learning_activities.drop(fixtures.CHANGED_DAY)) == rows(log)


# ---- JSON text

def test_json_text(spark):
    texts = ['[{"a":1,"b":"x"},{"a":2,"b":null}]', "[]", '[{"a":1', '{"a":1}', "null", "", "  [{\"b\":\"y\",\"c\":3}]", '[{"a":"no number"}]',
             "[1]", "nonsense", None, '[{"a":1}] x', '[{"a":1}], "rows":[{"a":2}]',
             "1],[2", '1,"end"]', '1,"end":1', "1}", "1, 2", '"end"']
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert [r[1] for r in sorted(df.select("k", JT.json_valid("t")).collect())] == [1, 1, 0, 1, 1, 0, 1, 1, 1, 0, None, 0, 0, 0, 0, 0, 0, 0, 1]
    good, bad = JT.inline_json(df, "t", "struct<a:bigint,b:string>", "k")
    assert rows(good) == [(0, 1, "x"), (0, 2, None), (6, None, "y")] and good.columns == ["k", "a", "b"]
    assert [r[0] for r in rows(bad, "k")] == [11, 12, 13, 14, 15, 16, 17, 18, 2, 3, 4, 5, 7, 8, 9]
    assert bad.columns == ["k", "t"]


# ---- run history

def test_run_history(spark):
    name = f"ll_runs_{uuid.uuid4().hex[:10]}"
    one = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", 8), (4, "d", None)], "user_id long, name string, centre_id long")
    two = one.where("user_id <> 3").withColumn("user_id", F.col("user_id").cast("int")).withColumn("more", F.lit(1))
    history.record_run(name, "p", "r1", dt.datetime(2020, 1, 1), one)
    assert history.drift(spark.table(name), "p", "r1").collect() == []
    history.record_run(name, "other", "r9", dt.datetime(2020, 1, 2), two)
    history.record_run(name, "p", "r2", dt.datetime(2020, 1, 3), one)
    history.record_run(name, "p", "r3", dt.datetime(2020, 1, 4), two)
    n = spark.table(name).count()
    history.record_run(name, "p", "r3", dt.datetime(2020, 1, 5), one)          # begun again: recorded once
    assert spark.table(name).count() == n
    runs = spark.table(name)
    assert history.run_before(runs, "p", "r3") == "r2" and history.run_before(runs, "p", "r1") is None
    assert history.drift(runs, "p", "r2").collect() == []
    assert rows(history.drift(runs, "p", "r3")) == [
        ("column", "more", "added", None, "int"), ("column", "user_id", "type", "bigint", "int"), ("rows", "8", "removed", "1", None)]
    assert rows(history.drift(runs, "p", "r3", "r1")) == rows(history.drift(runs, "p", "r3"))
    assert history.declared_drift(one, one.schema).collect() == []


# ---- ordered sinks

def in_name_order(path):
    out = []
    for f in sorted(Path(path).glob("part-*")):
        out += pq.read_table(f).to_pylist()
    return out


def test_files_in_name_order_give_the_order(spark, sources):
    lp = Pipeline(sources).lesson_progress()
    path = tempfile.mkdtemp(prefix="ll-order-") + "/x"
    sinks.write_ordered(lp, path, sinks.ORDERS["lesson_progress"], files=5)
    got = in_name_order(path)
    key = [tuple((r[c] is not None, r[c]) for c in sinks.ORDERS["lesson_progress"]) for r in got]
    assert len(list(Path(path).glob("part-*"))) == 5 and len(got) == lp.count() and key == sorted(key)
    # one user's rows may lie in several files
    hot = spark.range(4000).select(F.lit(1).alias("user_id"), F.col("id").alias("lesson_id"))
    sinks.write_ordered(hot, path, ("user_id", "lesson_id"), files=4)
    assert len(list(Path(path).glob("part-*"))) == 4 and [r["lesson_id"] for r in in_name_order(path)] == list(range(4000))


def test_stages_in_their_order(spark):
    df = spark.createDataFrame([(u, s, u * 10) for u in range(40) for s in ("endline", "other", "baseline", None)],
                               "user_id long, stage string, v long")
    path = tempfile.mkdtemp(prefix="ll-stage-") + "/x"
    sinks.write_ordered(df, path, ("user_id", sinks.stage_rank(), "stage"), files=3)
    got = [(r["user_id"], r["stage"]) for r in in_name_order(path)]
    assert got == [(u, s) for u in range(40) for s in ("baseline", "endline", None, "other")]
    sinks.write_ordered(df, path, ("user_id", sinks.stage_rank(), "stage"), files=2, fmt="csv", header=True)
    lines = [x for f in sorted(Path(path).glob("part-*")) for x in f.read_text().splitlines()[1:]]
    assert lines[:3] == ["0,baseline,0", "0,endline,0", "0,,0"] and len(lines) == 160
