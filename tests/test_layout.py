"""Files of a split."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fragloom import FragmentStore
from fragloom.functions.ranges import FRAGMENT_ID
from fragloom.plans import layout
from fragloom.plans.layout import plan_tasks, stored_bytes, write_split

ROWS = 40_000


@pytest.fixture(params=["true", "false"])
def session(spark, request):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", request.param)
    return session


def files(path, fragment):
    return list(Path(path).glob(f"{FRAGMENT_ID}={fragment}/*.parquet"))


def written(session, tmp_path, n, fragment):
    source, path = str(tmp_path / "source"), str(tmp_path / "split")
    session.range(0, ROWS, 1, 16).select("id", F.xxhash64("id").alias("v")).write.parquet(source)
    assigned = session.read.parquet(source).withColumn(FRAGMENT_ID, fragment.cast("int"))
    write_split(assigned, path, n, stored_bytes(session, source))
    assert session.read.parquet(path).count() == ROWS
    return [len(files(path, i)) for i in range(n)]


@pytest.mark.parametrize("n", [5, 16, 500])
def test_small_fragments_get_one_file(session, tmp_path, n):
    assert written(session, tmp_path, n, F.col("id") % n) == [1] * n


@pytest.mark.parametrize("n", [5, 16])
def test_files_follow_the_size(session, tmp_path, monkeypatch, n):
    monkeypatch.setattr(layout, "FILE_BYTES", 60_000)
    monkeypatch.setattr(layout, "SMALL_FILE_BYTES", 1 << 40)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % n)
    counts = written(session, tmp_path, n, hot)
    assert counts[0] >= 3 and counts[0] >= max(counts[1:]) and min(counts) >= 1


def test_large_files_are_written_where_rows_are(session, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "SMALL_FILE_BYTES", 1)
    assert min(written(session, tmp_path, 3, F.col("id") % 3)) > 1


def test_plan():
    big = layout.FILE_BYTES
    assert plan_tasks([1, 1, 1, 1], 2) == [(0, 1), (0, 1), (1, 1), (1, 1)]
    assert plan_tasks([3 * big, 1, 1, big // 2], 4) == [(0, 3), (3, 1), (3, 1), (3, 1)]
    assert plan_tasks([0, 0, 0], 8) == [(0, 1)] * 3
    assert plan_tasks([2 * big + 1, big], 1) == [(0, 3), (3, 1)]


def plans(session):
    """The physical plan of every execution so far, by its number."""
    found = session._jsparkSession.sharedState().statusStore().executionsList()
    return {e.executionId(): e.physicalPlanDescription() for e in (found.apply(i) for i in range(found.size()))}


def last_plan(session):
    executions = session._jsparkSession.sharedState().statusStore().executionsList()
    return max((executions.apply(i) for i in range(executions.size())), key=lambda e: e.executionId()).physicalPlanDescription()


@pytest.mark.parametrize("small", [1 << 40, 1])
def test_rows_are_not_sorted_to_be_written(session, tmp_path, monkeypatch, small):
    monkeypatch.setattr(layout, "SMALL_FILE_BYTES", small)
    source, path = str(tmp_path / "source"), str(tmp_path / "split")
    session.range(0, ROWS, 1, 4).write.parquet(source)
    before = {name: session.conf.get(name) for name in layout._UNSORTED}
    assigned = session.read.parquet(source).withColumn(FRAGMENT_ID, (F.col("id") % 5).cast("int"))
    write_split(assigned, path, 5, stored_bytes(session, source))
    plan = last_plan(session)
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
    assert {name: session.conf.get(name) for name in layout._UNSORTED} == before
    assert session.read.parquet(path).groupBy(FRAGMENT_ID).count().where(f"count = {ROWS // 5}").count() == 5


@pytest.mark.parametrize("small", [1 << 40, 1])
def test_range_split_of_a_table_is_not_sorted(session, tmp_path, monkeypatch, small):
    monkeypatch.setattr(layout, "SMALL_FILE_BYTES", small)
    store = FragmentStore(session, str(tmp_path / "store"))
    store.load("items", session.range(0, ROWS, 1, 4).select("id", (F.col("id") % 50 + 1).cast("double").alias("quantity")))
    seen = plans(session)
    store.split_range("items", 7, column="quantity", lo=0.0, hi=50.0)
    written = [plan for key, plan in plans(session).items() if key not in seen and "/range-" in plan and "InsertIntoHadoopFsRelationCommand" in plan]
    assert written and not any("Sort" in plan for plan in written)
    assert store.split("items", "range").count() == ROWS


def test_more_fragments_than_open_files(session, tmp_path, monkeypatch):
    monkeypatch.setitem(layout._UNSORTED, "spark.sql.maxConcurrentOutputFileWriters", "3")
    monkeypatch.setattr(layout, "SMALL_FILE_BYTES", 1)
    assert min(written(session, tmp_path, 40, F.col("id") % 40)) >= 1
    got = session.read.parquet(str(tmp_path / "split")).where(f"id % 40 <> {FRAGMENT_ID}")
    assert got.count() == 0
