"""Fingerprints of bags: equality by sums, and where bags differ."""

import pytest
from pyspark.sql import functions as F

from fragloom import FragmentStore
from fragloom.operators import bagprints
from fragloom.operators.bagprints import add_prints, bag_print, bag_prints, differences
from fragloom.plans.catalog import BASE, RANGE, ROUND_ROBIN

SCHEMA = "id bigint, name string, rating double"


def rows(spark, n=300):
    values = [(i % 97, None if i % 7 == 0 else f"n{i % 11}", (i % 11) / 2) for i in range(n)]
    return spark.createDataFrame(values + [(None, None, None), (None, "", float("nan"))], SCHEMA)


def same(a, b):
    return tuple(bag_print(a).first()) == tuple(bag_print(b).first())


def test_prints_do_not_depend_on_layout_and_add_up(spark):
    df = rows(spark)
    assert same(df, df.orderBy("name").repartition(7))
    parts = bag_prints(df.withColumn("part", F.coalesce(F.col("id") % 3, F.lit(9))), "part")
    assert parts.count() == 4 and tuple(add_prints(parts).first()) == tuple(bag_print(df).first())


@pytest.mark.parametrize(
    "other",
    [
        lambda df: df.limit(300),
        lambda df: df.unionAll(df.limit(1)),
        lambda df: df.where("id <> 5 OR id IS NULL").unionAll(df.where("id = 6")),  # lost and doubled rows, as many
        lambda df: df.withColumn("name", F.coalesce("name", F.lit(""))),
        lambda df: df.select(F.coalesce("id", F.lit(0)).alias("id"), "name", "rating"),
    ],
)
def test_any_difference_shows(spark, other):
    df = rows(spark)
    assert not same(df, other(df))


@pytest.mark.parametrize("bits, levels, many", [(10, 3, 4096), (1, 2, 4096), (4, 3, 2), (2, 1, 0)])
def test_differences_are_those_of_the_rows(spark, monkeypatch, bits, levels, many):
    monkeypatch.setattr(bagprints, "MANY", many)
    base = rows(spark)
    split = base.where("rating <> 2.5 OR id % 2 = 0").unionAll(base.where("id = 3")).unionAll(base.where("name IS NULL AND id IS NULL"))
    found = differences(base, split, bits, levels).select("row.*", "missing_rows", "extra_rows")
    missing = base.exceptAll(split).groupBy(*base.columns).count().collect()
    extra = split.exceptAll(base).groupBy(*base.columns).count().collect()
    want = [(*r[:3], r[3], 0) for r in missing] + [(*r[:3], 0, r[3]) for r in extra]
    assert missing and extra and sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_equal_bags_have_no_differences_and_empty_ones_neither(spark):
    df = rows(spark)
    assert differences(df, df.repartition(3)).collect() == []
    assert differences(df.where("false"), df.where("false")).collect() == []
    assert tuple(bag_print(df.where("false")).first()) == (0, 0, 0)


def test_no_row_is_shuffled(spark):
    plan = bag_print(rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_commits_are_hashed_once(spark, tmp_path, monkeypatch):
    store = FragmentStore(spark, str(tmp_path))
    df = rows(spark).where("rating IS NOT NULL AND NOT isnan(rating)")
    store.load("t", df)
    store.split_range("t", 4)
    store.split_round_robin("t", 3)
    store.append_range("t", df, also_base=True)
    store.append_round_robin("t", df)
    for kind in (RANGE, ROUND_ROBIN):
        assert tuple(store.verify("t", kind).first()) == (2 * df.count(), 2 * df.count(), True)
    assert {r.commit for r in store.prints("t", RANGE).collect()} == {0, 1}

    def refused(*_):
        raise AssertionError("a commit was hashed again")

    before = store.prints("t", BASE).collect()
    monkeypatch.setattr(bagprints, "bag_print", refused)
    assert store.prints("t", BASE).collect() == before
    store.append_range("t", df)
    assert store.verify("t", RANGE).first().reconstructs is False


def test_a_store_without_rows(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", rows(spark).where("false"))
    store.split_range("t", 4)
    assert tuple(store.verify("t", RANGE).first()) == (0, 0, True)
