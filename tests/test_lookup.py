"""Bloom filters of lookup columns, figures from footers, sketches, and joins with intervals."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from fragloom import FragmentStore
from fragloom.functions.ranges import FRAGMENT_ID, RangeSpec
from fragloom.operators import intervals as intervals_of
from fragloom.operators.sketches import COUNT_ERROR, RANK_ERROR
from fragloom.plans.catalog import RANGE, ROUND_ROBIN


def scan_rows(df):
    """Rows that the scans of a query that has run handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    rows, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            rows += node.metrics().apply("numOutputRows").value()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


@pytest.fixture
def indexed(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    # Even keys, spread so that the least and greatest of a file tell nothing.
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_000 * 2).alias("key"), (F.col("id") % 11 / 2).alias("rating"))
    store.load("t", rows)
    store.split_range("t", 3, lookup_by=["key"])
    store.append_range("t", rows.withColumn("key", F.col("key") + 1_000_000))
    return store


def test_an_absent_tuple_reads_no_row_group(spark, indexed):
    split = indexed.split("t", RANGE)
    files = split.select(F.input_file_name()).distinct().count()
    assert files >= 6
    for key, found in ((20_001, 0), (999, 0), (20_002, 1), (1_000_000, 1)):
        some = split.where(F.col("key") == key).select("rating")
        assert len(some.collect()) == found
        assert scan_rows(some) <= found * 20_000 and (found or scan_rows(some) == 0)


def test_without_filters_row_groups_are_read(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", spark.range(0, 2000, 2).select(F.col("id").alias("key"), F.lit(1.0).alias("rating")))
    store.split_range("t", 1)
    some = store.split("t", RANGE).where("key = 999").select("rating")
    assert some.collect() == [] and scan_rows(some) > 0


def test_lookup_columns_outlive_compaction_and_must_exist(spark, indexed):
    indexed.compact("t", RANGE)
    some = indexed.split("t", RANGE).where("key = 999").select("rating")
    assert some.collect() == [] and scan_rows(some) == 0
    with pytest.raises(ValueError, match="no columns"):
        indexed.split_round_robin("t", 2, lookup_by=["other"])


@pytest.mark.parametrize("kind", ["int", "double", "date", "string", "timestamp", "nan", "nulls"])
def test_footers_tell_what_a_scan_tells(spark, tmp_path, kind):
    value = {
        "int": F.col("id") - 30,
        "double": F.when(F.col("id") > 5, F.col("id") / 4).otherwise(0.0),
        "date": F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("id").cast("int")),
        "string": F.concat(F.lit("x" * 100), F.col("id").cast("string")),
        "timestamp": F.timestamp_seconds("id"),
        "nan": F.when(F.col("id") % 13 == 0, math.nan).otherwise(F.col("id").cast("double")),
        "nulls": F.lit(None).cast("int"),
    }[kind]
    store = FragmentStore(spark, str(tmp_path))
    rows = spark.range(200).select("id", value.alias("value"))
    store.load("t", rows.where("id < 150"))
    store.split_range("t", 7, column="id", lo=0.0, hi=400.0)
    store.append_range("t", rows.where("id >= 150"))
    got = store.footer_profile("t", RANGE, "value")
    want = store.split("t", RANGE).groupBy(FRAGMENT_ID).agg(F.count("*"), F.min("value"), F.max("value")).collect()
    full = {i: (0, None, None) for i in range(7)} | {r[0]: tuple(r)[1:] for r in want}
    assert repr(sorted((r[0], *r[1:]) for r in map(tuple, got.collect()))) == repr(sorted((i, *v) for i, v in full.items()))


def test_counts_are_aggregated_in_the_scan(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", spark.range(100).select("id", (F.col("id") % 11 / 2).alias("rating")))
    store.split_range("t", 4)
    counted = store.footer_counts(store.catalog.get("t", RANGE), "rating")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(rating), MAX(rating)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sketches_merge_over_commits_within_their_bounds(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    rows = spark.range(60_000).select((F.xxhash64("id") % 20_000).cast("double").alias("value"), (F.col("id") % 11 / 2).alias("rating"))
    rows = rows.withColumn("value", F.when(F.col("value") % 50 != 0, F.col("value")).otherwise(F.lit(math.nan)))
    store.load("t", rows.where("false"))
    store.split_round_robin("t", 2)
    for k in range(3):
        store.append_round_robin("t", rows.where(F.col("rating") > k))
    ranks = (0.01, 0.3, 0.5, 0.99)
    split = store.split("t", ROUND_ROBIN).where("NOT isnan(value)")
    for r in store.quantiles("t", ROUND_ROBIN, "value", ranks).collect():
        values = sorted(v.value for v in split.where(F.col(FRAGMENT_ID) == r[FRAGMENT_ID]).select("value").collect())
        assert r.n_values == len(values) < r.n_rows
        assert abs(r.distinct_values - len(set(values))) <= COUNT_ERROR * len(set(values))
        for rank, q in zip(ranks, r.quantiles, strict=True):
            below, upto = sum(v < q for v in values), sum(v <= q for v in values)
            assert below - RANK_ERROR * len(values) <= rank * len(values) <= upto + RANK_ERROR * len(values)
    assert store.sketches("t", ROUND_ROBIN, "value").select("commit").distinct().count() == 3


INTERVALS = [
    (1, 0.0, 0.0), (2, -5.0, 50.0), (3, 1.0, 1.0), (4, 0.99, 1.01), (5, 3.0, 2.0), (6, None, 1.0), (7, 1.0, None),
    (8, math.nan, 3.0), (9, 2.0, math.nan), (10, 5.0, 9.0), (11, 5.01, 9.0), (12, -3.0, -0.1), (13, 1.25, 3.75), (13, 1.25, 3.75),
]


@pytest.mark.parametrize("n", [1, 3, 11, 64])
@pytest.mark.parametrize("policy", ["drop", "clamp"])
def test_interval_join_equals_comparing_all_with_all(spark, tmp_path, n, policy):
    store = FragmentStore(spark, str(tmp_path))
    values = [i / 4 for i in range(-8, 30)] + [None, math.nan, 1.0, 1.0]
    store.load("t", spark.createDataFrame(list(enumerate(values)), "id int, rating double"))
    store.split_range("t", n, out_of_range=policy)
    table = spark.createDataFrame(INTERVALS, "name int, low double, high double")
    got = store.join_intervals("t", table, "low", "high").select("id", "name").collect()
    kept = [(i, v) for i, v in enumerate(values) if v is not None and not math.isnan(v) and (policy == "clamp" or 0 <= v <= 5)]
    ok = [(m, a, b) for m, a, b in INTERVALS if None not in (a, b) and not math.isnan(a + b)]
    assert sorted(map(tuple, got)) == sorted((i, m) for i, v in kept for m, a, b in ok if a <= v <= b)


def test_interval_join_prunes_fragments_as_it_runs(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", spark.range(5000).select((F.col("id") % 500 / 100).alias("rating")))
    store.split_range("t", 50)
    table = spark.createDataFrame([(1, 1.0, 1.05), (2, 4.0, 4.01)], "name int, low double, high double")
    path = str(tmp_path / "intervals")
    table.write.parquet(path)
    joined = store.join_intervals("t", spark.read.parquet(path).where("name < 2"), "low", "high")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() == 60


def test_spans_reach_one_fragment_beyond_the_ends(spark):
    spec = RangeSpec(10, "v", 0.0, 10.0)
    table = spark.createDataFrame([(3.0, 5.0)], "low double, high double")
    spans = intervals_of.interval_spans(table, spec, "low", "high").select(FRAGMENT_ID).collect()
    assert sorted(r[0] for r in spans) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize(("n", "policy", "broadcast"), [(1, "drop", 16), (7, "clamp", 2), (64, "drop", 0)])
def test_interval_totals_equal_those_of_all_pairs(spark, tmp_path, monkeypatch, n, policy, broadcast):
    monkeypatch.setattr(intervals_of, "BROADCAST_LEVELS", broadcast)
    rng = random.Random(n)
    numbers = [rng.choice([0.0, 2.5, 5.0, rng.uniform(-1, 6), None]) for _ in range(3000)]
    rows = spark.createDataFrame([(i * 7 % 3001, v) for i, v in enumerate(numbers)], "id int, v double")
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", rows)
    store.split_range("t", n, column="v", out_of_range=policy)
    ends = [sorted((rng.choice(numbers) or -2.0, rng.uniform(-2, 7))) for _ in range(200)]
    asked = [*INTERVALS, *INTERVALS, *((100 + i, a, b) for i, (a, b) in enumerate(ends))]
    table = spark.createDataFrame(asked, "name int, low double, high double")
    got = store.interval_totals("t", table, "low", "high", "id")
    assert got.columns == ["name", "low", "high", "n_rows", "min_value"]
    want = []
    for name, low, high in asked:
        ids = [i * 7 % 3001 for i, v in enumerate(numbers) if v is not None and (policy == "clamp" or 0 <= v <= 5)
               and low is not None and high is not None and low <= v <= high]
        if ids:
            want.append((name, len(ids), min(ids)))
    assert sorted(map(tuple, got.select("name", "n_rows", "min_value").collect())) == sorted(want)


def test_interval_totals_make_no_pairs(spark, tmp_path):
    """The largest frame that is joined or aggregated grows with the tables, not with their product."""
    store = FragmentStore(spark, str(tmp_path / "store"))
    store.load("t", spark.range(2000).select("id", (F.col("id") / 400.0).alias("v")))
    store.split_range("t", 4, column="v")
    table = spark.range(1000).select((F.col("id") / 1000.0).alias("low"), (4.0 + F.col("id") / 1000.0).alias("high"))
    got = store.interval_totals("t", table, "low", "high", "id")
    rows = got.agg(F.sum("n_rows")).first()[0]
    assert rows > 1_000_000
    spec = store.catalog.get("t", RANGE).spec
    points, runs = intervals_of._runs(store.split("t", RANGE), table, spec, "id", 0)
    assert points.count() == 2000 and runs.count() == 1000
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_interval_totals_of_nothing(spark, tmp_path):
    store = FragmentStore(spark, str(tmp_path))
    store.load("t", spark.createDataFrame([], "id int, v double"))
    store.split_range("t", 4, column="v")
    none = spark.createDataFrame([(1, 1.0, 2.0)], "name int, low double, high double")
    assert store.interval_totals("t", none, "low", "high", "id").collect() == []
    assert store.interval_totals("t", none.where("name = 2"), "low", "high", "id").collect() == []
