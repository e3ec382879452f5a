"""Distributed row numbers against plain sorting."""

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fragloom.operators import numbering
from fragloom.operators.numbering import number_rows, number_stored_rows


def numbers(df, order_by, **options):
    numbered = number_rows(df, order_by, **options)
    return {tuple(row)[:-1]: row["row_index"] for row in numbered.collect()}


def expected(rows, key=None):
    return {row: i for i, row in enumerate(sorted(rows, key=key))}


def nulls_first(row):
    return tuple((value is not None, value) for value in row)


def test_single_numeric_key(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    assert numbers(df, "k") == expected([tuple(r) for r in df.collect()])


def test_null_first_and_nan_last(spark):
    rows = [(v,) for v in (2.5, None, -1.0, math.inf, 0.0, -math.inf, 7.0)]
    df = spark.createDataFrame([*rows, (math.nan,)], "k double")
    got = {repr(k[0]): v for k, v in numbers(df, "k").items()}
    ordered = ["None", "-inf", "-1.0", "0.0", "2.5", "7.0", "inf", "nan"]
    assert [got[k] for k in ordered] == list(range(8))


@pytest.mark.parametrize("lead", ["bigint", "double", "string", "decimal(20,2)", "date", "timestamp", "timestamp_ntz"])
def test_hot_leading_value(spark, lead):
    """Half of the rows share one leading value, some have none."""
    day = F.when(F.col("id") % 2 == 0, 17).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 29)
    value = {
        "string": F.concat(F.lit("v"), day.cast("string")),
        "date": F.date_add(F.lit("2000-01-01").cast("date"), day.cast("int")),
        "timestamp": F.timestamp_seconds(day * 86400 + 1),
        "timestamp_ntz": F.timestamp_seconds(day * 86400 + 1).cast("timestamp_ntz"),
    }.get(lead, day.cast(lead))
    df = spark.range(3000).select(value.alias("a"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("b"))
    rows = [tuple(r) for r in df.collect()]
    assert numbers(df, ["a", "b"]) == expected(rows, nulls_first)


def parts(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.shiftright("at", 33)).count().collect()]


@pytest.mark.parametrize("rows", [1000, 15_000])
@pytest.mark.parametrize("key", ["id", "7", "cast(NULL AS double)", "double('NaN')"])
def test_any_key_is_numbered_by_several_tasks(spark, tmp_path, rows, key):
    """Also one value on every row, and small tables."""
    path = str(tmp_path / "scratch")
    df = spark.range(rows).selectExpr(f"{key} AS k", "id AS v")
    got = number_rows(df, "k", scratch=path, parts=6)
    assert sorted(r["row_index"] for r in got.collect()) == list(range(rows))
    sizes = parts(spark, path)
    assert len(sizes) == 6 and max(sizes) < 2 * rows / 6


def test_equal_rows_keep_all_numbers(spark):
    df = spark.createDataFrame([(1, "x")] * 50 + [(0, "y")] * 50, "a int, b string")
    got = sorted(r["row_index"] for r in number_rows(df, ["a", "b"]).collect())
    assert got == list(range(100))


def test_a_frame_that_differs_at_each_reading(spark):
    df = spark.range(5000).select((F.rand() * 1000).cast("int").alias("k")).where(F.rand() < 0.5)
    numbered = number_rows(df, "k")
    rows = [(r["row_index"], r["k"]) for r in numbered.collect()]
    assert sorted(i for i, _ in rows) == list(range(len(rows)))
    assert [k for _, k in sorted(rows)] == sorted(k for _, k in rows)
    assert sorted(rows) == sorted((r["row_index"], r["k"]) for r in numbered.collect())


@pytest.mark.parametrize("name", ["row_index", "ROW_INDEX"])
def test_taken_names_are_refused(spark, tmp_path, name):
    df = spark.range(3).withColumnRenamed("id", name)
    with pytest.raises(ValueError, match="already"):
        number_rows(df, name)
    assert {r["n"] for r in number_rows(df, name, into="n").collect()} == {0, 1, 2}
    df.write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="already"):
        number_stored_rows(spark.read.parquet(str(tmp_path / "t")))


def test_empty_frame(spark):
    assert number_rows(spark.createDataFrame([], "k int"), "k").collect() == []


def test_unordered_key_type(spark):
    with pytest.raises(AnalysisException):
        number_rows(spark.createDataFrame([({1: 2},)], "k map<int,int>"), "k")


@pytest.mark.parametrize("broadcast_bytes", [0, 16_000])
def test_storage_order(spark, tmp_path, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(numbering, "MAX_BROADCAST_BYTES", broadcast_bytes)
    path = str(tmp_path / "t")
    spark.range(1000).repartition(13).write.parquet(path)
    numbered = number_stored_rows(spark.read.parquet(path))
    rows = numbered.collect()
    assert sorted(r["row_index"] for r in rows) == list(range(1000))
    assert sorted(r["id"] for r in rows) == list(range(1000))
    assert rows == number_stored_rows(spark.read.parquet(path)).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    stored = spark.read.parquet(path)
    storage_order = plan(number_stored_rows(stored))
    # Only the per-file counts are shuffled, below the broadcast of the offsets.
    assert "BroadcastHashJoin" in storage_order and "SortMergeJoin" not in storage_order
    assert "SinglePartition" not in storage_order
    left = storage_order[: storage_order.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in left and "rangepartitioning" not in left


def test_offsets_of_many_parts_are_numbers_in_a_join(spark):
    parts = 100_000
    counts = spark.range(parts).select(F.col("id").cast("int").alias("part"), (F.col("id") % 5).alias("rows"))
    group = F.floor(F.col("part") / -(-parts // numbering.GROUPS)).cast("int")
    offsets = numbering.start_offsets(counts, "part", group, "part")
    # The plan is as large for any number of parts.
    assert len(offsets._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    assert "SinglePartition" not in offsets._jdf.queryExecution().executedPlan().toString()
    wrong = offsets.where(F.col("offset") != F.floor(F.col("part") / 5) * 10 + F.get(F.array(*map(F.lit, [0, 0, 1, 3, 6])), F.col("part") % 5))
    assert wrong.count() == 0 and offsets.count() == parts
