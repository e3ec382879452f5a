"""The whole course of work: load, split, append, reload, split, append."""

import os

import pytest
from pyspark.sql import functions as F

from fragloom.functions.ranges import RangeSpec
from fragloom.operators import checks
from fragloom.operators.counts import expected_range_sizes, expected_round_robin_sizes
from fragloom.plans.catalog import RANGE, ROUND_ROBIN
from fragloom.sources.delimited import read_delimited
from fragloom.sources.exports import write_lines

# Rows of the full file and of the sample; the fragment that the
# first rating appended to a 5-way round robin goes to.
FULL, SAMPLE = 10_000_054, 20
FIRST_APPENDED = {FULL: 4, SAMPLE: 0}
# The full size runs on demand; by default a hundredth of it stands in.
REDUCED = FULL // 100 - FULL // 100 % 5 + FULL % 5
SIZES = [SAMPLE, FULL if os.environ.get("FULL_SIZE_TESTS") else REDUCED]
N = 5


@pytest.mark.parametrize("n_rows", SIZES)
def test_course_of_work(spark, store, tmp_path, n_rows):
    path = str(tmp_path / "ratings.dat")
    ids = spark.range(n_rows).select(
        F.lit(1).alias("userid"), F.col("id").alias("movieid"), ((F.col("id") % 11) / 2.0).alias("rating")
    )
    write_lines(ids.withColumn("timestamp", F.lit(838985046)), path, "::")
    store.load("ratings", read_delimited(spark, path))
    base = store.base("ratings")
    assert base.count() == n_rows
    rating = spark.createDataFrame([(100, 2, 3.0)], "userid int, movieid int, rating double")

    store.split_range("ratings", N)
    assert store.partition_count("ratings", RANGE) == N
    assert checks.reconstruction(base, store.split("ratings", RANGE)).first()["reconstructs"]
    sizes = checks.compare_sizes(expected_range_sizes(base, RangeSpec(N)), store.sizes("ratings", RANGE))
    assert sizes.where("difference <> 0").count() == 0
    store.append_range("ratings", rating)
    assert store.count_tuple("ratings", RANGE, 2, userid=100, movieid=2, rating=3.0).first()["n_rows"] == 1

    store.split_round_robin("ratings", N)
    assert checks.reconstruction(base, store.split("ratings", ROUND_ROBIN)).first()["reconstructs"]
    sizes = checks.compare_sizes(expected_round_robin_sizes(base, N), store.sizes("ratings", ROUND_ROBIN))
    assert sizes.where("difference <> 0").count() == 0
    store.append_round_robin("ratings", rating)
    fragment = FIRST_APPENDED[SAMPLE if n_rows == SAMPLE else FULL]
    found = store.count_tuple("ratings", ROUND_ROBIN, fragment, userid=100, movieid=2, rating=3.0)
    assert found.first()["n_rows"] == 1
