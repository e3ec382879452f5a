from collections import Counter, defaultdict

import pytest
from fixtures import documents
from pyspark.sql import functions as F

from fragloom.llm import sharding as s


def shard(df, **options):
    return s.histogram_shards(df, F.xxhash64("text"), F.col("doc_id"), F.octet_length("text"), **options)


def check_slots(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    assert set(by) <= set(range(shards))


def test_all_rows_and_columns_stay(spark):
    docs = documents(spark).withColumn("part_", F.lit(1))
    got = shard(docs).collect()
    check_slots(got, s.SHARDS)
    want = Counter(map(tuple, docs.collect()))
    assert Counter(tuple(r)[:-2] for r in got) == want


def test_bytes_are_near_equal(spark, sf_dir="/root/testdata/sf0.01"):
    rows = s.op10_histogram_sort_shards(spark, sf_dir).collect()
    check_slots(rows, 8)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    mean, largest = sum(sizes.values()) / 8, max(r.size for r in rows)
    assert all(abs(size - mean) <= 2 * (s.TOLERANCE * mean + largest) for size in sizes.values())
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


@pytest.mark.parametrize("same", [1.0, 0.4])
def test_a_hot_group_is_cut_and_others_stay_whole(spark, same):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 4000 * same, "copy").otherwise(F.concat(F.lit("t"), F.col("id") % 997)).alias("text")
    )
    got = shard(rows).collect()
    check_slots(got, 8)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) < 1.1 * 500 and min(sizes.values()) > 0.9 * 500
    places = defaultdict(set)
    for r in got:
        places[r.text].add(r.shard)
    assert sum(len(p) > 1 for t, p in places.items() if t != "copy") <= 3


def test_nulls_ties_and_zero_sizes(spark):
    rows = spark.createDataFrame([(None, None)] * 30 + [(1, "")] * 30 + [(2, "a")] * 3, "doc_id bigint, text string")
    got = shard(rows).collect()
    assert len(got) == 63
    check_slots(got, 8)


def test_no_rows(spark):
    assert shard(documents(spark, [])).collect() == []


def test_extreme_keys(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = spark.createDataFrame([(i, k) for k in (low, high, 0) for i in (low, high, 5)], "r bigint, g bigint")
    got = s.histogram_shards(rows, F.col("g"), F.col("r"), F.lit(10), shards=3).collect()
    assert Counter(x.shard for x in got) == {0: 3, 1: 3, 2: 3}
