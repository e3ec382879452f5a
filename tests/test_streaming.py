"""Streaming appends, replays and restarts."""

import pytest
from pyspark.sql import functions as F

from fragloom.functions.ranges import FRAGMENT_ID, RangeSpec
from fragloom.plans import store as store_module
from fragloom.plans.catalog import RANGE, ROUND_ROBIN
from fragloom.streaming.appends import range_file_stream, store_stream

SCHEMA = "id bigint, rating double"


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")

    def arrive(first, last):
        ids = spark.range(first, last).select("id", ((F.col("id") % 11) / 2.0).alias("rating"))
        ids.repartition(3).write.mode("append").parquet(path)
        return spark.readStream.schema(SCHEMA).parquet(path)

    return arrive


def finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def fragments(df):
    return {r["id"]: r[FRAGMENT_ID] for r in df.collect()}


@pytest.fixture
def empty(spark, store):
    store.load("ratings", spark.createDataFrame([], SCHEMA))
    store.split_round_robin("ratings", 4)
    store.split_range("ratings", 5)
    return store


def test_range_file_stream(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    finish(range_file_stream(landing(0, 100), RangeSpec(5), out, checkpoint))
    finish(range_file_stream(landing(100, 150), RangeSpec(5), out, checkpoint))
    got = spark.read.parquet(out)
    assert got.count() == 150
    assert got.where(F.col(FRAGMENT_ID) != F.greatest(F.lit(0), F.ceil("rating") - 1)).count() == 0


def test_round_robin_stream_continues_after_restart(empty, landing, tmp_path):
    for first, last in [(0, 10), (10, 17), (17, 30)]:
        source = landing(first, last)
        finish(store_stream(source, empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    assert fragments(empty.split("ratings", ROUND_ROBIN)) == {i: i % 4 for i in range(30)}
    assert empty.cursor("ratings") == (4, 1)


def test_round_robin_stream_without_a_key(empty, landing, tmp_path):
    finish(store_stream(landing(0, 30), empty, "ratings", ROUND_ROBIN, str(tmp_path / "c")))
    sizes = [r["n_rows"] for r in empty.sizes("ratings", ROUND_ROBIN).orderBy(FRAGMENT_ID).collect()]
    assert sizes == [8, 8, 7, 7]


def test_stream_and_batches_share_the_cursor(spark, empty, landing, tmp_path):
    finish(store_stream(landing(0, 10), empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    empty.append_round_robin("ratings", spark.createDataFrame([(100, 1.0)], SCHEMA))
    finish(store_stream(landing(11, 15), empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    got = fragments(empty.split("ratings", ROUND_ROBIN))
    assert got == {**{i: i % 4 for i in range(10)}, 100: 2, **{i: i % 4 for i in range(11, 15)}}


@pytest.mark.parametrize("published", [False, True])
def test_batch_that_failed_is_replayed_once(spark, empty, landing, tmp_path, monkeypatch, published):
    """The query dies before, or just after, its batch was published."""
    finish(store_stream(landing(0, 10), empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    source = landing(10, 17)
    publish = store_module.Catalog.publish

    def dying(self, *entries):
        if published:
            publish(self, *entries)
        raise RuntimeError("killed")

    monkeypatch.setattr(store_module.Catalog, "publish", dying)
    with pytest.raises(Exception, match="killed"):
        finish(store_stream(source, empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    monkeypatch.undo()
    finish(store_stream(source, empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id"))
    assert fragments(empty.split("ratings", ROUND_ROBIN)) == {i: i % 4 for i in range(17)}


def test_same_batch_twice_is_written_once(spark, empty):
    batch = spark.createDataFrame([(1, 1.0), (2, 2.0)], SCHEMA)
    for _ in range(2):
        empty.append_round_robin("ratings", batch, stream=("query", 0))
        empty.append_range("ratings", batch, stream=("query", 0))
    assert empty.split("ratings", ROUND_ROBIN).count() == empty.split("ratings", RANGE).count() == 2
    empty.append_round_robin("ratings", batch, stream=("another query", 0))
    assert empty.split("ratings", ROUND_ROBIN).count() == 4


def test_range_stream_into_store(empty, landing, tmp_path):
    finish(store_stream(landing(0, 100), empty, "ratings", RANGE, str(tmp_path / "c")))
    assert empty.split("ratings", RANGE).count() == 100
    assert empty.rows_between("ratings", 4.5, 5.0).count() == 18


def test_a_named_stream(spark, empty, landing, tmp_path):
    finish(store_stream(landing(0, 10), empty, "ratings", ROUND_ROBIN, str(tmp_path / "c"), "id", name="mine"))
    assert empty.catalog.get("ratings", ROUND_ROBIN).streams == {"mine": 0}


def test_unknown_kind(empty, landing, tmp_path):
    with pytest.raises(ValueError):
        store_stream(landing(0, 1), empty, "ratings", "hash", str(tmp_path / "c"))
