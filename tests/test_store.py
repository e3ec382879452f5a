"""Tables, splits, appends and reads in a store."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fragloom import FragmentStore
from fragloom.errors import AlreadyExistsError, ConflictError, NotFragmentedError
from fragloom.operators import checks
from fragloom.operators.counts import expected_range_sizes, expected_round_robin_sizes
from fragloom.functions.ranges import RangeSpec
from fragloom.plans import store as store_module
from fragloom.operators.splits import union_of_fragments
from fragloom.plans import catalog as catalog_module
from fragloom.plans.catalog import BASE, RANGE, ROUND_ROBIN

# A 20-record sample, one user's ratings in file order, and the
# fragment sizes it must give for n = 5.
SAMPLE = [
    (122, 5.0), (185, 4.5), (231, 4.0), (292, 3.5), (316, 3.0), (329, 2.5), (355, 2.0), (356, 1.5), (362, 1.0),
    (364, 0.5), (370, 0.0), (377, 3.5), (420, 5.0), (466, 4.0), (480, 5.0), (520, 2.5), (539, 5.0), (586, 3.5),
    (588, 5.0), (589, 1.5),
]
RANGE_SIZES = [3, 3, 3, 5, 6]
ROUND_ROBIN_SIZES = [4, 4, 4, 4, 4]

SCHEMA = "userid int, movieid int, rating double"


@pytest.fixture
def sample(spark):
    return spark.createDataFrame([(1, movie, rating) for movie, rating in SAMPLE], SCHEMA)


@pytest.fixture
def loaded(store, sample):
    store.load("ratings", sample)
    return store


def one(spark, user, movie, rating):
    return spark.createDataFrame([(user, movie, rating)], SCHEMA)


def sizes(store, kind, table="ratings"):
    return [r["n_rows"] for r in store.sizes(table, kind).orderBy("fragment_id").collect()]


def bag(df):
    return sorted(tuple(r) for r in df.select("userid", "movieid", "rating").collect())


# -- base tables


def test_load_creates_and_appends(loaded, sample):
    assert loaded.base("ratings").count() == 20
    loaded.load("ratings", sample)
    assert loaded.base("ratings").count() == 40


def test_load_must_not_exist(loaded, sample):
    with pytest.raises(AlreadyExistsError):
        loaded.load("ratings", sample, mode="errorifexists")
    assert loaded.base("ratings").count() == 20


def test_unknown_load_mode(store, sample):
    with pytest.raises(ValueError):
        store.load("ratings", sample, mode="overwrite")


def test_reserved_column_names(store, sample):
    with pytest.raises(ValueError, match="fragment_id"):
        store.load("ratings", sample.withColumnRenamed("userid", "fragment_id"))


def test_missing_table(store):
    with pytest.raises(NotFragmentedError):
        store.base("ratings")


def test_failed_load_shows_nothing(spark, loaded, sample):
    bad = sample.withColumn("rating", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        loaded.load("ratings", bad)
    assert loaded.base("ratings").count() == 20
    loaded.load("ratings", sample)
    assert loaded.base("ratings").count() == 40


# -- splits


def test_range_split_of_sample(loaded, sample):
    loaded.split_range("ratings", 5)
    assert sizes(loaded, RANGE) == RANGE_SIZES
    assert bag(loaded.split("ratings", RANGE)) == bag(sample)
    assert loaded.partition_count("ratings", RANGE) == 5


@pytest.mark.parametrize("order_by", [None, "rating", ["rating", "movieid"]])
def test_round_robin_split_of_sample(loaded, sample, order_by):
    loaded.split_round_robin("ratings", 5, order_by)
    assert sizes(loaded, ROUND_ROBIN) == ROUND_ROBIN_SIZES
    assert bag(loaded.split("ratings", ROUND_ROBIN)) == bag(sample)
    assert loaded.cursor("ratings") == (5, 4)


def test_empty_fragments_are_counted(loaded):
    loaded.split_range("ratings", 15)
    found = sizes(loaded, RANGE)
    assert len(found) == 15 and sum(found) == 20
    assert [found[i] for i in (3, 6, 9, 12)] == [0, 0, 0, 0]
    assert loaded.fragment_names("range_part").count() == 15


def test_more_fragments_than_rows(loaded):
    loaded.split_round_robin("ratings", 23)
    assert sorted(sizes(loaded, ROUND_ROBIN)) == [0] * 3 + [1] * 20
    assert loaded.cursor("ratings") == (23, 19)


def test_empty_table(spark, store):
    store.load("ratings", spark.createDataFrame([], SCHEMA))
    store.split_range("ratings", 3)
    store.split_round_robin("ratings", 3)
    assert sizes(store, RANGE) == sizes(store, ROUND_ROBIN) == [0, 0, 0]
    assert store.cursor("ratings") == (3, -1)
    store.append_round_robin("ratings", one(spark, 1, 2, 3.0))
    assert sizes(store, ROUND_ROBIN) == [1, 0, 0]
    assert store.cursor("ratings") == (3, 0)


def test_null_rating(spark, store):
    """Out of range for ranges, a row like any other for round robin."""
    store.load("ratings", one(spark, 1, 2, None))
    store.split_range("ratings", 2)
    store.split_round_robin("ratings", 2)
    assert sizes(store, RANGE) == [0, 0]
    assert sizes(store, ROUND_ROBIN) == [1, 0]


@pytest.mark.parametrize("n, error", [(0, ValueError), (-1, ValueError), (2.5, TypeError)])
@pytest.mark.parametrize("kind", [RANGE, ROUND_ROBIN])
def test_bad_fragment_count_creates_nothing(loaded, kind, n, error):
    split = loaded.split_range if kind == RANGE else loaded.split_round_robin
    with pytest.raises(error):
        split("ratings", n)
    assert loaded.partition_count("ratings", kind) == 0
    assert loaded.fragment_names().count() == 0


@pytest.mark.parametrize("kind", [RANGE, ROUND_ROBIN])
def test_split_exists(loaded, kind):
    split = loaded.split_range if kind == RANGE else loaded.split_round_robin
    split("ratings", 5)
    with pytest.raises(AlreadyExistsError):
        split("ratings", 3)
    assert loaded.partition_count("ratings", kind) == 5
    split("ratings", 3, if_exists="overwrite")
    assert loaded.partition_count("ratings", kind) == 3
    assert sum(sizes(loaded, kind)) == 20


def test_tables_are_split_independently(spark, loaded):
    loaded.load("other", one(spark, 9, 9, 1.0))
    loaded.split_range("ratings", 5)
    loaded.split_range("other", 2)
    assert sizes(loaded, RANGE) == RANGE_SIZES
    assert sizes(loaded, RANGE, "other") == [1, 0]


def test_failed_split_shows_nothing(spark, loaded):
    loaded.load("ratings", one(spark, 1, 1, 9.0))
    with pytest.raises(Exception, match="outside"):
        loaded.split_range("ratings", 5, out_of_range="error")
    assert loaded.partition_count("ratings", RANGE) == 0
    loaded.split_range("ratings", 5)
    assert sizes(loaded, RANGE) == RANGE_SIZES


# -- appends


@pytest.mark.parametrize("rating, fragment", [(3.0, 2), (0.0, 0), (5.0, 4)])
def test_range_append(spark, loaded, rating, fragment):
    loaded.split_range("ratings", 5)
    loaded.append_range("ratings", one(spark, 100, 2, rating))
    found = loaded.count_tuple("ratings", RANGE, fragment, userid=100, movieid=2, rating=rating)
    assert found.first()["n_rows"] == 1
    assert loaded.split("ratings", RANGE).count() == 21
    assert loaded.base("ratings").count() == 20


def test_range_append_agrees_with_split_where_bounds_are_inexact(spark, loaded):
    """3 fragments: 5.0 belongs to the last one, not to a fourth."""
    loaded.split_range("ratings", 3)
    loaded.append_range("ratings", one(spark, 100, 2, 5.0))
    assert loaded.count_tuple("ratings", RANGE, 2, userid=100).first()["n_rows"] == 1


def test_range_append_with_base(spark, loaded):
    loaded.split_range("ratings", 5)
    loaded.append_range("ratings", one(spark, 100, 2, 3.0), also_base=True)
    assert loaded.base("ratings").count() == loaded.split("ratings", RANGE).count() == 21


@pytest.mark.parametrize("order_by, also_base", [(None, False), ("movieid", True), ("movieid", False)])
def test_round_robin_append_continues(spark, loaded, order_by, also_base):
    loaded.split_round_robin("ratings", 5)
    for start in (0, 3, 1):
        batch = spark.range(3).select(
            F.lit(100).alias("userid"), (F.col("id") + 1000 + start).cast("int").alias("movieid"), F.lit(3.0).alias("rating")
        )
        loaded.append_round_robin("ratings", batch, order_by, also_base)
    # Nine rows after a full round: fragments 0 1 2, 3 4 0, 1 2 3.
    assert sizes(loaded, ROUND_ROBIN) == [6, 6, 6, 6, 5]
    assert loaded.cursor("ratings") == (5, 3)
    assert loaded.base("ratings").count() == (29 if also_base else 20)


def test_round_robin_append_first_goes_to_fragment_0(spark, loaded):
    loaded.split_round_robin("ratings", 5)
    loaded.append_round_robin("ratings", one(spark, 100, 1, 3.0))
    assert loaded.count_tuple("ratings", ROUND_ROBIN, 0, userid=100, movieid=1, rating=3.0).first()["n_rows"] == 1


def test_cursor_taken_from_base_count(spark, loaded, sample):
    """The base grew behind the split's back: with `also_base` its count decides."""
    loaded.split_round_robin("ratings", 5)
    loaded.load("ratings", one(spark, 7, 7, 1.0))
    loaded.append_round_robin("ratings", one(spark, 100, 1, 3.0), also_base=True)
    assert loaded.count_tuple("ratings", ROUND_ROBIN, 1, userid=100).first()["n_rows"] == 1
    assert loaded.cursor("ratings") == (5, 1)


def test_empty_batch(spark, loaded):
    loaded.split_round_robin("ratings", 5)
    loaded.append_round_robin("ratings", spark.createDataFrame([], SCHEMA))
    assert loaded.cursor("ratings") == (5, 4)


@pytest.mark.parametrize("append", ["append_range", "append_round_robin"])
def test_append_needs_a_split(spark, loaded, append):
    with pytest.raises(NotFragmentedError):
        getattr(loaded, append)("ratings", one(spark, 1, 1, 1.0))


def test_copies_are_dealt_evenly(spark, loaded):
    """A batch whose rows are all alike still goes round."""
    loaded.split_round_robin("ratings", 5)
    copies = spark.range(1000).select(F.lit(1).alias("userid"), F.lit(1).alias("movieid"), F.lit(4.0).alias("rating"))
    loaded.append_round_robin("ratings", copies, order_by="movieid")
    assert sizes(loaded, ROUND_ROBIN) == [204] * 5


def test_append_failing_before_publication_leaves_nothing(spark, loaded, monkeypatch):
    """Not even in a session that overwrites only the partitions it writes."""
    loaded.split_round_robin("ratings", 5)
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    store = FragmentStore(session, loaded.root)
    three = session.range(3).selectExpr("7 AS userid", "int(id) AS movieid", "1.0D AS rating")
    monkeypatch.setattr(store_module.Catalog, "publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.append_round_robin("ratings", three)
    monkeypatch.undo()
    assert store.split("ratings", ROUND_ROBIN).count() == 20
    store.append_round_robin("ratings", one(session, 100, 1, 3.0))
    assert sizes(store, ROUND_ROBIN) == [5, 4, 4, 4, 4]


def test_stale_writer_is_refused(spark, loaded):
    """Another writer appends between this one's look at the catalog and its publishing."""
    loaded.split_round_robin("ratings", 5)
    entry = loaded.catalog.get("ratings", ROUND_ROBIN)
    other = FragmentStore(spark, loaded.root)
    other.append_round_robin("ratings", one(spark, 100, 1, 3.0))
    with pytest.raises(ConflictError):
        loaded.catalog.publish((entry, entry.after(1)))
    assert loaded.cursor("ratings") == other.cursor("ratings") == (5, 0)
    assert loaded.split("ratings", ROUND_ROBIN).count() == 21


def test_publishing_over_an_empty_snapshot_folder(loaded):
    """A publish that died left a folder without files."""
    Path(loaded.root, "_catalog", "version=1").mkdir()
    loaded.split_range("ratings", 5)
    assert sizes(loaded, RANGE) == RANGE_SIZES


# -- upkeep


def folders(path):
    return [p for p in Path(path).iterdir() if p.is_dir()] if Path(path).exists() else []


def test_many_appends_list_few_folders(spark, loaded, monkeypatch):
    loaded.split_round_robin("ratings", 5)
    entry = loaded.catalog.get("ratings", ROUND_ROBIN)
    for _ in range(30):
        grown = entry.after(0)
        loaded.catalog.publish((entry, grown))
        entry = grown
    assert len(folders(f"{loaded.root}/_catalog")) == catalog_module.KEPT_SNAPSHOTS
    assert FragmentStore(spark, loaded.root).catalog.get("ratings", ROUND_ROBIN).last_commit == entry.last_commit


@pytest.mark.parametrize("order_by", [None, "movieid"])
def test_nothing_is_left_staged(spark, loaded, order_by):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(folders(shared))
    loaded.split_round_robin("ratings", 5, order_by)
    loaded.append_round_robin("ratings", one(spark, 100, 1, 3.0), order_by)
    with pytest.raises(Exception, match="broken"):
        bad = one(spark, 100, 1, 3.0).withColumn("rating", F.raise_error(F.lit("broken")).cast("double"))
        loaded.append_round_robin("ratings", bad, order_by)
    assert set(folders(shared)) == before and not folders(f"{loaded.root}/_staging")


def test_compaction_keeps_rows_cursor_and_streams(spark, loaded):
    loaded.split_round_robin("ratings", 5)
    loaded.split_range("ratings", 5)
    for i in range(3):
        loaded.append_round_robin("ratings", one(spark, 100, i, 3.0), also_base=True, stream=("q", i))
        loaded.append_range("ratings", one(spark, 100, i, 3.0))
    before = {kind: bag(loaded.split("ratings", kind)) for kind in (RANGE, ROUND_ROBIN)}
    cursor = loaded.cursor("ratings")
    for kind in (BASE, RANGE, ROUND_ROBIN):
        old = loaded.catalog.get("ratings", kind).path
        loaded.compact("ratings", kind)
        assert not Path(old).exists()
        assert loaded.catalog.get("ratings", kind).last_commit == 0
    assert {kind: bag(loaded.split("ratings", kind)) for kind in (RANGE, ROUND_ROBIN)} == before
    assert loaded.base("ratings").count() == 23 and loaded.cursor("ratings") == cursor
    loaded.append_round_robin("ratings", one(spark, 100, 2, 3.0), stream=("q", 2))
    assert loaded.split("ratings", ROUND_ROBIN).count() == 23


def test_drop(loaded):
    loaded.split_range("ratings", 5)
    path = loaded.catalog.get("ratings", RANGE).path
    loaded.drop("ratings", RANGE)
    assert loaded.partition_count("ratings", RANGE) == 0 and not Path(path).exists()
    assert loaded.base("ratings").count() == 20
    with pytest.raises(NotFragmentedError):
        loaded.drop("ratings", RANGE)
    loaded.drop("ratings", BASE)
    with pytest.raises(NotFragmentedError):
        loaded.base("ratings")


@pytest.mark.parametrize("name", ["", "_catalog", "_staging", "a/b", "..", ".hidden", "a b"])
def test_table_names(store, sample, name):
    with pytest.raises(ValueError, match="name of a table"):
        store.load(name, sample)


# -- names


INTERNAL = (
    "row_index _row_index _lead _bucket _file_path _file_row _offset _storage_row _b _s b s _in_base _in_split line fields "
    "row tie at k0 file place offset path group rows record"
).split()


@pytest.mark.parametrize("order_by", [None, "key"])
def test_no_user_column_is_lost(spark, store, order_by):
    rows = spark.range(40).select(
        F.col("id").alias("key"), (F.col("id") % 5).cast("double").alias("rating"), *[(F.col("id") * 100 + i).alias(n) for i, n in enumerate(INTERNAL)]
    )
    want = sorted(tuple(r) for r in rows.union(rows).collect())
    store.load("t", rows)
    store.split_round_robin("t", 3, order_by)
    store.split_range("t", 5)
    store.append_round_robin("t", rows, order_by)
    store.append_range("t", rows)
    for kind in (RANGE, ROUND_ROBIN):
        split = store.split("t", kind)
        assert sorted(tuple(r)[:-1] for r in split.collect()) == want
        assert checks.disjointness(store.base("t"), split).first()["extra_rows"] == 40
        store.compact("t", kind)
        assert sorted(tuple(r)[:-1] for r in store.split("t", kind).collect()) == want


# -- reading


def test_union_of_fragments_is_one_scan(loaded):
    loaded.split_range("ratings", 500)
    both = union_of_fragments(loaded.split("ratings", RANGE), range(0, 500))
    assert both.count() == 20
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError, match="twice"):
        union_of_fragments(both, [1, 2, 1])


def test_rows_between_equals_filter_and_prunes(loaded, sample):
    loaded.split_range("ratings", 5)
    for low, high in [(0, 5), (1.0, 1.0), (1.2, 3.5), (-9, 0), (5, 9), (6, 7), (3, 2), (2.5, 2.6)]:
        got = loaded.rows_between("ratings", low, high)
        assert bag(got) == bag(sample.where(F.col("rating").between(low, high)))
    plan = loaded.rows_between("ratings", 1.2, 2.5)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "fragment_id" in filters[: filters.index("PushedFilters")]


def test_rows_between_finds_clamped_rows(spark, loaded):
    loaded.load("ratings", one(spark, 1, 1, 9.0))
    loaded.split_range("ratings", 5, out_of_range="clamp")
    assert bag(loaded.rows_between("ratings", 8, 10)) == [(1, 1, 9.0)]


def test_fragment_reads_one_directory(loaded):
    loaded.split_range("ratings", 5)
    part = loaded.fragment("ratings", RANGE, 1)
    assert sorted(r["rating"] for r in part.collect()) == [1.5, 1.5, 2.0]
    assert "fragment_id#" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_views(spark, loaded):
    loaded.split_range("ratings", 5)
    loaded.split_round_robin("ratings", 5)
    loaded.register_views("ratings", RANGE)
    loaded.register_views("ratings", ROUND_ROBIN)
    both = spark.sql("SELECT count(*) FROM range_part4 UNION ALL SELECT count(*) FROM rrobin_part0").collect()
    assert [r[0] for r in both] == [6, 4]


def test_names_match_the_prefix_literally(loaded):
    loaded.split_range("ratings", 5)
    loaded.split_round_robin("ratings", 2)
    assert loaded.fragment_names("range_part").count() == 5
    assert loaded.fragment_names("range%part").count() == loaded.fragment_names("rangeXpart").count() == 0
    assert {r["fragment_name"] for r in loaded.fragment_names("rrobin_part").collect()} == {"rrobin_part0", "rrobin_part1"}


def test_profile(loaded):
    loaded.split_range("ratings", 5)
    first = loaded.profile("ratings", RANGE).orderBy("fragment_id").first()
    assert tuple(first) == (0, 0.0, 1.0, 3, 0.0, 1.0)
    loaded.split_round_robin("ratings", 5)
    assert loaded.profile("ratings", ROUND_ROBIN).columns == ["fragment_id", "n_rows", "min_value", "max_value"]


def test_lookups_of_unknown_tables(store):
    assert store.partition_count("ratings", RANGE) == 0
    assert store.cursor("ratings") == (0, -1)


def test_another_session_sees_the_store(spark, loaded):
    loaded.split_range("ratings", 5)
    assert sizes(FragmentStore(spark.newSession(), loaded.root), RANGE) == RANGE_SIZES


# -- checks


def test_checks_of_a_good_split(loaded):
    loaded.split_range("ratings", 5)
    base, split = loaded.base("ratings"), loaded.split("ratings", RANGE)
    assert tuple(checks.reconstruction(base, split).first()) == (20, 20, 0, 0, True)
    expected = expected_range_sizes(base, RangeSpec(5))
    compared = checks.compare_sizes(expected, loaded.sizes("ratings", RANGE))
    assert [r["difference"] for r in compared.collect()] == [0] * 5


def test_lost_and_doubled_row_do_not_cancel(spark, sample):
    rows = sample.collect()
    damaged = spark.createDataFrame([rows[0], *rows[:-1]], SCHEMA)
    assert tuple(checks.completeness(sample, damaged).first()) == (20, 20, 1, False)
    assert tuple(checks.disjointness(sample, damaged).first()) == (20, 20, 1, False)
    assert tuple(checks.reconstruction(sample, damaged).first()) == (20, 20, 1, 1, False)


def test_checks_of_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tuple(checks.reconstruction(none, none).first()) == (0, 0, 0, 0, True)


def test_sizes_on_one_side_only(spark):
    left = spark.createDataFrame([(0, 3), (1, 2)], "fragment_id int, n_rows bigint")
    right = spark.createDataFrame([(1, 5), (2, 1)], "fragment_id int, n_rows bigint")
    got = sorted(tuple(r) for r in checks.compare_sizes(left, right).collect())
    assert got == [(0, 3, 0, -3), (1, 2, 5, 3), (2, 0, 1, 1)]


@pytest.mark.parametrize("rows, n", [(0, 3), (2, 3), (10, 3), (20, 5)])
def test_expected_round_robin_sizes(spark, rows, n):
    got = expected_round_robin_sizes(spark.range(rows), n).orderBy("fragment_id").collect()
    assert [r["n_rows"] for r in got] == [len(range(i, rows, n)) for i in range(n)]
