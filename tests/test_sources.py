"""Delimited text in and out."""

import pytest
from pyspark.errors import PySparkException

from fragloom.functions.ranges import RangeSpec
from fragloom.sources.delimited import load_check, read_delimited, read_lines, read_with_fillers, reject_report
from fragloom.sources.exports import write_csv, write_lines, write_tsv
from fragloom.sources.metrics import observe_load

GOOD = ["1::122::5::838985046", "1::185::4.5::838983525"]
SHORT = "1::122::5"
LONG = "2::122::5::838985046::x"
BAD_ID = "one::122::5::838985046"
BAD_RATING = "3::122::five::838985046"


@pytest.fixture
def text(tmp_path):
    def write(*lines, end="\n"):
        path = tmp_path / "ratings.dat"
        path.write_bytes(end.join(lines).encode())
        return str(path)

    return write


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("read", [read_delimited, read_lines, read_with_fillers])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_good_file_without_final_newline(spark, text, read, end):
    df = read(spark, text(*GOOD, end=end))
    assert df.dtypes == [("userid", "int"), ("movieid", "int"), ("rating", "double")]
    assert rows(df) == [(1, 122, 5.0), (1, 185, 4.5)]


def test_rating_is_read_at_full_precision(spark, text):
    assert rows(read_lines(spark, text("1::1::3.7::0"))) == [(1, 1, 3.7)]


BROKEN = {
    "short": "1::122",
    "three fields": SHORT,
    "long": LONG,
    "blank": "",
    "white": "  ",
    "untypable id": BAD_ID,
    "untypable rating": BAD_RATING,
    "empty rating": "1::2::::5",
    "empty id": "::2::3::4",
    "quoted": '"1"::2::3::4',
    "too large": "99999999999::1::1::0",
}


@pytest.mark.parametrize("read", [read_delimited, read_lines, read_with_fillers])
@pytest.mark.parametrize("case", BROKEN)
def test_strict_readers_fail(spark, text, read, case):
    path = text(GOOD[0], BROKEN[case], GOOD[1])
    for column in ("userid", "rating"):
        if "id" in case and column == "rating" or "rating" in case and column == "userid" or case in ("quoted", "too large") and column == "rating":
            continue
        with pytest.raises(PySparkException, match="bad record"):
            read(spark, path).select(column).collect()


def test_reject_report_names_every_case(spark, text):
    path = text(*GOOD, *BROKEN.values())
    assert rows(reject_report(spark, path)) == [
        ("accepted", 2), ("blank", 2), ("empty rating", 1), ("empty userid", 1), ("long", 1), ("short", 2),
        ("untypable rating", 1), ("untypable userid", 3),
    ]


@pytest.mark.parametrize("policy, left_out", [("drop_short", 1), ("skip", 2)])
def test_load_check(spark, text, policy, left_out):
    path = text(*GOOD, SHORT, LONG)
    stored = read_lines(spark, path, bad_records=policy)
    assert tuple(load_check(spark, path, stored, policy).first()) == (4, left_out, 4 - left_out, True)
    assert not load_check(spark, path, stored.limit(1), policy).first()["agrees"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_lines_fail_in_any_session(spark, text, ansi):
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", ansi)
    with pytest.raises(PySparkException, match="bad record"):
        read_lines(session, text(BAD_ID)).collect()


def test_drop_short(spark, text):
    path = text(*GOOD, SHORT, LONG, "", "  \t3::7::1.5::0 \t")
    assert rows(read_lines(spark, path, bad_records="drop_short")) == [
        (1, 122, 5.0), (1, 185, 4.5), (2, 122, 5.0), (3, 7, 1.5)
    ]


def test_drop_short_fails_on_bad_values(spark, text):
    with pytest.raises(PySparkException, match="bad record"):
        read_lines(spark, text(*GOOD, BAD_ID), bad_records="drop_short").collect()


def test_skip(spark, text):
    path = text(*GOOD, SHORT, LONG, BAD_ID, BAD_RATING, "", "::::::", "99999999999::1::1::0", "5::6::0.5::no time")
    assert rows(read_lines(spark, path, bad_records="skip")) == [(1, 122, 5.0), (1, 185, 4.5), (5, 6, 0.5)]


def test_skip_does_not_depend_on_the_columns_used(spark, text):
    path = text(*GOOD, SHORT, LONG, BAD_ID, BAD_RATING)
    assert rows(read_lines(spark, path, bad_records="skip").select("movieid")) == [(122,), (185,)]
    assert read_lines(spark, path, bad_records="skip").count() == 2


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        read_lines(spark, "x", bad_records="guess")


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, 122, 4.5), (2, 7, None)], "userid int, movieid int, rating double")


def lines(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def test_exports(spark, frame, tmp_path):
    write_csv(frame, str(tmp_path / "csv"))
    write_tsv(frame, str(tmp_path / "tsv"))
    write_lines(frame, str(tmp_path / "dat"), "::")
    assert lines(spark, str(tmp_path / "csv")) == ["1,122,4.5", "2,7,"]
    assert lines(spark, str(tmp_path / "tsv")) == ["1\t122\t4.5", "2\t7\t"]
    assert lines(spark, str(tmp_path / "dat")) == ["1::122::4.5", "2::7::"]


@pytest.mark.parametrize("value", ["a::b", "a\nb", "a\rb"])
def test_lines_refuse_values_that_break_them(spark, tmp_path, value):
    with pytest.raises(Exception, match="separator or line end"):
        write_lines(spark.createDataFrame([(value,)], "a string"), str(tmp_path / "dat"), "::")


def test_metrics_come_with_the_load(spark, store):
    source = spark.createDataFrame([(1.0,), (7.0,), (None,), (-2.0,)], "rating double")
    observed, observation = observe_load(source, RangeSpec(5))
    store.load("ratings", observed)
    assert observation.get == {
        "n_rows": 4, "null_rows": 1, "out_of_range_rows": 3, "min_value": -2.0, "max_value": 7.0
    }
