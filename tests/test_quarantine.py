"""Line numbers of rejected lines, over splits of any size."""

import pytest

from fragloom.sources.quarantine import numbered_lines, quarantine


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
@pytest.mark.parametrize("end", ["\n", ""])
def test_numbers_are_those_of_the_file(spark, tmp_path, small_splits, size, end):
    small_splits(size)
    files = {"a.txt": [f"line {i} " + "x" * (i * 7 % 40) for i in range(60)], "b.txt": ["", "", "é", "", "last"], "c.txt": ["one"]}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + end)
    df = numbered_lines(spark, str(tmp_path))
    got = sorted((r.file.rsplit("/", 1)[1], r.line_number, r.line) for r in df.collect())
    assert got == sorted((name, i, line) for name, lines in files.items() for i, line in enumerate(lines, 1))
    everything = [line for name in sorted(files) for line in files[name]]
    assert [r.line for r in df.orderBy("position").collect()] == everything
    assert [r.position for r in df.orderBy("position").collect()] == list(range(1, len(everything) + 1))
    if size == 16:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_reasons_and_no_lines(spark, tmp_path):
    path = tmp_path / "r.dat"
    path.write_text("1::2::3.5::9\n\n1::2::3\n 1::2::x::9\n1::2::3::4::5\n::2::3::4\n1::2::3.5::9")
    got = [(r.line_number, r.reason, r.line) for r in quarantine(spark, str(path)).orderBy("line_number").collect()]
    assert got == [
        (2, "blank", ""), (3, "short", "1::2::3"), (4, "untypable rating", " 1::2::x::9"), (5, "long", "1::2::3::4::5"),
        (6, "empty userid", "::2::3::4"),
    ]
    path.write_text("")
    assert quarantine(spark, str(path)).collect() == []
