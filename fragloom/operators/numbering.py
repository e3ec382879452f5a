"""Zero-based global row numbers without sending all rows to one task.

A window without PARTITION BY numbers rows in a single task. Two other ways are
used here.

`number_stored_rows` numbers the rows of a parquet table in storage order. The
position of a row in its file is given by the reader, so a row number is the
file's offset plus that position. No row is shuffled or sorted, and a re-run
task computes the same numbers.

`number_rows` numbers the rows by an order. They are dealt out by ranges of the
key and a tie-breaker, sorted in their part and written once, each with its place;
the row counts of the files then give the offset of each part. As the files fix
what the exchange chose, its cut points are never chosen twice.

Rows travel as one column, so names of the frame's columns are free.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.session import scratch_path

ROW_NUMBER = "row_index"

# Bytes of offsets, 16 a file or part, that are broadcast; beyond, the join is shuffled.
MAX_BROADCAST_BYTES = 64 << 20
GROUPS = 1024

# monotonically_increasing_id has the partition above this bit, the place below.
_PLACE_BITS = 33


def start_offsets(counts: DataFrame, unit: str, group: Column, order: str, unique: bool = True) -> DataFrame:
    """(unit, offset): the rows of all units before, by (group, order); `counts` has the units' `rows`.

    A group is one of `GROUPS` numbers. Within a group units are summed by a window; only the sums
    of groups come to the driver, as many for any number of units. With `unique` off two units
    of a group may be the same by hash, which is refused.
    """
    grouped = counts.withColumn("group", group)
    sums = (
        grouped.groupBy("group")
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("units"), F.count_distinct(unit).alias("ids"))
        .collect()
    )
    if not unique and any(g["units"] != g["ids"] for g in sums):
        raise ValueError("two files have paths of the same hash; rewrite the table")
    rows = {g["group"]: g["rows"] for g in sums}
    before = F.array(*map(F.lit, [0, *accumulate(rows.get(i, 0) for i in range(GROUPS))]))
    in_group = Window.partitionBy("group").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    offset = F.get(before.cast("array<bigint>"), F.col("group")) + F.sum("rows").over(in_group) - F.col("rows")
    offsets = grouped.select(unit, offset.alias("offset"))
    return F.broadcast(offsets) if 16 * sum(g["units"] for g in sums) <= MAX_BROADCAST_BYTES else offsets


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one."""
    return F.struct(*(df["`" + name.replace("`", "``") + "`"] for name in df.columns)).alias("row")


def free_name(df: DataFrame, name: str = ROW_NUMBER) -> str:
    """The name, with underscores in front until the frame has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _refuse_taken(df: DataFrame, into: str) -> None:
    if into.lower() in {column.lower() for column in df.columns}:
        raise ValueError(f"the frame has a column {into!r} already; name another one for the row number")


def number_stored_rows(stored: DataFrame, into: str = ROW_NUMBER) -> DataFrame:
    """Number all rows of a parquet table in storage order.

    `stored` must come straight from a parquet scan and may be filtered by
    partition columns only. Files are ordered by (hash group, path), which lets
    the running sum over files run in parallel too, and known to the join by an
    8-byte hash of their path.
    """
    _refuse_taken(stored, into)
    path = F.col("_metadata.file_path")
    files = stored.groupBy(path.alias("path")).agg(F.count("*").alias("rows")).withColumn("file", F.xxhash64("path"))
    group = F.pmod(F.col("file"), F.lit(GROUPS)).cast("int")
    offsets = start_offsets(files, "file", group, "path", unique=False)
    positioned = stored.select(
        whole_row(stored), F.xxhash64(path).alias("file"), F.col("_metadata.row_index").alias("place")
    )
    number = F.col("offset") + F.col("place")
    return positioned.join(offsets, "file").select("row.*", number.alias(into))


def number_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    into: str = ROW_NUMBER,
    scratch: str | None = None,
    parts: int = 0,
) -> DataFrame:
    """Number all rows by `order_by`, ascending, NULLs first; rows alike in it follow in any order.

    A value that many rows share is divided by the tie-breaker, the place a row was
    read at. The rows are written once, to `scratch` or a fresh path below the shared
    folder; the caller removes them when the result is no longer needed. They are sorted in
    `parts`, or as many as shuffles have if that is more; choose it by the stored size of
    large input. A key of a type that has no order is an error.
    """
    _refuse_taken(df, into)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    spark = df.sparkSession
    scratch = scratch or scratch_path(spark, "numbered")
    keys = [df[name].alias(f"k{i}") for i, name in enumerate(order_by)]
    names = [f"k{i}" for i in range(len(keys))]
    keyed = df.select(whole_row(df), *keys, F.monotonically_increasing_id().alias("tie"))
    parts = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    in_parts = keyed.repartitionByRange(parts, *names, "tie").sortWithinPartitions(*names, "tie")
    placed = in_parts.select("row", F.monotonically_increasing_id().alias("at"))
    placed.write.parquet(scratch)
    placed = spark.read.schema(placed.schema).parquet(scratch)
    placed = placed.withColumn("part", F.shiftright("at", _PLACE_BITS).cast("int"))
    counts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    # Parts in order, as many to a group as make GROUPS of them at most.
    offsets = start_offsets(counts, "part", F.floor(F.col("part") / -(-parts // GROUPS)).cast("int"), "part")
    number = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(offsets, "part").select("row.*", number.alias(into))
