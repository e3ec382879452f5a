"""Shards of near-equal size by histogram sort.

Rows are put in the order of a group key and a row key. Candidate boundaries between
shards are probed: every partition counts the exact bytes and rows below all probes,
the counts are summed, and new probes divide the interval that holds each wanted size,
until the bytes below a boundary meet the tolerance. Only then are the rows exchanged,
once, into parts of bounded size, several to a shard; as the rows below every boundary
are known exactly, a row's slot in its shard is the start of its part and its place in it.

A boundary first looks for a place between groups, so that a group stays whole where the
tolerance allows; a group too large for that is cut by the row key. Rows alike in both
keys stay together. Nulls in a key come first, a null size counts 0. An empty table gives
no rows. Columns of any name are kept; the two added must not exist.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fragloom.llm.common import quoted, stored, table, tasks

SHARDS = 8

# How far the bytes below a boundary may be from those wanted: shares of a shard, of a part.
TOLERANCE = 0.005
PART_TOLERANCE = 0.25

# Rows that a task sorts, about; probes counted in a round, all boundaries together.
ROWS_PER_PART = 1_000_000
PROBES = 1 << 16

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


class Boundaries:
    """Sorted pairs of 64-bit keys; finds how many of them lie at or below each row."""

    def __init__(self, pairs: list[tuple[int, int]]):
        self.groups = np.array([a for a, _ in pairs], np.int64)
        self.rows = np.array([b for _, b in pairs], np.int64)

    def below(self, group: np.ndarray, row: np.ndarray) -> np.ndarray:
        first = np.searchsorted(self.groups, group, "left")
        last = np.searchsorted(self.groups, group, "right")
        found = first.copy()
        for start in np.unique(first[last > first]):
            inside = (first == start) & (last > first)
            end = np.searchsorted(self.groups, self.groups[start], "right")
            found[inside] = start + np.searchsorted(self.rows[start:end], row[inside], "right")
        return found


@dataclass
class Search:
    """The interval that holds one boundary: `low` and `high` are values of the group key,
    or of the row key inside the group `inside`."""

    goal: float
    tolerance: float
    low: int
    high: int
    below_low: int
    below_high: int
    inside: int | None = None
    done: tuple[int, int] | None = None

    def pair(self, value: int) -> tuple[int, int]:
        value = min(value, _HIGH)
        return (value, _LOW) if self.inside is None else (self.inside, value)

    def probes(self, count: int) -> list[int]:
        width = self.high - self.low
        values = {self.low + width * i // (count + 1) for i in range(1, count + 1)}
        return [v for v in values if self.low < v < self.high]

    def learn(self, value: int, below: int) -> None:
        if below <= self.goal and value >= self.low:
            self.low, self.below_low = value, below
        elif below > self.goal and value <= self.high:
            self.high, self.below_high = value, below

    def settle(self, row_low: int, row_high: int) -> None:
        """Take an end of the interval if it is near enough, or go inside the last group left."""
        short, over = self.goal - self.below_low, self.below_high - self.goal
        near = self.low if short <= over else self.high
        if min(short, over) <= self.tolerance:
            self.done = self.pair(near)
        elif self.high - self.low <= 1:
            if self.inside is None:
                self.inside, self.low, self.high = self.low, row_low, row_high
            else:
                self.done = self.pair(near)


_COUNTS = T.StructType(
    [
        T.StructField("place", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def _histogram(keys: DataFrame, probes: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe; the driver gets at most one row a probe."""
    shared = keys.sparkSession.sparkContext.broadcast(Boundaries(probes))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(shared.value.groups) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            group, row, weight = (np.asarray(c) for c in batch.columns)
            place = shared.value.below(group, row)
            np.add.at(size, place, weight)
            rows += np.bincount(place, minlength=n)
        held = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held, size[held], rows[held])], names=_COUNTS.names)

    sums = keys.mapInArrow(count, _COUNTS).groupBy("place").agg(F.sum("bytes"), F.sum("rows")).collect()
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for place, b, r in sums:
        size[place], rows[place] = b, r
    return np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist()


def _boundaries(keys: DataFrame, goals: list[tuple[float, float]], total: int, ends: tuple) -> list[tuple[int, int]]:
    """A boundary for each (goal, tolerance), in order."""
    low, high, row_low, row_high = ends
    searches = [Search(goal, tolerance, low, high + 1, 0, total) for goal, tolerance in goals]
    for search in searches:
        search.settle(row_low, row_high + 1)
    while left := [s for s in searches if s.done is None]:
        wanted = [(s, s.probes(max(3, PROBES // len(left)))) for s in left]
        probes = sorted({s.pair(value) for s, values in wanted for value in values})
        if probes:
            below = dict(zip(probes, _histogram(keys, probes)[0], strict=True))
            for search, values in wanted:
                for value in values:
                    search.learn(value, below[search.pair(value)])
        for search in left:
            search.settle(row_low, row_high + 1)
    found = [s.done for s in searches]
    for i in range(1, len(found)):
        found[i] = max(found[i], found[i - 1])
    return found


def histogram_shards(
    rows: DataFrame, group: Column, row: Column, size: Column, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """All rows with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    `group` and `row` are 64-bit integers. The frame is read twice, once for the keys and
    once for the exchange; keys and sizes are written to the shared folder between.
    """
    least = F.lit(_LOW)
    weight = F.coalesce(size.cast("bigint"), F.lit(0))
    by_group, by_row = F.coalesce(group, least), F.coalesce(row, least)
    keys = stored(rows.select(by_group.alias("g"), by_row.alias("r"), weight.alias("w")), "shard-keys")
    n, total, *ends = keys.agg(
        F.count("*"), F.coalesce(F.sum("w"), F.lit(0)), F.min("g"), F.max("g"), F.min("r"), F.max("r")
    ).first()
    parts = shards * max(1, -(-n // (shards * ROWS_PER_PART)), -(-tasks(rows) // shards))
    a_shard = parts // shards
    goals = [
        (total * i / parts, tolerance * total / shards if i % a_shard == 0 else PART_TOLERANCE * total / parts)
        for i in range(1, parts)
    ]
    cuts = _boundaries(keys, goals, total, tuple(ends)) if n else []
    starts = [0, *_rows_below(keys, cuts)] if n else [0] * parts
    shared = rows.sparkSession.sparkContext.broadcast(Boundaries(cuts))

    @F.pandas_udf("int")
    def part_of(g: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(shared.value.below(g.to_numpy(), r.to_numpy()).astype(np.int32))

    # The row travels as one column, so that its names are free.
    whole = F.struct(*(rows[quoted(c)] for c in rows.columns)).alias("row")
    placed = rows.select(whole, by_group.alias("g"), by_row.alias("r")).withColumn("part", part_of("g", "r"))
    placed = placed.repartitionById(parts, F.col("part"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("g", "r"))
    shard = F.expr(f"part div {a_shard}").cast("int")
    # Parts of a shard start at the rows below them, less the rows of the shards before.
    starts_in_shard = [start - starts[i // a_shard * a_shard] for i, start in enumerate(starts)]
    offset = F.get(F.split(F.lit(",".join(map(str, starts_in_shard))), ",").cast("array<bigint>"), F.col("part"))
    return placed.select("row.*", shard.alias("shard"), (offset + place - 1).alias("slot"))


def _rows_below(keys: DataFrame, cuts: list[tuple[int, int]]) -> list[int]:
    distinct = sorted(set(cuts))
    rows = dict(zip(distinct, _histogram(keys, distinct)[1], strict=True)) if distinct else {}
    return [rows[cut] for cut in cuts]


def op10_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards of near-equal bytes; groups are equal texts."""
    documents = table(spark, sf_dir, "documents")
    text = F.coalesce(documents["text"], F.lit(""))
    sized = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    sized = stored(sized, "sized-documents")
    sharded = histogram_shards(sized, F.col("text_hash"), F.col("doc_id"), F.col("size"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
