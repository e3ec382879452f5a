"""Rows of a range split joined with a table of intervals, without comparing all with all.

An interval becomes the span of fragments that it meets, one row for each, and those are joined
with the split by fragment id: an equi-join that prunes, at run time, the fragments that no
interval meets. What is left of the interval's condition is checked on the pairs. A row lies in
one fragment, so every pair is found once.

Pairs grow with the square of the tables. `interval_totals` gives what is in an interval, how many
rows and the least of a column, without making them. Equal values become one point; points and ends
of intervals are numbered in one order, so that an interval is a run of positions. Blocks of 1, 2,
4, .. positions have their totals, twice as many as there are positions, and a run is made of two
blocks of each size at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.functions.ranges import FRAGMENT_ID, RangeSpec, fragment_of_value
from fragloom.operators.numbering import ROW_NUMBER, number_rows

# Sizes of blocks, from the largest down, whose totals are broadcast: no more than 2^17 rows.
BROADCAST_LEVELS = 16

# Sizes that one reading of the points adds up to.
_LEVELS = 6


def interval_spans(intervals: DataFrame, spec: RangeSpec, low: str, high: str) -> DataFrame:
    """The intervals [low, high] with ``fragment_id``, a row for each fragment that they can meet.

    Empty intervals, and those with an end that is null or NaN, meet none. The fragments next to
    the ends are taken as well, as ends may lie on a bound.
    """

    def fragment(end: Column) -> Column:
        inside = F.greatest(F.lit(spec.lo), F.least(F.lit(spec.hi), end.cast("double")))
        return fragment_of_value(inside, spec.n, spec.lo, spec.hi)

    a, b = F.col(low).cast("double"), F.col(high).cast("double")
    first, last = F.greatest(fragment(a) - 1, F.lit(0)), F.least(fragment(b) + 1, F.lit(spec.n - 1))
    return _meeting(intervals, spec, low, high).withColumn(FRAGMENT_ID, F.explode(F.sequence(first, last)))


def _meeting(intervals: DataFrame, spec: RangeSpec, low: str, high: str) -> DataFrame:
    """The intervals that can hold a value of the split."""
    a, b = F.col(low).cast("double"), F.col(high).cast("double")
    wanted = (a <= b) & ~F.isnan(a) & ~F.isnan(b)
    if spec.out_of_range != "clamp":
        wanted = wanted & (b >= F.lit(spec.lo)) & (a <= F.lit(spec.hi))
    return intervals.where(wanted)


def interval_join(split: DataFrame, intervals: DataFrame, spec: RangeSpec, low: str, high: str) -> DataFrame:
    """All pairs of a row and an interval that holds its value; columns of both, which must differ."""
    spans = interval_spans(intervals, spec, low, high)
    value = F.col(spec.column).cast("double")
    pairs = split.join(spans, FRAGMENT_ID)
    return pairs.where(value.between(F.col(low).cast("double"), F.col(high).cast("double")))


def interval_totals(
    split: DataFrame, intervals: DataFrame, spec: RangeSpec, low: str, high: str, column: str, parts: int = 0
) -> DataFrame:
    """The intervals that hold a row's value, with ``n_rows`` and ``min_value``, the least of a column, over those rows.

    As the pairs of `interval_join` give by aggregation, but no pair is made. Points and ends are written
    once to the shared folder, sorted in `parts` as by `number_rows`.
    """
    ends = [F.col(low).cast("double").alias("low"), F.col(high).cast("double").alias("high")]
    asked = _meeting(intervals, spec, low, high).select(*ends).distinct()
    totals = _totals_of_runs(*_runs(split, asked, spec, column, parts))
    named = [c.alias(f"_{name}") for name, c in zip(("low", "high"), ends, strict=True)]
    whole = _meeting(intervals, spec, low, high).select(F.struct(*intervals.columns).alias("interval"), *named)
    on = (F.col("_low") == F.col("low")) & (F.col("_high") == F.col("high"))
    return whole.join(totals, on).select("interval.*", "n_rows", "min_value")


def _runs(split: DataFrame, asked: DataFrame, spec: RangeSpec, column: str, parts: int) -> tuple[DataFrame, DataFrame]:
    """The points (row_index, n_rows, min_value) and, of every interval, the run of positions from `first` to before `last`."""
    met = interval_spans(asked, spec, "low", "high").select(FRAGMENT_ID).distinct()
    rows = split.join(F.broadcast(met), FRAGMENT_ID, "left_semi")
    points = rows.groupBy(F.col(spec.column).cast("double").alias("at")).agg(
        F.count("*").alias("n_rows"), F.min(column).alias("min_value")
    )
    nothing = [F.lit(0).cast("bigint").alias("n_rows"), F.lit(None).cast(points.schema["min_value"].dataType).alias("min_value")]
    # Of what lies at one place, a low end comes first and a high end last.
    ordered = points.select("at", F.lit(1).alias("turn"), "n_rows", "min_value")
    for end, turn in (("low", 0), ("high", 2)):
        ordered = ordered.union(asked.select(F.col(end).alias("at"), F.lit(turn).alias("turn"), *nothing).distinct())
    numbered = number_rows(ordered, ["at", "turn"], parts=parts)
    first = numbered.where("turn = 0").select(F.col("at").alias("low"), (F.col(ROW_NUMBER) + 1).alias("first"))
    last = numbered.where("turn = 2").select(F.col("at").alias("high"), F.col(ROW_NUMBER).alias("last"))
    return numbered.where("turn = 1").select(ROW_NUMBER, "n_rows", "min_value"), asked.join(first, "low").join(last, "high")


def _sums() -> list[Column]:
    return [F.sum("n_rows").alias("n_rows"), F.min("min_value").alias("min_value")]


def _totals_of_runs(points: DataFrame, runs: DataFrame) -> DataFrame:
    """(low, high, n_rows, min_value) of the runs that hold points."""
    levels = (points.agg(F.max(ROW_NUMBER)).first()[0] or 0).bit_length() + 1
    blocks = []
    for least in range(0, levels, _LEVELS):
        block = F.shiftright(ROW_NUMBER, least).alias("block")
        base = points.groupBy(block).agg(*_sums()) if least else points.select(block, "n_rows", "min_value")
        step = F.explode(F.sequence(F.lit(0), F.lit(min(_LEVELS, levels - least) - 1))).alias("step")
        larger = base.select(step, "block", "n_rows", "min_value").select(
            (F.col("step") + least).alias("level"), F.expr("shiftright(block, step)").alias("block"), "n_rows", "min_value"
        )
        blocks.append(larger.groupBy("level", "block").agg(*_sums()))
    # At each size, the run's first block if it is no left half, and its last if that is no right half.
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    inner = runs.select("low", "high", "first", "last", level).select(
        "low", "high", "level",
        F.expr("shiftright(first + shiftleft(1L, level) - 1, level)").alias("a"),
        F.expr("shiftright(last, level)").alias("b"),
    ).where("a < b")
    odd = F.array(F.when(F.col("a") % 2 == 1, F.col("a")), F.when(F.col("b") % 2 == 1, F.col("b") - 1))
    pieces = inner.select("low", "high", "level", F.explode(odd).alias("block")).where("block IS NOT NULL")
    # Many runs have the same large blocks: those are broadcast, so that none draws them to one task.
    few = levels - BROADCAST_LEVELS
    found = reduce(DataFrame.union, blocks)
    met = pieces.where(F.col("level") >= few).join(F.broadcast(found.where(F.col("level") >= few)), ["level", "block"])
    if few > 0:
        met = met.union(pieces.where(F.col("level") < few).join(found.where(F.col("level") < few), ["level", "block"]))
    return met.groupBy("low", "high").agg(*_sums())
