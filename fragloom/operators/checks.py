"""Correctness checks of a split. Each returns figures, not just a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragloom.functions.ranges import FRAGMENT_ID
from fragloom.operators.numbering import whole_row


def bag_difference(base: DataFrame, split: DataFrame) -> DataFrame:
    """One row: sizes of both bags, rows missing from the split, rows extra in it.

    Both sides are counted in one aggregation over all columns, so copies are
    merged before the shuffle and a lost row cannot hide behind a doubled one.
    Columns of map type cannot be compared; the query is refused.
    """
    rows = whole_row(base), whole_row(split.select(*(split["`" + c.replace("`", "``") + "`"] for c in base.columns)))
    tagged = base.select(rows[0], F.lit(1).alias("b"), F.lit(0).alias("s")).unionAll(
        split.select(rows[1], F.lit(0), F.lit(1))
    )
    per_row = tagged.groupBy("row").agg(F.sum("b").alias("b"), F.sum("s").alias("s"))

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return per_row.agg(
        total(F.col("b")).alias("base_rows"),
        total(F.col("s")).alias("split_rows"),
        total(F.greatest(F.col("b") - F.col("s"), F.lit(0))).alias("missing_rows"),
        total(F.greatest(F.col("s") - F.col("b"), F.lit(0))).alias("extra_rows"),
    )


def completeness(base: DataFrame, split: DataFrame) -> DataFrame:
    """Every base row is in some fragment."""
    return bag_difference(base, split).select(
        "base_rows", "split_rows", "missing_rows", (F.col("missing_rows") == 0).alias("complete")
    )


def disjointness(base: DataFrame, split: DataFrame) -> DataFrame:
    """No row is in the fragments more often than in the base."""
    return bag_difference(base, split).select(
        "base_rows", "split_rows", "extra_rows", (F.col("extra_rows") == 0).alias("disjoint")
    )


def reconstruction(base: DataFrame, split: DataFrame) -> DataFrame:
    """The union of all fragments is the base."""
    difference = bag_difference(base, split)
    return difference.withColumn("reconstructs", (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0))


def compare_sizes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected against actual rows per fragment; a fragment on one side only counts as 0."""
    return (
        expected.select(FRAGMENT_ID, F.col("n_rows").alias("expected_rows"))
        .join(actual.select(FRAGMENT_ID, F.col("n_rows").alias("actual_rows")), FRAGMENT_ID, "full")
        .na.fill(0, ["expected_rows", "actual_rows"])
        .withColumn("difference", F.col("actual_rows") - F.col("expected_rows"))
    )


def size_spread(sizes: DataFrame) -> DataFrame:
    """One row: smallest and largest fragment; a round robin differs by at most 1."""
    return sizes.agg(F.min("n_rows").alias("smallest"), F.max("n_rows").alias("largest")).withColumn(
        "balanced", F.col("largest") - F.col("smallest") <= 1
    )


def tuple_count(split: DataFrame, fragment: int, **values: object) -> DataFrame:
    """One row: how often a tuple occurs in one fragment; reads that fragment only."""
    rows = split.where(F.col(FRAGMENT_ID) == fragment)
    for name, value in values.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows.agg(F.count("*").alias("n_rows"))
