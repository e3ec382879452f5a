"""Fragment sizes and profiles, one pass each and complete for empty fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.functions.ranges import (
    FRAGMENT_ID,
    RangeSpec,
    assign_range,
    lower_bound,
    upper_bound,
)
from fragloom.operators.splits import round_robin_fragment


def row_count(df: DataFrame) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count("*").alias("n_rows"))


def all_fragments(df: DataFrame, n: int) -> DataFrame:
    """The ids 0..n-1, whether or not a fragment holds rows."""
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias(FRAGMENT_ID))


def fragment_sizes(assigned: DataFrame, n: int) -> DataFrame:
    """Rows per fragment; partial counts are merged, so a hot fragment is cheap."""
    counted = assigned.groupBy(FRAGMENT_ID).agg(F.count("*").alias("n_rows"))
    return (
        all_fragments(assigned, n)
        .join(counted, FRAGMENT_ID, "left")
        .select(FRAGMENT_ID, F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))
    )


def expected_range_sizes(base: DataFrame, spec: RangeSpec) -> DataFrame:
    """Rows per fragment that a range split of the base must have."""
    return fragment_sizes(assign_range(base.select(spec.column), spec), spec.n)


def expected_round_robin_sizes(base: DataFrame, n: int) -> DataFrame:
    """Rows per fragment that a round-robin split of the base must have.

    Dealing out N rows in turn gives fragment i the positions i, i + n, ..
    below N, so the count of rows decides all sizes.
    """
    total = base.agg(F.count("*").alias("total"))
    ids = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(FRAGMENT_ID)
    full, rest = F.expr(f"total div {n}"), F.pmod(F.col("total"), F.lit(n))
    return total.select("total", ids).select(
        FRAGMENT_ID,
        (full + F.when(F.col(FRAGMENT_ID) < rest, 1).otherwise(0)).cast("bigint").alias("n_rows"),
    )


def round_robin_sizes(numbered: DataFrame, position: Column, n: int) -> DataFrame:
    """Rows per fragment of actually numbered rows."""
    return fragment_sizes(numbered.select(round_robin_fragment(position, n).alias(FRAGMENT_ID)), n)


def fragment_profile(split: DataFrame, column: str, n: int, spec: RangeSpec | None = None) -> DataFrame:
    """Per fragment: rows, smallest and largest value, and the bounds of a range split."""
    found = split.groupBy(FRAGMENT_ID).agg(
        F.count("*").alias("n_rows"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )
    fragment = F.col(FRAGMENT_ID)
    bounds = [] if spec is None else [
        lower_bound(fragment, spec).alias("lower_bound"),
        upper_bound(fragment, spec).alias("upper_bound"),
    ]
    return (
        all_fragments(split, n)
        .join(found, FRAGMENT_ID, "left")
        .select(
            FRAGMENT_ID,
            *bounds,
            F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
            "min_value",
            "max_value",
        )
    )
