"""Round-robin assignment and scans of split tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.functions.ranges import FRAGMENT_ID
from fragloom.operators.numbering import ROW_NUMBER


def round_robin_fragment(position: Column, n: int, start: int = 0) -> Column:
    """Fragment of the row at a zero-based position, counting from `start`."""
    return F.pmod(position + F.lit(start), F.lit(n)).cast("int")


def assign_round_robin(numbered: DataFrame, n: int, start: int = 0, number: str = ROW_NUMBER) -> DataFrame:
    """Turn the row number of a numbered frame, its column `number`, into ``fragment_id``."""
    assigned = numbered.withColumn(FRAGMENT_ID, round_robin_fragment(F.col(number), n, start))
    return assigned.drop(number)


def last_fragment(n_rows: Column, n: int | Column) -> Column:
    """Fragment of the last of `n_rows` rows dealt in turn, -1 for none."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(n_rows == 0, F.lit(-1)).otherwise(F.pmod(n_rows - 1, n)).cast("int")


def union_of_fragments(split: DataFrame, fragments: Iterable[int]) -> DataFrame:
    """The rows of several fragments: one scan, which reads their directories only."""
    fragments = list(fragments)
    if len(set(fragments)) < len(fragments):
        raise ValueError("a fragment is named twice")
    return split.where(F.col(FRAGMENT_ID).isin(fragments))
