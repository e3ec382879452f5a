"""Bitmaps of hashes, of a fixed size, that let tasks leave out most rows before a shuffle.

A bitmap may say yes to a hash that it does not hold, never no to one that it does: what passes
is told apart by joins later. Its size does not grow with the data; on very large tables it
fills up and leaves out less.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.llm.common import give_back, tasks, tidy

BITS = 1 << 27

# What one group of Spark's bitmap aggregate holds.
_GROUP = 1 << 15


def bitmap_of(hashes: DataFrame):
    """A broadcast bitmap of one column of well-mixed 64-bit hashes; `BITS` / 8 bytes, 16 MB.

    Its parts come to the driver in one job, whatever the number of tasks.
    """
    value = F.col(hashes.columns[0])
    place = value.bitwiseAND(F.lit(BITS - 1))
    placed = hashes.select(
        F.shiftright(place, 15).alias("part"), place.bitwiseAND(F.lit(_GROUP - 1)).alias("place")
    ).repartition(tasks(hashes), "part")
    bits = np.zeros(BITS // 8, np.uint8)
    with tidy(hashes.sparkSession):
        parts = placed.groupBy("part").agg(F.bitmap_construct_agg("place")).collect()
    for part, held in parts:
        start = part * _GROUP // 8
        bits[start : start + len(held)] = np.frombuffer(held, np.uint8)
    # The driver's Python need not keep the parts beside the whole.
    parts.clear()
    shared = hashes.sparkSession.sparkContext.broadcast(bits)
    give_back()
    return shared


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap may hold."""
    place = hashes.astype(np.int64) & (8 * len(bits) - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def may_hold(shared, hashes: Column) -> Column:
    """The same for a column of a frame; no other column reaches Python."""

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(held(shared.value, values.to_numpy()))

    return test(hashes)
