"""Row figures gathered while a load runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fragloom.functions.ranges import RangeSpec


def observe_load(rows: DataFrame, spec: RangeSpec) -> tuple[DataFrame, Observation]:
    """The same rows, and figures that the next action on them fills in.

    They cost no pass of their own. Observe below the write without a shuffle in
    between, where each row is seen once.
    """
    observation = Observation("load")
    value = F.col(spec.column)
    inside = F.coalesce(value.between(F.lit(spec.lo), F.lit(spec.hi)), F.lit(False))
    observed = rows.observe(
        observation,
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(value.isNull(), 1)).alias("null_rows"),
        F.count(F.when(~inside, 1)).alias("out_of_range_rows"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
    return observed, observation
