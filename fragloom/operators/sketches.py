"""Quantiles and distinct counts by sketches that merge: a commit is sketched once.

KLL sketches hold ranks within about `RANK_ERROR` of the number of rows, HyperLogLog sketches
distinct counts within some `COUNT_ERROR` (three standard errors). Both are binary values of
some kilobytes, per fragment and commit; those of a whole split come by merging them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# KLL with k = 400 has a normalized rank error of 0.7 % for a single quantile; HLL with
# lgK = 12 one standard error of 1.6 %.
KLL_K = 400
HLL_LG_K = 12
RANK_ERROR = 0.01
COUNT_ERROR = 0.05


def sketch_fragments(df: DataFrame, by: str, column: str) -> DataFrame:
    """Per value of `by`: n_rows, and sketches of a column's values as double; null and NaN are left out."""
    value = F.col("`" + column.replace("`", "``") + "`").cast("double")
    value = F.when(~F.isnan(value), value)
    return df.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("kll"),
        F.hll_sketch_agg(value.cast("string"), F.lit(HLL_LG_K)).alias("hll"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of the union of rows, per value of the columns `by`, or of all."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.kll_merge_agg_double("kll", F.lit(KLL_K)).alias("kll"),
        F.hll_union_agg("hll").alias("hll"),
    )


def sketch_figures(sketches: DataFrame, by: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """`by`, n_rows, n_values (not null or NaN), distinct_values, and `quantiles` at these ranks; null without values."""
    n = F.kll_sketch_get_n_double("kll")
    at = F.array(*map(F.lit, ranks))
    return sketches.select(
        *by,
        "n_rows",
        n.alias("n_values"),
        F.hll_sketch_estimate("hll").alias("distinct_values"),
        F.when(n > 0, F.kll_sketch_get_quantile_double("kll", at)).alias("quantiles"),
    )
