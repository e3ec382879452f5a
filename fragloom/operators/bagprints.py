"""Fingerprints of bags of rows: bags are compared by a few numbers instead of by their rows.

The print of a bag is its number of rows and, for two independent 64-bit hashes of a row, the
sum of each over all rows, copies counted, in whole numbers of 38 digits. Prints add up:
that of a union is the sum of those of its parts, in any order and any layout, so commits and
fragments are hashed once, and bags are equal if the sums are (but for a chance of 2^-128).
A lost row cannot hide behind a doubled one, as it would in a count.

Where prints differ, `differences` goes down by prefixes of the first hash: every bucket of a
level has its own print, and only buckets that differ are looked at again. Rows are compared as
rows, and shuffled, only in the buckets that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.operators.numbering import whole_row

PRINT = ("n_rows", "sum_a", "sum_b")

# Buckets a level, as bits, and levels; and buckets that differ before rows are compared at once.
BITS = 10
LEVELS = 3
MANY = 4096

_SUM = "decimal(38,0)"


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of all columns of a row, null apart from any value. Maps have no hash."""
    columns = [df["`" + name.replace("`", "``") + "`"] for name in df.columns]
    # A hash passes over nulls, so where they are is hashed as well.
    nulls = F.concat_ws("", *(F.when(c.isNull(), "1").otherwise("0") for c in columns))
    return F.xxhash64(nulls, *columns), F.xxhash64(F.lit("b"), *reversed(columns), nulls)


def _sums(sign: Column | None = None) -> list[Column]:
    times = F.lit(1) if sign is None else sign
    return [
        F.coalesce(F.sum(times), F.lit(0)).cast("bigint").alias("n_rows"),
        *(F.coalesce(F.sum((F.col(h) * times).cast("decimal(28,0)")), F.lit(0)).cast(_SUM).alias(f"sum_{h}") for h in "ab"),
    ]


def _hashed(df: DataFrame, *more: Column) -> DataFrame:
    a, b = row_hashes(df)
    return df.select(a.cast("decimal(20,0)").alias("a"), b.cast("decimal(20,0)").alias("b"), *more)


def bag_print(df: DataFrame) -> DataFrame:
    """One row: the print of all rows. Only partial sums are shuffled."""
    return _hashed(df).agg(*_sums())


def bag_prints(df: DataFrame, by: str) -> DataFrame:
    """The print of the rows of each value of a column, hashed without that column."""
    rows = df.drop(by)
    a, b = row_hashes(rows)
    hashed = df.select(a.cast("decimal(20,0)").alias("a"), b.cast("decimal(20,0)").alias("b"), df[by].alias(by))
    return hashed.groupBy(by).agg(*_sums())


def add_prints(prints: DataFrame) -> DataFrame:
    """One row: the print of the union of bags, from their prints."""
    return prints.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint" if c == "n_rows" else _SUM).alias(c) for c in PRINT))


def _tagged(base: DataFrame, split: DataFrame) -> DataFrame:
    """The rows of both bags as `row`, `sign` 1 or -1, `a`, `b`."""
    split = split.select(*(split["`" + c.replace("`", "``") + "`"] for c in base.columns))
    sides = []
    for side, sign in ((base, 1), (split, -1)):
        a, b = row_hashes(side)
        sides.append(side.select(whole_row(side), F.lit(sign).alias("sign"), a.alias("a"), b.alias("b")))
    return sides[0].unionAll(sides[1])


def differences(base: DataFrame, split: DataFrame, bits: int = BITS, levels: int = LEVELS) -> DataFrame:
    """The rows that one bag holds more often: `row`, missing_rows (from the split), extra_rows (in it).

    Each level is a scan of both bags that shuffles prints of at most 2^bits buckets below each
    bucket that differed; the numbers of those that differ come to the driver. The descent ends
    early when more than `MANY` differ: then rows differ all over, and all those are compared.
    """
    tagged = _tagged(base, split)
    live: list[int] | None = None
    for level in range(1, levels + 1):
        bucket = F.shiftright(F.col("a"), 64 - bits * level)
        rows = tagged if live is None else tagged.where(_in(F.shiftright(F.col("a"), 64 - bits * (level - 1)), live))
        prints = rows.select(
            bucket.alias("bucket"), "sign", F.col("a").cast("decimal(20,0)").alias("a"), F.col("b").cast("decimal(20,0)").alias("b")
        ).groupBy("bucket").agg(*_sums(F.col("sign")))
        found = prints.where("n_rows <> 0 OR sum_a <> 0 OR sum_b <> 0").select("bucket").limit(MANY + 1).collect()
        if len(found) > MANY:
            break
        live = [r["bucket"] for r in found]
        if not live:
            break
        last = level
    if live is not None:
        tagged = tagged.where(_in(F.shiftright(F.col("a"), 64 - bits * last), live) if live else F.lit(False))
    apart = tagged.groupBy("row").agg(F.sum("sign").alias("n")).where("n <> 0")
    return apart.select(
        "row",
        F.greatest(F.col("n"), F.lit(0)).cast("bigint").alias("missing_rows"),
        F.greatest(-F.col("n"), F.lit(0)).cast("bigint").alias("extra_rows"),
    )


def _in(column: Column, values: list[int]) -> Column:
    return column.isin(values)
