"""Rejected lines with where they stand: file, line number and reason.

A text file is read in splits by many tasks, and no task knows how many lines lie before its own.
A first pass counts the lines of every split, the counts are summed over the splits of a file in
order, and a second pass adds that offset to a line's place in its split. Both passes read the
same splits; only one row a split is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.functions.fields import split_fields, strip
from fragloom.sources.delimited import FIELD_COUNT, RATINGS, SEPARATOR, reject_reason

_BLOCK = ("file", "block")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, position, line): every line of a file or folder with its number in the file, from 1.

    `position` counts on over the files in the order of their paths, from 1 too.

    A split may lie anywhere in a file; a line belongs to the split that it begins in. The table of
    splits, one row for each, is broadcast while Spark takes it to be small.
    """
    # Lines of a split follow each other in one task, so ids grow by one.
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    blocks = lines.groupBy(*_BLOCK).agg(F.min("at").alias("first"), F.count("*").alias("lines"))
    file = Window.partitionBy("file")
    before = F.coalesce(F.sum("lines").over(file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a file: small enough to be summed in order by one task.
    files = blocks.groupBy("file").agg(F.sum("lines").alias("lines"))
    ahead = F.coalesce(F.sum("lines").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", ahead.alias("ahead"))
    offsets = blocks.select(*_BLOCK, (before - F.col("first") + 1).alias("offset")).join(files, "file")
    number = F.col("at") + F.col("offset")
    return lines.join(offsets, list(_BLOCK)).select(
        "file", number.alias("line_number"), (number + F.col("ahead")).alias("position"), "line"
    )


def quarantine(
    spark: SparkSession,
    path: str,
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """(file, line_number, position, reason, line) of every line that a strict load would fail on; lines as they stand."""
    lines = numbered_lines(spark, path)
    fields = split_fields(strip(F.col("line")), separator)
    found = lines.withColumn("reason", reject_reason(fields, columns, field_count))
    return found.where("reason IS NOT NULL").select("file", "line_number", "position", "reason", "line")
