"""Readers of headerless delimited text into typed columns.

Lines are split and typed in the scan stage. Fields beyond the wanted columns, such
as the time stamp of a ratings file, are not kept.

One rule holds for every strict reader: a line has exactly `field_count` fields, and each
wanted one is a value of its type as it stands. A blank line has too few fields. An empty or
quoted field is no number; as text it is kept as it is, quotes included. Any other line
fails the job. Other policies are chosen by name, in `read_lines` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.functions.fields import split_fields, strip, typed, typed_or_fail

# Separator, columns and field count of a ratings file.
SEPARATOR = "::"
RATINGS = T.StructType(
    [
        T.StructField("userid", T.IntegerType()),
        T.StructField("movieid", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
FIELD_COUNT = 4

BAD_RECORDS = ("fail", "drop_short", "skip")


def _lines(spark: SparkSession, path: str, separator: str, stripped: bool = False) -> DataFrame:
    """The lines of a file with their fields."""
    line = strip(F.col("value")) if stripped else F.col("value")
    lines = spark.read.text(path).select(line.alias("line"))
    return lines.select("line", split_fields(F.col("line"), separator).alias("fields"))


def _strict(
    records: DataFrame, columns: T.StructType, field_count: int | None, places: list[int] | None = None
) -> DataFrame:
    """Typed columns from the fields at `places`; a line that breaks the rule fails the job.

    The count of fields is checked with every column, so whatever columns are used.
    """
    whole = F.lit(True) if field_count is None else F.size("fields") == field_count
    places = places or list(range(len(columns)))
    return records.select(
        *[
            typed_or_fail(F.when(whole, F.get("fields", F.lit(i))), f.dataType, F.col("line")).alias(f.name)
            for i, f in zip(places, columns)
        ]
    )


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """Typed columns of a file whose records are all good."""
    return _strict(_lines(spark, path, separator), columns, field_count)


def read_lines(
    spark: SparkSession,
    path: str,
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    bad_records: str = "fail",
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """Typed columns by splitting lines, under a chosen bad-record policy.

    * ``fail``: the strict rule.
    * ``drop_short``: lines are stripped, those with fewer than `field_count`
      fields are left out, further fields of others ignored; an untypable wanted
      field fails the job.
    * ``skip``: lines with another number of fields or an untypable wanted
      field are left out.
    """
    if bad_records not in BAD_RECORDS:
        raise ValueError(f"bad_records must be one of {BAD_RECORDS}, got {bad_records!r}")
    records = _lines(spark, path, separator, stripped=bad_records != "fail")
    if bad_records == "drop_short":
        return _strict(records.where(F.size("fields") >= field_count), columns, None)
    if bad_records == "skip":
        return _typable(records, columns, field_count)
    return _strict(records, columns, field_count)


def _typable(records: DataFrame, columns: T.StructType, field_count: int) -> DataFrame:
    """Records with the right number of fields, all wanted ones typable.

    Good records are passed on through `inline`. A filter would be pushed below
    the projection, and every record split and cast once per condition.
    """
    values = F.struct(
        *[typed(F.get("fields", F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(columns)]
    )
    tried = records.select(values.alias("record"), (F.size("fields") == field_count).alias("complete"))
    good = F.col("complete")
    for name in columns.names:
        good = good & F.col("record").getField(name).isNotNull()
    kind = T.ArrayType(columns).simpleString()
    return tried.select(F.inline(F.when(good, F.array("record")).otherwise(F.array().cast(kind))))


def read_with_fillers(
    spark: SparkSession,
    path: str,
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """Typed columns by reading single-character separators.

    Half of the two-character separator delimits, so a filler field lies between
    every two fields; fillers and the fields behind the wanted ones are dropped.
    """
    places = [2 * i for i in range(len(columns))]
    return _strict(_lines(spark, path, separator[0]), columns, 2 * field_count - 1, places)


def reject_reason(fields: Column, columns: T.StructType, field_count: int) -> Column:
    """Why a line breaks the strict rule, NULL if it does not: the first of blank, short, long, untypable."""
    blank = (F.size(fields) == 1) & (F.get(fields, F.lit(0)) == "")
    reason = F.when(blank, "blank").when(F.size(fields) < field_count, "short").when(F.size(fields) > field_count, "long")
    for i, f in enumerate(columns):
        field = F.get(fields, F.lit(i))
        reason = reason.when(field == "", f"empty {f.name}") if f.dataType != T.StringType() else reason
        reason = reason.when(typed(field, f.dataType).isNull(), f"untypable {f.name}")
    return reason


def reject_report(
    spark: SparkSession,
    path: str,
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """Lines of a file by the reason for which a strict load would fail; `accepted` for the others."""
    records = _lines(spark, path, separator, stripped=True)
    reason = F.coalesce(reject_reason(F.col("fields"), columns, field_count), F.lit("accepted"))
    return records.groupBy(reason.alias("reason")).agg(F.count("*").alias("n_lines"))


def load_check(
    spark: SparkSession,
    path: str,
    stored: DataFrame,
    bad_records: str = "fail",
    columns: T.StructType = RATINGS,
    separator: str = SEPARATOR,
    field_count: int = FIELD_COUNT,
) -> DataFrame:
    """One row: lines of the file, lines the policy leaves out, rows stored, whether they agree."""
    if bad_records not in BAD_RECORDS:
        raise ValueError(f"bad_records must be one of {BAD_RECORDS}, got {bad_records!r}")
    records = _lines(spark, path, separator, stripped=bad_records != "fail")
    out = {
        "fail": F.lit(False),
        "drop_short": F.size("fields") < field_count,
        "skip": reject_reason(F.col("fields"), columns, field_count).isNotNull(),
    }[bad_records]
    lines = records.agg(F.count("*").alias("n_lines"), F.count_if(out).alias("left_out"))
    rows = stored.agg(F.count("*").alias("stored_rows"))
    # Two single rows side by side.
    one = lines.withColumn("one", F.lit(1)).join(rows.withColumn("one", F.lit(1)), "one").drop("one")
    return one.withColumn("agrees", F.col("n_lines") - F.col("left_out") == F.col("stored_rows"))
