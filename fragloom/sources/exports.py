"""Writers of headerless delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_fields(df: DataFrame, separator: str) -> Column:
    """All columns of a row as one delimited line, NULL as an empty field.

    A value that would break the line, because it holds the separator or a line end, fails
    the job. NULL and empty text read back alike.
    """

    def field(name: str) -> Column:
        text = F.coalesce(df["`" + name.replace("`", "``") + "`"].cast("string"), F.lit(""))
        breaks = F.contains(text, F.lit(separator)) | F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
        failure = F.raise_error(F.concat(F.lit("value with a separator or line end: "), text)).cast("string")
        return F.when(breaks, failure).otherwise(text)

    return F.concat_ws(separator, *map(field, df.columns))


def write_lines(df: DataFrame, path: str, separator: str) -> None:
    """One line per row with any separator; fields are not quoted."""
    df.select(joined_fields(df, separator).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated values without a header, quoted where needed."""
    df.write.csv(path, header=False)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated values without a header."""
    df.write.csv(path, sep="\t", header=False)
