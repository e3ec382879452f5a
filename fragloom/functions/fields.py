"""Fields of delimited text lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters a line is stripped of at both ends: ASCII white space.
WHITE_SPACE = " \t\r\n\f\v"


def split_fields(line: Column, separator: str) -> Column:
    """All fields of a line; the separator is literal, empty fields are kept."""
    return F.split(line, re.escape(separator), -1)


def strip(line: Column) -> Column:
    """The line without white space at its ends."""
    return F.btrim(line, F.lit(WHITE_SPACE))


def typed(field: Column, kind: T.DataType) -> Column:
    """The field in the type asked for, NULL if it has no such value."""
    return field.try_cast(kind)


def typed_or_fail(field: Column, kind: T.DataType, line: Column) -> Column:
    """The field in the type asked for; a missing or bad value fails the job.

    Raised explicitly, so it does not depend on the session's ANSI setting.
    """
    failure = F.raise_error(F.concat(F.lit("bad record: "), line)).cast(kind)
    return F.coalesce(typed(field, kind), failure)
