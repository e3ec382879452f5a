"""Equal-width range assignment.

One formula decides the fragment of a value everywhere: in the split, in
appends, in expected counts and in range queries. Fragment 0 is closed at both
ends, every later fragment is open below and closed above::

    fragment(v) = ceil((v - lo) * n / (hi - lo)) - 1     lo <= v <= hi

kept within 0 and n - 1, where rounding could carry the ends across. Each step is a monotone IEEE operation, so ``a <= v <= b`` implies
``fragment(a) <= fragment(v) <= fragment(b)`` exactly. `fragment_span` relies
on it to turn a value interval into an interval of fragments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAGMENT_ID = "fragment_id"

# The default split column and its domain.
DEFAULT_COLUMN = "rating"
DEFAULT_LO = 0.0
DEFAULT_HI = 5.0

POLICIES = ("drop", "error", "clamp")


def check_fragment_count(n: int) -> int:
    """Return n if it is a usable fragment count, raise otherwise."""
    if isinstance(n, bool) or not isinstance(n, int):
        raise TypeError(f"the number of fragments must be an int, got {n!r}")
    if n < 1:
        raise ValueError(f"the number of fragments must be at least 1, got {n}")
    return n


@dataclass(frozen=True)
class RangeSpec:
    """A split of ``[lo, hi]`` on one column into n fragments of equal width."""

    n: int
    column: str = DEFAULT_COLUMN
    lo: float = DEFAULT_LO
    hi: float = DEFAULT_HI
    out_of_range: str = "drop"

    def __post_init__(self) -> None:
        check_fragment_count(self.n)
        if not (math.isfinite(self.lo) and math.isfinite(self.hi) and self.lo < self.hi):
            raise ValueError(f"need finite lo < hi, got [{self.lo}, {self.hi}]")
        if self.out_of_range not in POLICIES:
            raise ValueError(f"out_of_range must be one of {POLICIES}, got {self.out_of_range!r}")


def fragment_of_value(value: Column, n: int | Column, lo: float, hi: float) -> Column:
    """Fragment of a value, NULL when it is NULL, NaN or outside ``[lo, hi]``."""
    v = value.cast("double")
    n = n if isinstance(n, Column) else F.lit(n).cast("int")
    # The range test comes first: ceil(NaN) would silently cast to 0.
    position = F.ceil((v - F.lit(lo)) * n / F.lit(hi - lo)).cast("int")
    fragment = F.greatest(F.lit(0), F.least(n, position) - F.lit(1))
    return F.when(v.between(F.lit(lo), F.lit(hi)), fragment)


def fragment_column(spec: RangeSpec) -> Column:
    """Fragment id of the row under the spec's out-of-range policy.

    Clamping moves values below or above the domain to its nearest end. NULL and
    NaN have no nearest end and stay unassigned.
    """
    value = F.col(spec.column).cast("double")
    if spec.out_of_range == "clamp":
        clamped = F.greatest(F.lit(spec.lo), F.least(F.lit(spec.hi), value))
        value = F.when(value.isNotNull() & ~F.isnan(value), clamped)
    fragment = fragment_of_value(value, spec.n, spec.lo, spec.hi)
    if spec.out_of_range == "error":
        message = F.concat(
            F.lit(f"{spec.column} outside [{spec.lo}, {spec.hi}]: "),
            F.coalesce(value.cast("string"), F.lit("NULL")),
        )
        fragment = F.coalesce(fragment, F.raise_error(message).cast("int"))
    return fragment


def assign_range(df: DataFrame, spec: RangeSpec) -> DataFrame:
    """Add ``fragment_id``; rows without a fragment are left out.

    Under ``drop`` the test is on the bare column, so it reaches the scan as a
    pushed filter.
    """
    if spec.out_of_range == "drop":
        df = df.where(F.col(spec.column).between(F.lit(spec.lo), F.lit(spec.hi)))
    assigned = df.withColumn(FRAGMENT_ID, fragment_column(spec))
    if spec.out_of_range == "error":
        return assigned
    return assigned.where(F.col(FRAGMENT_ID).isNotNull())


def lower_bound(fragment: Column, spec: RangeSpec) -> Column:
    """Lower end of a fragment; open except for fragment 0."""
    return F.lit(spec.lo) + fragment * F.lit(spec.hi - spec.lo) / F.lit(float(spec.n))


def upper_bound(fragment: Column, spec: RangeSpec) -> Column:
    """Upper end of a fragment, closed."""
    return F.lit(spec.lo) + (fragment + F.lit(1)) * F.lit(spec.hi - spec.lo) / F.lit(float(spec.n))


def fragment_span(spec: RangeSpec, low: float, high: float) -> tuple[int, int] | None:
    """First and last fragment that can hold values of ``[low, high]``.

    None when no stored value can match. Clamped fragments also hold values from
    outside the domain, so interval ends are clamped in the same way; otherwise
    an interval that misses the domain is empty.
    """
    if math.isnan(low) or math.isnan(high) or low > high:
        return None
    if spec.out_of_range != "clamp" and (high < spec.lo or low > spec.hi):
        return None

    def fragment(value: float) -> int:
        inside = min(max(float(value), spec.lo), spec.hi)
        position = math.ceil((inside - spec.lo) * spec.n / (spec.hi - spec.lo))
        return max(0, min(spec.n, position) - 1)

    return fragment(low), fragment(high)
