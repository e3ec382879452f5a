"""Horizontal table fragmentation on Spark."""

from fragloom.functions.ranges import RangeSpec
from fragloom.plans.store import FragmentStore

__all__ = ["FragmentStore", "RangeSpec"]
