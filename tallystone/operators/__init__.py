"""Relational operators on catalogued tables."""

from .aggregates import sum0
from .joins import batched_join
from .scan import Paging, cancellable, scan, timed_count

__all__ = ["Paging", "batched_join", "cancellable", "scan", "sum0", "timed_count"]
