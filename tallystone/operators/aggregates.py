"""Aggregates that Spark has under no name of its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum0(column: Column | str) -> Column:
    """Sum that is 0 where there is nothing to add."""
    total = F.sum(column)
    return F.coalesce(total, F.lit(0))
