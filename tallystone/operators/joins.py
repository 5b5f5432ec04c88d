"""The hinted join: a small left side is looked up in a large right side.

Spark's form of it: the left side is broadcast if its measured size allows,
which also lets the scan of the right side skip what no left row can match;
above the limit the join is left to the optimizer (sort-merge, with run-time
filters and skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import UnsupportedOperation

#: Largest broadcast side, by the optimizer's estimate.
LIMIT_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it from files and statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def batched_join(left: DataFrame, right: DataFrame, on: Column | list[str], how: str = "inner", limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """INNER or LEFT join of a small ``left`` with a large ``right``."""
    how = how.lower()
    if how not in ("inner", "left"):
        raise UnsupportedOperation(f"the hinted join is INNER or LEFT, not {how}")
    if how == "inner" and estimated_bytes(left) <= limit_bytes:
        return F.broadcast(left).join(right, on, how)
    if how == "left" and estimated_bytes(right) <= limit_bytes:  # only the right side of a left join can be broadcast
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)
