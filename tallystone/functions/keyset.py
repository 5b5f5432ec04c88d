"""Row-value comparison for keyset paging.

``(a, b, c) > (x, y, z)`` asks for the rows after a place in the table's order;
a key column that the table keeps descending compares the other way.  Written
out as ORs of ANDs it reaches the Parquet reader, which a comparison of structs
does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import EngineError


def seek_after(columns: list[str], values: list, descending: list[bool] | None = None) -> Column:
    """Rows after ``values`` in the order of ``columns``, each ascending or descending."""
    descending = descending or [False] * len(columns)
    if not columns or not len(columns) == len(values) == len(descending):
        raise EngineError("row values of different sizes")
    out = None
    for i, (name, value, down) in enumerate(zip(columns, values, descending, strict=True)):
        here = F.col(name) < F.lit(value) if down else F.col(name) > F.lit(value)
        for before, same in zip(columns[:i], values[:i], strict=True):
            here = (F.col(before) == F.lit(same)) & here
        out = here if out is None else out | here
    # implied by all alternatives; alone it lets the reader skip row groups by the leading key
    first = F.col(columns[0]) <= F.lit(values[0]) if descending[0] else F.col(columns[0]) >= F.lit(values[0])
    return first & out


def seek_text(columns: list[str], values: list[str], descending: list[bool]) -> str:
    """The same as SQL text, for values that are SQL already."""
    parts = []
    for i, (name, value, down) in enumerate(zip(columns, values, descending, strict=True)):
        same = [f"{b} = {v}" for b, v in zip(columns[:i], values[:i], strict=True)]
        parts.append("(" + " AND ".join([*same, f"{name} {'<' if down else '>'} {value}"]) + ")")
    return "(" + " OR ".join(parts) + ")"
