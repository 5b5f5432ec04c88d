"""Scans with predicates, projection, paging and limits.

A disjunction of conjunctions is one filter on one scan: rows that match
several branches come once, and the reader still prunes by the whole OR.  An
OFFSET without an order means the order of the primary key, so that pages are
stable.  Sorted scans honour each key column's direction.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Table
from ..errors import EngineError
from ..functions.keyset import seek_after


def key_order(table: Table) -> list[Column]:
    return [F.col(k).desc() if table.descending(k) else F.col(k).asc() for k in table.key]


def nulls_high(column: str, descending: bool = False) -> Column:
    """Sort order with nulls above all values."""
    return F.col(column).desc_nulls_first() if descending else F.col(column).asc_nulls_last()


def pinned(condition: str, key: list[str]) -> set[str]:
    """Key columns that a condition holds to one value: an equality with a literal pins a column, AND pins what either
    side does, OR what both sides do."""
    from ..plans.tokens import closing, split, tokenise

    def of(t) -> set[str]:
        while t and t[0].text == "(" and closing(t, 0) == len(t) - 1:
            t = t[1:-1]
        parts = split(t, "OR")
        if len(parts) > 1:
            return set.intersection(*map(of, parts))
        if any(x.upper == "BETWEEN" for x in t):
            return set()
        parts = split(t, "AND")
        if len(parts) > 1:
            return set.union(*map(of, parts))
        sides = split(t, "=")
        if len(sides) != 2 or not all(sides):
            return set()
        for a, b in (sides, reversed(sides)):
            if len(a) == 1 and a[0].name.lower() in names and (b[-1].kind in ("number", "string")) and len(b) <= 2:
                return {a[0].name.lower()}
        return set()

    names = {k.lower() for k in key}
    return of(tokenise(condition))


def scan(df: DataFrame, table: Table, predicates: list[list[Column]] | Column | None = None, columns: list[str] | None = None, limit: int | None = None, offset: int | None = None, ordered: bool = False) -> DataFrame:
    """Rows of ``df`` that meet any of the conjunctions in ``predicates``; in key order if ``ordered`` or paged by offset."""
    if isinstance(predicates, Column):
        df = df.filter(predicates)
    elif predicates is not None:
        df = df.filter(reduce(or_, [reduce(and_, p, F.lit(True)) if p else F.lit(True) for p in predicates], F.lit(False)))
    if ordered or offset:
        if not table.key:
            raise EngineError(f"table {table.name} has no key to page by")
        df = df.orderBy(*key_order(table))
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns) if columns else df


class Paging:
    """Pages of a table in key order by keyset: each page seeks after the last key instead of skipping rows."""

    def __init__(self, df: DataFrame, table: Table, size: int, where: Column | None = None, key: list[str] | None = None):
        self.df = df if where is None else df.filter(where)
        self.table, self.size, self.key, self.last = table, size, key or table.key, None

    def page(self) -> DataFrame:
        """The page after the last key seen, as a lazy DataFrame."""
        down = [self.table.descending(k) for k in self.key]
        df = self.df if self.last is None else self.df.filter(seek_after(self.key, self.last, down))
        return df.orderBy(*(F.col(k).desc() if d else F.col(k).asc() for k, d in zip(self.key, down, strict=True))).limit(self.size)

    def __iter__(self) -> Iterator[list]:
        while rows := self.page().collect():  # a page at most
            self.last = [rows[-1][k] for k in self.key]
            yield rows


@contextmanager
def cancellable(spark: SparkSession) -> Iterator[callable]:
    """Within, jobs run in a group of their own; the value cancels them."""
    group = f"tallystone-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "cancellable", interruptOnCancel=True)
    try:
        yield lambda: spark.sparkContext.cancelJobGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def timed_count(df: DataFrame) -> dict:
    """Scan statistics of one run: rows, partitions that hold some, rows of the largest, and seconds."""
    begun = time.perf_counter()
    parts = df.groupBy(F.spark_partition_id().alias("part")).count()
    partitions, largest, rows = parts.agg(F.count("*"), F.max("count"), F.sum("count")).first()
    return {"rows": rows or 0, "partitions": partitions, "largest_partition": largest or 0, "total_s": time.perf_counter() - begun}
