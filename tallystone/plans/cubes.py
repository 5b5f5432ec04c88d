"""Rollup cubes: building, matching, and answering from fact, cube or both.

A query's time range [lo, hi) splits at the cube's buckets: the whole buckets
inside come from the cube, the two edges from the fact, and both are rolled up
together.  Bounds are made half-open first (``ts > x`` is ``ts >= x + 1
microsecond``), so no other case is left.

Both branches deliver the same columns (dims, the time bucket, and one partial
per measure), so one final aggregation serves all three routes:

    SUM -> SUM, COUNT -> SUM of counts (0 for nothing), MIN -> MIN, MAX -> MAX,
    ANY_VALUE -> ANY_VALUE, SUM0 -> SUM (0 for nothing), AVG -> SUM / COUNT

Outputs have the types, and averages of decimals the rounding, that the same
aggregate of the fact has, so the route does not show in the result.  MIN, MAX
and ANY_VALUE of a cube's dim need no measure.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ESTIMATES, Catalog, Cube, nests
from ..errors import EngineError
from ..functions.truncation import aligned_range

TICK = timedelta(microseconds=1)


@dataclass
class Agg:
    """One output: SUM, SUM0, COUNT, MIN, MAX, AVG, ANY_VALUE or another Spark aggregate of a column (None: rows)."""

    func: str
    column: str | None
    name: str
    distinct: bool = False


@dataclass
class Dimension:
    """A table joined on one of its columns, which must be unique there, to a column of the fact."""

    df: DataFrame
    fact_column: str
    dim_column: str
    columns: list[str]
    how: str = "inner"


@dataclass
class AggQuery:
    """An aggregate over one fact table.

    lo and hi bound the time column; ``where`` filters on plain dims: (columns used, condition).
    """

    fact: str
    dims: list[str]
    aggs: list[Agg]
    time: str | None = None
    unit: str | None = None
    unit_name: str = "bucket"
    lo: datetime | None = None
    hi: datetime | None = None
    lo_open: bool = False
    hi_closed: bool = False
    where: list[tuple[list[str], Column]] = field(default_factory=list)
    joins: list[Dimension] = field(default_factory=list)

    def half_open(self) -> tuple[datetime | None, datetime | None]:
        lo = self.lo + TICK if self.lo is not None and self.lo_open else self.lo
        hi = self.hi + TICK if self.hi is not None and self.hi_closed else self.hi
        return lo, hi

    def fact_dims(self) -> list[str]:
        """Columns of the fact by which partials must be kept apart."""
        joined = {c.lower() for j in self.joins for c in j.columns}
        names = [d for d in self.dims if d.lower() not in joined] + [j.fact_column for j in self.joins]
        return list(dict.fromkeys(names))


@dataclass
class Route:
    """How a query is answered: 'fact', 'cube' or 'union'; mid is the cube's share of the time range."""

    kind: str
    cube: Cube | None = None
    mid: tuple[datetime | None, datetime | None] = (None, None)


def truncated(column: Column | str, unit: str) -> Column:
    return F.date_trunc(unit, column).cast("timestamp_ntz")


def time_literal(t: datetime) -> Column:
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def build(fact: DataFrame, cube: Cube) -> DataFrame:
    """The cube's rows from the fact's: dims, the bucket under the time column's name, and the measures."""
    keys = [*cube.dims, truncated(cube.time, cube.unit).alias(cube.time)]
    return fact.groupBy(*keys).agg(*(_partial(m.func, m.column).alias(m.name) for m in cube.measures))


def merge(parts: DataFrame, cube: Cube) -> DataFrame:
    """Rows of one bucket from several parts of a cube made one; types stay as they are."""
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    return parts.groupBy(*cube.dims, cube.time).agg(*(_rolled(m.func, F.col(m.name)).cast(kinds[m.name]).alias(m.name) for m in cube.measures))


ROLLED = {"SUM": F.sum, "MIN": F.min, "MAX": F.max, "ANY_VALUE": F.any_value}


def _partial(func: str, column: str | None) -> Column:
    if func == "COUNT":
        return F.count(F.lit(1) if column is None else F.col(column))
    return ROLLED[func](F.col(column))


def _rolled(func: str, partial: Column) -> Column:
    if func == "COUNT":
        return F.coalesce(F.sum(partial), F.lit(0)).cast("long")
    return ROLLED[func](partial)


def _needs(q: AggQuery) -> list[tuple[str, str | None]] | None:
    """Partials that the query's outputs are made of; None if some output can't be rolled up."""
    out: list[tuple[str, str | None]] = []
    for a in q.aggs:
        if a.distinct or a.func not in (*ROLLED, "COUNT", "AVG", "SUM0"):
            return None
        out += {"AVG": [("SUM", a.column), ("COUNT", a.column)], "SUM0": [("SUM", a.column)]}.get(a.func, [(a.func, a.column)])
    return list(dict.fromkeys(out))


def _stored(cube: Cube, func: str, column: str | None) -> str | None:
    """The cube's column that holds a partial: a measure, or a dim, of which each row has one value."""
    found = cube.measure(func, column)
    if found:
        return found.name
    return column if func in ("MIN", "MAX", "ANY_VALUE") and column.lower() in {d.lower() for d in cube.dims} else None


def covers(cube: Cube, q: AggQuery) -> bool:
    """Whether the cube's rows can answer the query for whole buckets."""
    needs = _needs(q)
    dims = {d.lower() for d in cube.dims}
    used = {c.lower() for c in q.fact_dims()} | {c.lower() for cs, _ in q.where for c in cs}
    timed = q.unit is not None or q.lo is not None or q.hi is not None
    return (
        needs is not None
        and cube.fact.lower() == q.fact.lower()
        and used <= dims
        and all(_stored(cube, f, c) for f, c in needs)
        and (not timed or (q.time or "").lower() == cube.time.lower())
        and (q.unit is None or nests(cube.unit, q.unit))
    )


#: A fact and its cubes are taken to span so many seconds, and a unit's buckets to last so many.
SPAN = 365 * 86_400
SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86_400, "MONTH": 30 * 86_400, "QUARTER": 91 * 86_400, "YEAR": 365 * 86_400}


def _share(lo: datetime | None, hi: datetime | None) -> float:
    """Share of the rows in a time range; without both ends, all."""
    return 1.0 if lo is None or hi is None else min(1.0, max(0.0, (hi - lo).total_seconds()) / SPAN)


def cost(q: AggQuery, r: Route) -> float:
    """Rows read, by the estimates for each kind of table: an hourly cube has the cube's estimate, a coarser one less.

    What decides between cubes is mostly how much of the fact they leave at the edges.
    """
    lo, hi = q.half_open()
    if r.cube is None:
        return ESTIMATES["FACT"] * _share(lo, hi)
    low, high = r.mid
    edges = sum(_share(a, b) for a, b in ((lo, low), (high, hi)) if a != b)
    return ESTIMATES["FACT"] * edges + ESTIMATES["CUBE"] * _share(low, high) * SECONDS["HOUR"] / SECONDS[r.cube.unit]


def route(catalog: Catalog, q: AggQuery, enabled: bool = True) -> Route:
    """The cheapest way by ``cost``; of ways that cost the same, the cube with the fewest dims."""
    lo, hi = q.half_open()
    best = Route("fact")
    rank: tuple = (cost(q, best), 0, "")
    for cube in catalog.cubes_of(q.fact) if enabled else []:
        if not covers(cube, q):
            continue
        mid = aligned_range(lo, hi, cube.unit)
        if mid[0] is not None and mid[1] is not None and mid[0] >= mid[1]:
            continue
        made = Route("cube" if mid == (lo, hi) else "union", cube, mid)
        its = (cost(q, made), len(cube.dims), cube.name)
        if best.cube is None and its[0] <= rank[0] or best.cube is not None and its < rank:
            best, rank = made, its
    return best


def _within(column: str, lo: datetime | None, hi: datetime | None) -> Column | None:
    out = None
    if lo is not None:
        out = F.col(column) >= time_literal(lo)
    if hi is not None:
        out = F.col(column) < time_literal(hi) if out is None else out & (F.col(column) < time_literal(hi))
    return out


def _filtered(df: DataFrame, q: AggQuery, when: Column | None) -> DataFrame:
    for _, condition in q.where:
        df = df.filter(condition)
    return df if when is None else df.filter(when)


def partials(q: AggQuery, r: Route, fact: DataFrame, cube: DataFrame | None) -> DataFrame:
    """dims, bucket and partials p0, p1, ... from the route's branches."""
    lo, hi = q.half_open()
    needs = _needs(q)
    keys = list(q.fact_dims())

    def time_key(source: str) -> list[Column]:
        return [truncated(source, q.unit).alias(q.unit_name)] if q.unit else []

    def from_fact(when: Column | None) -> DataFrame:
        return _filtered(fact, q, when).groupBy(*keys, *time_key(q.time)).agg(*(_partial(f, c).alias(f"p{i}") for i, (f, c) in enumerate(needs)))

    if r.kind == "fact":
        return from_fact(_within(q.time, lo, hi) if q.time else None)
    own = _filtered(cube, q, _within(r.cube.time, *r.mid))
    own = own.select(*keys, *time_key(r.cube.time), *(F.col(_stored(r.cube, f, c)).alias(f"p{i}") for i, (f, c) in enumerate(needs)))
    if r.kind == "cube":
        return own
    low, high = r.mid
    edges = None
    for a, b in ((lo, low), (high, hi)):
        if a != b and not (a is None and b is None):
            one = _within(q.time, a, b)
            edges = one if edges is None else edges | one
    return from_fact(edges).unionByName(own)


def answer(q: AggQuery, r: Route, fact: DataFrame, cube: DataFrame | None) -> DataFrame:
    """The query's rows: dims, the bucket if asked for, and one column per output."""
    needs = _needs(q)
    if needs is None:
        if r.kind != "fact":
            raise EngineError("this aggregate can't be rolled up")
        lo, hi = q.half_open()
        df = _filtered(fact, q, _within(q.time, lo, hi) if q.time else None)
        for j in q.joins:
            df = _joined(df, j)
        keys = [*q.dims, *([truncated(q.time, q.unit).alias(q.unit_name)] if q.unit else [])]
        return df.groupBy(*keys).agg(*(_direct(a) for a in q.aggs))
    df = partials(q, r, fact, cube)
    for j in q.joins:
        df = _joined(df, j)
    place = {n: F.col(f"p{i}") for i, n in enumerate(needs)}
    kinds = {f.name: f.dataType for f in fact.groupBy().agg(*(_direct(a) for a in q.aggs)).schema.fields}
    outs = []
    for a in q.aggs:
        if a.func == "AVG":
            out = _average(F.sum(place["SUM", a.column]), F.sum(place["COUNT", a.column]), kinds[a.name])
        elif a.func == "SUM0":
            out = F.coalesce(F.sum(place["SUM", a.column]), F.lit(0))
        else:
            out = _rolled(a.func, place[a.func, a.column])
        outs.append(out.cast(kinds[a.name]).alias(a.name))
    return df.groupBy(*q.dims, *([q.unit_name] if q.unit else [])).agg(*outs)


def _average(total: Column, n: Column, kind: T.DataType) -> Column:
    """``total`` / ``n`` as Spark's average gives it; null for no rows.

    Of decimals: long division in two exact steps, before and after the point, then rounding half up; a plain decimal
    division would be rounded at another digit first.
    """
    n = F.nullif(n, F.lit(0))
    if not isinstance(kind, T.DecimalType):
        return total.cast("double") / n
    n, size, scale = n.cast("decimal(20,0)"), F.abs(total), kind.scale
    if scale > 10:  # too many digits for the exact steps
        return (total / n).cast(kind)
    rest = size % n
    shifted = (rest.cast(T.DecimalType(26, 6)) * F.lit(Decimal(10**scale))).cast("decimal(38,0)")
    over = shifted % n
    digits = ((shifted - over) / n).cast("decimal(37,0)") + F.when(over * 2 >= n, 1).otherwise(0)
    out = ((size - rest) / n).cast(T.DecimalType(36, scale)) + digits.cast(T.DecimalType(scale + 1, 0)) * F.lit(Decimal(1).scaleb(-scale))
    return F.when(total < 0, -out).otherwise(out)


def _joined(df: DataFrame, j: Dimension) -> DataFrame:
    d = j.df.select(F.col(j.dim_column).alias("_dim_key"), *(c for c in j.columns))
    return df.join(d, F.col(j.fact_column) == F.col("_dim_key"), j.how).drop("_dim_key")


def _direct(a: Agg) -> Column:
    c = F.lit(1) if a.column is None else F.col(a.column)
    if a.func == "COUNT":
        return (F.count_distinct(c) if a.distinct else F.count(c)).alias(a.name)
    if a.func == "SUM0":
        return F.coalesce(F.sum(c), F.lit(0)).alias(a.name)
    fn = getattr(F, a.func.lower(), None)
    if fn is None:
        raise EngineError(f"there is no aggregate {a.func}")
    return (F.sum_distinct(c) if a.distinct and a.func == "SUM" else fn(c)).alias(a.name)
