"""A session: catalog, SQL, programmatic scans and aggregates, inserts and commits."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog, Cube, Table
from .errors import DuplicateKey, EngineError, UnsupportedOperation
from .operators.joins import LIMIT_BYTES, estimated_bytes
from .operators.scan import Paging, key_order
from .operators.scan import scan as scan_table
from .plans import cubes, ddl
from .plans.dialect import Dialect, bound
from .plans.select import read_aggregate
from .sources.store import Store


@dataclass
class EngineConfig:
    enable_inserts: bool = False
    #: Write facts without maintaining their cubes' rows.
    disable_cube_aggregation: bool = False
    #: Never answer from a cube unless it is named.
    disable_materialized_views: bool = False
    #: Read the version that was newest so many milliseconds ago.
    snapshot_difference_ms: int = 0
    #: Parts of a cube before a commit merges them.
    cube_parts: int = 8
    auto_commit: bool = False


class Session:
    """Tables are registered DataFrames, or live in a ``Store`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None, config: EngineConfig | None = None):
        self.spark, self.config = spark, config or EngineConfig()
        if self.config.auto_commit:
            raise UnsupportedOperation("auto-commit is not supported: call commit()")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.caseSensitive", "false")
        self.store = Store(spark, root) if root else None
        self.catalog, self._frames, self._cubes = Catalog(), {}, {}
        self._rows: dict[str, list[tuple]] = {}
        self._bulk: dict[str, list[DataFrame]] = {}
        self._base, self._folders, self._streams = 0, {}, {}
        self.refresh()

    # -- catalog

    def refresh(self) -> None:
        """Reads the store's newest version (or the one that the snapshot setting asks for)."""
        if not self.store:
            return
        back = self.config.snapshot_difference_ms
        found = self.store.newest(int(time.time() * 1000) - back if back else None)
        registered = [t for k, t in self.catalog.tables.items() if k in self._frames]
        self._base, self._folders, self.catalog, self._streams = found["version"], found["folders"], Catalog.loads(found["catalog"]), found.get("streams", {})
        for t in registered:
            self.catalog.tables.setdefault(t.name.lower(), t)

    def register(self, table: Table, df: DataFrame) -> None:
        """A table whose rows are ``df``."""
        self.catalog.add(table)
        self._frames[table.name.lower()] = df

    def register_cube(self, cube: Cube, df: DataFrame | None = None) -> None:
        """A cube over a registered fact; without ``df`` its rows are computed when asked for."""
        self.catalog.add_cube(cube)
        self._cubes[cube.name.lower()] = df

    def tables(self) -> list[tuple[str, str, int]]:
        return self.catalog.listing()

    def table(self, name: str) -> DataFrame:
        """Rows of a table or cube."""
        low = name.lower()
        if low in self.catalog.cubes:
            return self.cube(self.catalog.cubes[low])
        meta = self.catalog.table(name)
        if low in self._frames:
            return self._frames[low]
        return self.store.read(meta, self._folders.get(low, []))

    def cube(self, cube: Cube) -> DataFrame:
        low = cube.name.lower()
        if low in self._cubes:
            df = self._cubes[low]
            return cubes.build(self.table(cube.fact), cube) if df is None else df
        return cubes.merge(self._parts(cube), cube)

    def _parts(self, cube: Cube) -> DataFrame:
        return self.store.read_parts(self._cube_schema(cube), self._folders.get(cube.name.lower(), []))

    def _cube_schema(self, cube: Cube) -> str:
        empty = self.spark.createDataFrame([], self.catalog.table(cube.fact).schema())
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cubes.build(empty, cube).schema.fields)

    # -- reading

    def scan(self, name: str, predicates=None, columns: list[str] | None = None, limit: int | None = None, offset: int | None = None, ordered: bool = False) -> DataFrame:
        return scan_table(self.table(name), self.catalog.table(name), predicates, columns, limit, offset, ordered)

    def pages(self, name: str, size: int, where: SparkColumn | None = None) -> Paging:
        return Paging(self.table(name), self.catalog.table(name), size, where)

    def route(self, q: cubes.AggQuery) -> cubes.Route:
        return cubes.route(self.catalog, q, not self.config.disable_materialized_views)

    def aggregate(self, q: cubes.AggQuery) -> DataFrame:
        """The query's rows from fact, cube, or both."""
        r = self.route(q)
        if r.cube is None:
            cube = None
        elif r.cube.name.lower() in self._cubes:
            cube = self.cube(r.cube)
        else:  # parts need no merging first: the roll-up adds them
            cube = self._parts(r.cube)
        return cubes.answer(q, r, self.table(q.fact), cube)

    def sql(self, statement: str, args: list | None = None) -> DataFrame | None:
        """Runs a statement; queries give a DataFrame."""
        word = statement.strip().rstrip(";").upper()
        if word == "COMMIT":
            return self.commit()
        if word == "ROLLBACK":
            return self.rollback()
        parsed = ddl.parse(statement)
        if isinstance(parsed, ddl.CreateTable):
            return self._create_table(parsed)
        if isinstance(parsed, ddl.CreateCube):
            return self._create_cube(parsed)
        if isinstance(parsed, ddl.AlterTable):
            return self._alter(parsed)
        if isinstance(parsed, ddl.Insert):
            return self._insert(parsed, args)
        return self.query(statement.strip().rstrip(";"), args)

    def route_of(self, text: str, args: list | None = None) -> cubes.Route:
        """How a query is answered; what only Spark can read goes to the fact."""
        found = read_aggregate(bound(text, args), self.catalog, self.table)
        return self.route(found[0]) if found else cubes.Route("fact")

    def query(self, text: str, args: list | None = None) -> DataFrame:
        text = bound(text, args)
        found = read_aggregate(text, self.catalog, self.table)
        if found is not None:
            q, finish = found
            if self.route(q).kind != "fact":
                view = f"routed_{abs(hash(text)) % 10**9}_{time.monotonic_ns()}"
                self.aggregate(q).createOrReplaceTempView(view)
                return self.spark.sql(finish(f"`{view}`"))
        dialect = Dialect(self.catalog, lambda name: estimated_bytes(self.table(name)) <= LIMIT_BYTES)
        rewritten = dialect.query(text)
        for name in {*self.catalog.tables, *self.catalog.cubes}:
            if re.search(rf"\b{re.escape(name)}\b", rewritten, re.IGNORECASE):
                self.table(name).createOrReplaceTempView(f"`{name}`")
        return self.spark.sql(rewritten)

    def explain(self, text: str) -> str:
        """The route if a cube may answer, and Spark's plan."""
        route = self.route_of(text)
        head = f"Route: {route.kind}" + (f" ({route.cube.physical_name}, {route.mid[0]} .. {route.mid[1]})" if route.cube else "")
        plan = self.query(text)._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return f"{head}\n{plan}"

    # -- definitions

    def _owned(self) -> Store:
        if self.store is None:
            raise UnsupportedOperation("this session has no store")
        return self.store

    def _publish(self) -> None:
        kept = Catalog()
        kept.tables = {k: t for k, t in self.catalog.tables.items() if k not in self._frames}
        kept.cubes = {k: c for k, c in self.catalog.cubes.items() if k not in self._cubes}
        self._base = self.store.publish(self._base, kept, self._folders, self._streams)

    def _create_table(self, s: ddl.CreateTable) -> None:
        self._owned()
        if s.if_not_exists and s.table.name.lower() in self.catalog.tables:
            return
        self.catalog.add(s.table)
        self._publish()

    def _create_cube(self, s: ddl.CreateCube) -> None:
        if s.if_not_exists and s.cube.name.lower() in self.catalog.cubes:
            return
        fact = self.catalog.table(s.cube.fact)
        if not s.cube.order and (fact.row_timestamp or "").lower() != s.cube.time.lower():
            raise EngineError("without ORDER BY the truncated column must be the table's ROW_TIMESTAMP")
        if s.cube.fact.lower() in self._frames:
            return self.register_cube(s.cube)
        self._owned()
        self.catalog.add_cube(s.cube)
        rows = self._folders.get(s.cube.fact.lower(), [])
        self._folders[s.cube.name.lower()] = [self.store.write(cubes.build(self.table(s.cube.fact), s.cube), s.cube.name)] if rows else []
        return self._publish()

    def _alter(self, s: ddl.AlterTable) -> None:
        self._owned()
        t = self.catalog.table(s.name)
        have = {c.name.lower() for c in t.columns}
        for c in s.add:
            if c.name.lower() in have:
                if s.lenient:
                    continue
                raise EngineError(f"table {t.name} has a column {c.name} already")
            t.columns.append(c)
        for name in s.drop:
            if name.lower() not in have:
                if s.lenient:
                    continue
                raise EngineError(f"table {t.name} has no column {name}")
            if name.lower() in {k.lower() for k in t.key}:
                raise EngineError(f"column {name} is in the primary key")
            for cube in self.catalog.cubes_of(t.name):
                if name.lower() in {x.lower() for x in [cube.time, *cube.dims, *(m.column or "" for m in cube.measures)]}:
                    raise EngineError(f"column {name} is used by {cube.name}")
            t.columns = [c for c in t.columns if c.name.lower() != name.lower()]
            for f in self._folders.get(t.name.lower(), []):  # a column added later under this name is another column
                f["columns"] = [c for c in f["columns"] if c.lower() != name.lower()]
        self._publish()

    # -- writing

    def _writable(self, name: str) -> Table:
        if name.lower() in self.catalog.cubes:
            raise UnsupportedOperation(f"{name} is a materialized view and can't be written")
        t = self.catalog.table(name)
        if not self.config.enable_inserts:
            raise UnsupportedOperation("inserts are not enabled")
        if name.lower() in self._frames:
            raise UnsupportedOperation(f"{name} is registered, not stored")
        return t

    def _insert(self, s: ddl.Insert, args: list | None) -> None:
        t = self._writable(s.name)
        columns = s.columns or [c.name for c in t.columns]
        if s.rows is None:
            self.append(s.name, self.query(s.query, args).toDF(*columns))
            return
        values = iter(args or [])
        for row in s.rows:
            if len(row) != len(columns):
                raise EngineError(f"{len(row)} values for {len(columns)} columns")
            try:
                given = {c.lower(): next(values) if isinstance(v, ddl.Bind) else v for c, v in zip(columns, row, strict=True)}
            except StopIteration:
                raise EngineError("there are fewer values than ?") from None
            self._buffer(t, given)

    def _buffer(self, t: Table, given: dict) -> None:
        unknown = set(given) - {c.name.lower() for c in t.columns}
        if unknown:
            raise EngineError(f"table {t.name} has no column {sorted(unknown)[0]}")
        row = []
        for c in t.columns:
            value = given.get(c.name.lower(), c.default)
            value = ddl.cast(Decimal(str(value)) if isinstance(value, str) and c.type.startswith("decimal") else value, c)
            if value is None and not c.nullable:
                raise EngineError(f"column {c.name} of {t.name} can't be null")
            row.append(value)
        self._rows.setdefault(t.name.lower(), []).append(tuple(row))

    def insert(self, name: str, **values) -> None:
        """Buffers one row."""
        self._buffer(self._writable(name), {k.lower(): v for k, v in values.items()})

    def append(self, name: str, df: DataFrame) -> None:
        """Buffers the rows of ``df``, whose columns are found by name."""
        t = self._writable(name)
        have = {c.lower() for c in df.columns}
        from .sources.store import default

        self._bulk.setdefault(t.name.lower(), []).append(df.select(*((F.col(f"`{c.name}`").cast(c.type) if c.name.lower() in have else default(c)).alias(c.name) for c in t.columns)))

    def rollback(self) -> None:
        self._rows, self._bulk = {}, {}

    def done(self, stream: str) -> int:
        """Number of the last batch of a stream that is published; -1: none."""
        return self._streams.get(stream, -1)

    def commit(self, stream: str | None = None, batch: int = -1) -> None:
        """Writes what is buffered and publishes facts and cubes together, and with them the number of a stream's batch.

        On an error nothing is published, what was written is deleted, and the buffer is empty.
        """
        rows, bulk = self._rows, self._bulk
        self.rollback()
        if not rows and not bulk and stream is None:
            return
        folders, made = {k: list(v) for k, v in self._folders.items()}, []

        def write(df: DataFrame, name: str, part: str | None = None) -> dict:
            made.append(self.store.write(df, name, part))
            return made[-1]

        before = self._folders, self._streams
        try:
            for low in sorted({*rows, *bulk}):
                t = self.catalog.tables[low]
                frames = list(bulk.get(low, []))
                if rows.get(low):
                    frames.append(self.spark.createDataFrame(rows[low], ", ".join(f"`{c.name}` {c.type}" for c in t.columns)))
                new = frames[0]
                for f in frames[1:]:
                    new = new.unionByName(f)
                entry = self._write_checked(t, new, write)
                stored = self.store.read(t, [entry])
                folders.setdefault(low, []).append(entry)
                if self.config.disable_cube_aggregation:
                    continue
                for cube in self.catalog.cubes_of(t.name):
                    key = cube.name.lower()
                    folders.setdefault(key, []).append(write(cubes.build(stored, cube), cube.name))
                    if len(folders[key]) > self.config.cube_parts:
                        parts = self.store.read_parts(self._cube_schema(cube), folders[key])
                        folders[key] = [write(cubes.merge(parts, cube), cube.name)]
            self._folders, self._streams = folders, self._streams | ({stream: batch} if stream else {})
            self._publish()
        except Exception:
            self._folders, self._streams = before
            self.store.delete(made)
            raise

    def near(self, t: Table, df: DataFrame) -> DataFrame:
        """Keys of the stored rows that lie in the days of ``df``: the only ones, where the row timestamp is in the key,
        that its keys can equal.  The reader opens no other day's files."""
        only = None
        if t.row_timestamp and t.row_timestamp.lower() in {k.lower() for k in t.key}:
            days = [r[0] for r in df.select(F.to_date(t.row_timestamp)).distinct().collect()]  # the days of one batch
            only = F.col(PART).isin(days) if days else F.lit(False)
        return self.store.read(t, self._folders.get(t.name.lower(), []), only).select(*t.key)

    def _write_checked(self, t: Table, new: DataFrame, write: Callable[..., dict]) -> dict:
        """Writes ``new`` clustered by the hash columns and the row timestamp's day and sorted by key, then checks keys
        and nulls on what was written.

        Older rows are compared within the days and the ranges of the new keys only, so that the reader skips the rest.
        """
        stamp, by = t.row_timestamp, list(t.hash_columns)
        if stamp:
            new = new.withColumn(PART, F.to_date(stamp))
            by.append(PART)
        if by:
            new = new.repartition(max(t.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions"))), *by)
        order = [F.col(PART), *key_order(t)] if stamp else key_order(t)
        entry = write(new.sortWithinPartitions(*order), t.name, PART if stamp else None)
        stored = self.store.read(t, [entry])
        needed = [c.name for c in t.columns if not c.nullable]
        nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"nulls_{i}") for i, c in enumerate(needed)]
        ends = [f(f"`{k}`").alias(f"{n}_{i}") for i, k in enumerate(t.key) for n, f in (("low", F.min), ("high", F.max))]
        seen = stored.agg(F.count("*").alias("rows"), *nulls, *ends).first()
        for i, c in enumerate(needed):
            if seen[f"nulls_{i}"]:
                raise EngineError(f"column {c} of {t.name} can't be null")
        twice = stored.groupBy(*t.key).count().filter("count > 1").select(*t.key).limit(1)
        old = self._folders.get(t.name.lower(), [])
        if old and seen["rows"]:
            near = self.near(t, stored)
            for i, k in enumerate(t.key):
                near = near.filter(F.col(k).between(_bound(seen[f"low_{i}"], t.column(k).type), _bound(seen[f"high_{i}"], t.column(k).type)))
            twice = twice.union(stored.select(*t.key).join(near, t.key, "left_semi").limit(1))
        if not twice.isEmpty():
            raise DuplicateKey(f"a row of {t.name} has the key of another")
        return entry


#: Partition column of stored facts: the day of the row timestamp.
PART = "_day"


def _bound(value, kind: str) -> SparkColumn:
    return F.lit(str(value) if kind.startswith(("timestamp", "decimal")) else value).cast(kind)
