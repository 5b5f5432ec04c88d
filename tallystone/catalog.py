"""Tables, keys, rollup cubes and their metadata.

Spark enforces none of this; the engine uses it for paging order, row-value
comparison, defaults, key checks and routing.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from .errors import EngineError

#: The column types that a table may have, by their DDL names.
TYPES = {
    "TINYINT": "tinyint", "SMALLINT": "smallint", "INT": "int", "INTEGER": "int", "BIGINT": "bigint",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "DOUBLE": "double", "DECIMAL": "decimal",
    "VARCHAR": "string", "STRING": "string", "VARBINARY": "binary", "BINARY": "binary",
}
#: Types whose key columns may be stored descending.
INVERTIBLE = {"tinyint", "smallint", "int", "bigint", "timestamp_ntz"}
#: Time units of cubes, finest first; a unit nests in each later one (weeks nest in none of them and are left out).
UNITS = ("SECOND", "MINUTE", "HOUR", "DAY", "MONTH", "QUARTER", "YEAR")
#: Row estimates by kind of table, by which a query chooses between a fact and its cubes.
ESTIMATES = {"FACT": 10**12, "CUBE": 10**9, "DIMENSION": 10**3, "SYSTEM": 10**3}


@dataclass
class Column:
    name: str
    type: str
    nullable: bool = True
    desc: bool = False
    row_timestamp: bool = False
    default: object = None
    comment: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.desc and self.type not in INVERTIBLE:
            raise EngineError(f"column {self.name}: a {self.type} column can't be descending")
        if self.row_timestamp and self.type != "timestamp_ntz":
            raise EngineError(f"column {self.name}: only a TIMESTAMP can be the row timestamp")

    def struct_field(self) -> T.StructField:
        meta = {"descending": self.desc, "row_timestamp": self.row_timestamp, "comment": self.comment or ""}
        return T.StructField(self.name, T._parse_datatype_string(self.type), self.nullable, meta)


@dataclass
class Table:
    name: str
    columns: list[Column]
    key: list[str]
    hash_columns: list[str] = field(default_factory=list)
    buckets: int = 1
    replicas: int | None = None
    properties: dict[str, str] = field(default_factory=dict)
    declared_kind: str | None = None

    def __post_init__(self):
        names = [c.name.lower() for c in self.columns]
        if len(set(names)) != len(names):
            raise EngineError(f"table {self.name}: a column is named twice")
        for k in [*self.key, *self.hash_columns]:
            self.column(k)
        for k in self.key:
            self.column(k).nullable = False
        if sum(c.row_timestamp for c in self.columns) > 1:
            raise EngineError(f"table {self.name}: more than one ROW_TIMESTAMP column")
        for h in self.hash_columns:
            if h.lower() not in {k.lower() for k in self.key}:
                raise EngineError(f"table {self.name}: hash column {h} is not in the primary key")

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise EngineError(f"table {self.name} has no column {name}")

    @property
    def row_timestamp(self) -> str | None:
        return next((c.name for c in self.columns if c.row_timestamp), None)

    @property
    def kind(self) -> str:
        if self.declared_kind:
            return self.declared_kind
        if self.row_timestamp:
            return "FACT"
        return "SYSTEM" if self.name.startswith("System") else "DIMENSION"

    def descending(self, name: str) -> bool:
        return self.column(name).desc

    def schema(self) -> T.StructType:
        return T.StructType([c.struct_field() for c in self.columns])


@dataclass
class Measure:
    """An aggregate that a cube stores: SUM, MIN, MAX, ANY_VALUE of a column, or COUNT of a column or (None) of rows."""

    func: str
    column: str | None = None
    name: str | None = None

    def __post_init__(self):
        self.func = self.func.upper()
        if self.func not in ("SUM", "COUNT", "MIN", "MAX", "ANY_VALUE"):
            raise EngineError(f"a cube can't store {self.func}")
        if self.column is None and self.func != "COUNT":
            raise EngineError(f"{self.func} needs a column")
        self.name = self.name or f"{self.func}_{self.column or 'records'}".lower()

    def same(self, func: str, column: str | None) -> bool:
        return self.func == func and (self.column or "").lower() == (column or "").lower()


@dataclass
class Cube:
    """A rollup of ``fact``: dims and ``time`` truncated to ``unit``, and measures."""

    name: str
    fact: str
    time: str
    unit: str
    dims: list[str]
    measures: list[Measure]
    order: list[tuple[str, bool]] = field(default_factory=list)

    def __post_init__(self):
        self.unit = self.unit.upper()
        if self.unit not in UNITS or self.unit == "QUARTER":
            raise EngineError(f"cube {self.name}: unit {self.unit} is not supported")
        if "." in self.name:
            raise EngineError("the name of a materialized view can't hold a '.'")

    @property
    def physical_name(self) -> str:
        return f"{self.fact}-{self.name}-{self.unit.capitalize()}-Aggregation"

    def measure(self, func: str, column: str | None) -> Measure | None:
        return next((m for m in self.measures if m.same(func, column)), None)


def nests(fine: str, coarse: str) -> bool:
    """Whether each ``coarse`` interval is a whole number of ``fine`` ones."""
    return UNITS.index(fine.upper()) <= UNITS.index(coarse.upper())


def spark_type(name: str, precision: int | None = None, scale: int | None = None) -> str:
    kind = TYPES.get(name.upper())
    if kind is None:
        raise EngineError(f"type {name} is not supported")
    if kind == "decimal":
        if precision is None or scale is None:
            raise EngineError("DECIMAL needs a precision and a scale")
        return f"decimal({precision},{scale})"
    return kind


class Catalog:
    """Tables and cubes by name, case ignored; can be stored as JSON."""

    def __init__(self):
        self.tables: dict[str, Table] = {}
        self.cubes: dict[str, Cube] = {}

    def table(self, name: str) -> Table:
        found = self.tables.get(name.lower())
        if found is None:
            raise EngineError(f"there is no table {name}")
        return found

    def add(self, table: Table) -> None:
        if table.name.lower() in self.tables or table.name.lower() in self.cubes:
            raise EngineError(f"{table.name} exists already")
        self.tables[table.name.lower()] = table

    def add_cube(self, cube: Cube) -> None:
        if cube.name.lower() in self.tables or cube.name.lower() in self.cubes:
            raise EngineError(f"{cube.name} exists already")
        fact = self.table(cube.fact)
        if fact.column(cube.time).type != "timestamp_ntz":
            raise EngineError(f"cube {cube.name}: {cube.time} is not a TIMESTAMP")
        for d in [*cube.dims, *(m.column for m in cube.measures if m.column)]:
            fact.column(d)
        self.cubes[cube.name.lower()] = cube

    def cubes_of(self, fact: str) -> list[Cube]:
        return [c for c in self.cubes.values() if c.fact.lower() == fact.lower()]

    def listing(self) -> list[tuple[str, str, int]]:
        """(name, kind, estimated rows) of everything that can be queried."""
        out = [(t.name, t.kind, ESTIMATES[t.kind]) for t in self.tables.values()]
        return sorted(out + [(c.name, "CUBE", ESTIMATES["CUBE"]) for c in self.cubes.values()])

    def dumps(self) -> str:
        return json.dumps({"tables": [asdict(t) for t in self.tables.values()], "cubes": [asdict(c) for c in self.cubes.values()]}, default=str)

    @staticmethod
    def loads(text: str) -> Catalog:
        out, raw = Catalog(), json.loads(text)
        for t in raw["tables"]:
            out.add(Table(**t | {"columns": [Column(**c) for c in t["columns"]]}))
        for c in raw["cubes"]:
            out.add_cube(Cube(**c | {"measures": [Measure(**m) for m in c["measures"]], "order": [tuple(o) for o in c["order"]]}))
        return out


_PHYSICAL = re.compile(r"(.+)-(.+)-(Second|Minute|Hour|Day|Month|Year)-Aggregation")


def kind_of(name: str, facts: set[str] = frozenset()) -> str:
    """Kind that a stored name alone tells."""
    if name in facts:
        return "FACT"
    if _PHYSICAL.fullmatch(name):
        return "CUBE"
    return "SYSTEM" if name.startswith("System") else "DIMENSION"
