"""Seeded scenario generator: a JSON scenario names a table, a number of rows and a generator for each column.

All values are expressions over the row number and a seed, so rows are the same
however many partitions make them, and a lost partition is made again as it was.
Groups of columns can be drawn together from a weighted list of value tuples.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError

Generator = Callable[[dict, Column], Column]
GENERATORS: dict[str, Generator] = {}


def generator(name: str) -> Callable[[Generator], Generator]:
    """Registers a generator: function of its settings and of a random 60-bit number."""

    def add(f: Generator) -> Generator:
        GENERATORS[name] = f
        return f

    return add


def _number(text: Column) -> Column:
    """A 60-bit number from the first 15 digits of the text's MD5, which any SQL engine can work out again."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _draw(seed: int, row: Column, what: str) -> Column:
    return _number(F.concat(F.lit(f"{seed}:{what}:"), row.cast("string")))


def _sid(prefix: str, of: Column) -> Column:
    return F.concat(F.lit(prefix), F.md5(of.cast("string")))


def _phone(of: Column) -> Column:
    return F.concat(F.lit("+1"), F.lpad(F.pmod(_number(of.cast("string")), F.lit(10**10)).cast("string"), 10, "0"))


@generator("ConstantValueGenerator")
def _constant(s: dict, r: Column) -> Column:
    return F.lit(s["columnValue"])


@generator("ValueListGenerator")
def _values(s: dict, r: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, s["values"])), (F.pmod(r, F.lit(len(s["values"]))) + 1).cast("int"))


@generator("UniformIntegerValueGenerator")
def _integer(s: dict, r: Column) -> Column:
    return _long(s, r).cast("int")


@generator("UniformLongValueGenerator")
def _long(s: dict, r: Column) -> Column:
    low, high = int(s.get("minValue", 0)), int(s["maxValue"])
    if high < low:
        raise EngineError("maxValue is below minValue")
    return F.lit(low) + F.pmod(r, F.lit(max(1, high - low)))


@generator("UniformBigDecimalValueGenerator")
def _decimal(s: dict, r: Column) -> Column:
    return (F.pmod(r, F.lit(int(float(s["maxValue"]) * 10**6))) / F.lit(10**6)).cast("decimal(22,6)")


@generator("TimestampGenerator")
def _timestamp(s: dict, r: Column) -> Column:
    """Milliseconds in the last numDaysBefore days before ``until`` (now, if not given)."""
    until = datetime.fromisoformat(s["until"]) if "until" in s else datetime.now(UTC).replace(tzinfo=None)
    end = int((until - datetime(1970, 1, 1)) / timedelta(milliseconds=1))
    return F.lit(end) - 1 - F.pmod(r, F.lit(int(s["numDaysBefore"]) * 86_400_000))


@generator("RandomSidGenerator")
def _random_sid(s: dict, r: Column) -> Column:
    return _sid(s["sidPrefix"], r)


@generator("SidListGenerator")
def _sid_list(s: dict, r: Column) -> Column:
    return _sid(s.get("sidPrefix", "XX"), F.pmod(r, F.lit(int(s["numValues"]))))


@generator("PhoneNumberListGenerator")
def _phone_list(s: dict, r: Column) -> Column:
    return _phone(F.pmod(r, F.lit(int(s["numValues"]))))


@generator("EnvironmentVariableGenerator")
def _environment(s: dict, r: Column) -> Column:
    value = os.environ.get(s["variableName"], s.get("defaultValue"))
    kind = s.get("valueType", "String").rpartition(".")[2]
    if kind not in ("String", "Integer"):
        raise EngineError(f"an environment variable gives String or Integer, not {kind}")
    return F.lit(int(value) if kind == "Integer" and value is not None else value)


def _place(ends: list[int], pick: Column) -> Column:
    """How many of ``ends`` are not above ``pick``."""
    return F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= pick))


def generate(spark: SparkSession, scenario: dict | str | Path, seed: int = 0, rows: int | None = None) -> DataFrame:
    """A DataFrame of the scenario's rows, one column per generator.

    ``multipleColumnValueGenerators`` may hold {"type": "CubeGenerator", "groupedColumns": [...], "counts": [...],
    "numUniqueGroups": n}: n value tuples, drawn in proportion to the counts (used again in turn if there are fewer).
    """
    if not isinstance(scenario, dict):
        scenario = json.loads(Path(scenario).read_text())
    columns = scenario["columnNameToValueGenerator"]
    n = int(rows if rows is not None else scenario["numRows"])
    df = spark.range(n).withColumnRenamed("id", "_row")
    grouped: dict[str, Column] = {}
    for i, g in enumerate(scenario.get("multipleColumnValueGenerators", [])):
        if g["type"] != "CubeGenerator":
            raise EngineError(f"there is no generator {g['type']}")
        counts = [int(g["counts"][k % len(g["counts"])]) for k in range(int(g["numUniqueGroups"]))]
        ends = [sum(counts[: k + 1]) for k in range(len(counts))]
        pick = F.pmod(_draw(seed, F.col("_row"), f"group{i}"), F.lit(ends[-1]))
        df = df.withColumn(f"_group{i}", _place(ends, pick))
        grouped |= dict.fromkeys(g["groupedColumns"], F.col(f"_group{i}"))
    out = []
    for name, s in columns.items():
        if s["type"] not in GENERATORS:
            raise EngineError(f"there is no generator {s['type']}")
        out.append(GENERATORS[s["type"]](s, _draw(seed, grouped.get(name, F.col("_row")), name)).alias(name))
    return df.select(*out)
