from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystone.errors import EngineError, UnsupportedOperation
from tallystone.functions import aligned_range, ceil_time, floor_time, seek_after, step, trunc_cmp
from tallystone.functions.truncation import bounds

OPS = {">=": lambda a, b: a >= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b, "<>": lambda a, b: a != b}
TIMES = st.datetimes(datetime(1999, 12, 1), datetime(2001, 3, 1))
UNITS = ["SECOND", "MINUTE", "HOUR", "DAY", "MONTH", "QUARTER", "YEAR"]


def holds(alternatives, value):
    return any(all(OPS[o](value, v) for o, v in both) for both in alternatives)


@settings(max_examples=400, deadline=None)
@given(TIMES, TIMES, st.sampled_from(UNITS), st.sampled_from(list(OPS)), st.booleans())
def test_time_ranges_equal_truncation(t, literal, unit, op, aligned):
    literal = floor_time(literal, unit) if aligned else literal
    for t in (t, floor_time(t, unit), literal, literal + timedelta(microseconds=1), step(floor_time(literal, unit), unit), step(floor_time(literal, unit), unit, -1)):
        assert holds(bounds("floor", unit, op, literal), t) == OPS[op](floor_time(t, unit), literal)
        assert holds(bounds("ceil", unit, op, literal), t) == OPS[op](ceil_time(t, unit), literal)


@settings(max_examples=300, deadline=None)
@given(st.integers(-50, 50), st.integers(-50, 50), st.sampled_from(list(OPS)))
def test_number_ranges_equal_floor_and_ceil(c, literal, op):
    from math import ceil, floor

    assert holds(bounds("floor", None, op, literal / 4), c / 4) == OPS[op](floor(c / 4), literal / 4)
    assert holds(bounds("ceil", None, op, literal / 4), c / 4) == OPS[op](ceil(c / 4), literal / 4)


def test_unit_steps():
    assert step(datetime(2024, 11, 1), "QUARTER") == datetime(2025, 2, 1)
    assert step(datetime(2024, 1, 1), "MONTH", -1) == datetime(2023, 12, 1)
    assert aligned_range(datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 3), "DAY") == (datetime(2024, 1, 2), datetime(2024, 1, 3))
    with pytest.raises(UnsupportedOperation):
        floor_time(datetime(2024, 1, 1), "CENTURY")


def test_null_stays_null(spark):
    df = spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS ts, CAST(NULL AS double) AS x")
    for op in OPS:
        for kind in ("floor", "ceil"):
            a = trunc_cmp("ts", "DAY", op, datetime(2024, 1, 1, 5), kind)
            b = trunc_cmp("x", None, op, 1.5, kind)
            assert df.select(a.alias("a"), b.alias("b")).first() == (None, None)


def test_ranges_reach_the_reader(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(trunc_cmp("ts", "DAY", ">=", datetime(2024, 1, 20, 5)))
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(ts" in plan


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=20, unique=True), st.lists(st.booleans(), min_size=3, max_size=3), st.tuples(*[st.integers(0, 3)] * 3))
def test_seek_is_a_cut_of_the_sorted_table(spark, rows, down, last):
    key = lambda r: tuple(-v if d else v for v, d in zip(r, down, strict=True))
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = [tuple(r) for r in df.filter(seek_after(["a", "b", "c"], list(last), down)).collect()]
    assert sorted(got) == sorted(r for r in rows if key(r) > key(last))


def test_seek_is_pushed_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(seek_after(["user_id", "event_id"], [5, 7]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(user_id,5)" in plan
    with pytest.raises(EngineError):
        seek_after(["a"], [1, 2])


def test_builder_matches_date_trunc(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for unit in ("MINUTE", "HOUR", "DAY", "MONTH"):
        for literal in (datetime(2024, 1, 9), datetime(2024, 1, 9, 13, 20, 5)):
            for op in OPS:
                plain = F.expr(f"CAST(date_trunc('{unit}', ts) AS timestamp_ntz) {op} TIMESTAMP_NTZ '{literal}'")
                assert df.filter(trunc_cmp("ts", unit, op, literal)).count() == df.filter(plain).count()
