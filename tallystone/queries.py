"""Queries that exercise each operator on the star-schema tables, and their SQL for DuckDB.

A query is written with the engine (its dialect, scans, cubes or paging); its
oracle is plain SQL on the raw tables.  Cube queries have oracles on the fact.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Column, Cube, Measure
from .errors import EngineError
from .functions import seek_after, trunc_cmp
from .operators import batched_join, sum0
from .plans.cubes import Agg, AggQuery, Dimension
from .session import EngineConfig, Session
from .sources.datagen import generate
from .tables import open_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def session(spark: SparkSession, folder: str, *names: str, **config) -> Session:
    out = Session(spark, config=EngineConfig(**config))
    for n in names:
        open_table(out, folder, n)
    return out


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles: the two engines give sums of decimals different precisions."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("double") for f in df.schema.fields if f.dataType.typeName() == "decimal"})


def exact(df: DataFrame) -> DataFrame:
    """Decimals as text, with all their digits: what a cube gives must be what the fact gives."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if f.dataType.typeName() == "decimal"})


def query(name: str, oracle: str | None = None, show: Callable[[DataFrame], DataFrame] = plain):
    def add(f):
        QUERIES[name] = lambda spark, folder: show(f(spark, folder))
        if oracle:
            ORACLES[name] = " ".join(oracle.split())
        return f

    return add


def sql(name: str, tables: str, statement: str, oracle: str | None = None) -> None:
    """A query in the engine's dialect; without an oracle the statement is DuckDB's as well."""
    query(name, oracle or statement)(lambda spark, folder: session(spark, folder, *tables.split()).query(statement))


# ------------------------------------------------ scans, projection, filters

sql("scan_project", "orders", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
sql("scan_star", "nation", "SELECT * FROM nation")
sql("filter_eq_range", "events", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value >= 10 AND value < 60")
sql("filter_in", "orders", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P')")
sql("filter_in_hint", "events", "SELECT /*+ DISABLE_IN_LIST_OPTIMIZATION */ event_id FROM events WHERE user_id IN (3, 5, 8) ORDER BY user_id, ts DESC, event_id", "SELECT event_id FROM events WHERE user_id IN (3, 5, 8)")
sql("filter_not_in", "events", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
sql("filter_between", "orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
sql("filter_or_overlap", "events", "SELECT event_id, value FROM events WHERE value < 50 OR value < 80 OR event_type = 'error'")
sql("filter_like", "part", "SELECT p_partkey, p_name FROM part WHERE p_type LIKE '%M_T%' OR p_name LIKE 'small%'", "SELECT p_partkey, p_name FROM part WHERE p_type LIKE '%M_T%' OR p_name LIKE 'small%'")
sql("filter_similar", "part", "SELECT p_partkey, p_name FROM part WHERE p_name SIMILAR TO '(red|small) _i%' AND p_brand NOT SIMILAR TO 'Brand#[1-4]'", "SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '(red|small) .i.*') AND NOT regexp_full_match(p_brand, 'Brand#[1-4]')")
sql("filter_not_equal", "events", "SELECT event_id FROM events WHERE event_type <> 'click'")
sql("filter_is_null", "customer orders", "SELECT c_custkey, count(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 WHERE o_orderkey IS NULL GROUP BY c_custkey")
sql("filter_is_not_null", "customer orders", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 WHERE o_orderkey IS NOT NULL")
sql("filter_equals_null", "events", "SELECT event_id FROM events WHERE user_id = NULL")
sql("filter_boolean", "orders", "SELECT o_orderkey FROM (SELECT o_orderkey, o_totalprice > 30000 AS big FROM orders) t WHERE NOT big")
sql("filter_case", "orders", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'high' WHEN o_totalprice > 10000 THEN 'mid' ELSE 'low' END AS band, coalesce(nullif(o_orderstatus, 'O'), 'open') AS status FROM orders")
sql("filter_cast_in", "events", "SELECT event_id FROM events WHERE CAST(user_id AS VARCHAR) IN ('3', '5') AND CAST(event_id AS VARCHAR) LIKE '%7'")
sql("filter_decimal_long", "events", "SELECT event_id FROM events WHERE CAST(value AS DECIMAL(22, 6)) >= 60 AND CAST(value AS DECIMAL(22, 6)) < 4000000000")
sql("const_project", "events", "SELECT event_type, event_id, 4 AS four FROM events")
sql("concat_project", "customer", "SELECT c_custkey, c_name || '-' || c_mktsegment AS label FROM customer")
sql("cast_project", "events", "SELECT event_id, CAST(user_id AS INT) AS user_int, CAST(event_id AS VARCHAR) AS event_text FROM events")
sql("string_functions", "customer", "SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low, trim('  ' || c_name || ' ') AS trimmed, substring(c_name, 2, 3) AS part, length(c_name) AS n, replace(c_name, 'C', 'x') AS swapped, position('u' IN c_name) AS place FROM customer", "SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low, trim('  ' || c_name || ' ') AS trimmed, substring(c_name, 2, 3) AS part, length(c_name)::INT AS n, replace(c_name, 'C', 'x') AS swapped, position('u' IN c_name)::INT AS place FROM customer")
sql("math_functions", "part", "SELECT p_partkey, abs(-p_size) AS a, mod(p_size, 7) AS m, sign(p_retailprice) AS s, floor(p_retailprice) AS f, ceil(p_retailprice) AS c, CAST(CAST(round(sqrt(p_retailprice), 6) AS DECIMAL(18, 6)) AS DOUBLE) AS root FROM part", "SELECT p_partkey, abs(-p_size) AS a, mod(p_size, 7) AS m, sign(p_retailprice)::DOUBLE AS s, floor(p_retailprice)::BIGINT AS f, ceil(p_retailprice)::BIGINT AS c, CAST(CAST(round(sqrt(p_retailprice), 6) AS DECIMAL(18, 6)) AS DOUBLE) AS root FROM part")
sql("time_functions", "events", "SELECT event_id, extract(YEAR FROM ts) AS y, extract(MONTH FROM ts) AS mo, extract(DAY FROM ts) AS d, extract(HOUR FROM ts) AS h, timestampadd(HOUR, 5, ts) AS later, timestampdiff(HOUR, TIMESTAMP '2024-01-01 00:00:00', ts) AS hours FROM events", "SELECT event_id, extract(YEAR FROM ts)::INT AS y, extract(MONTH FROM ts)::INT AS mo, extract(DAY FROM ts)::INT AS d, extract(HOUR FROM ts)::INT AS h, ts + INTERVAL 5 HOUR AS later, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 3600000000 AS hours FROM events")
sql("floor_ceil_project", "events", "SELECT event_id, FLOOR(ts TO HOUR) AS f, CEIL(ts TO DAY) AS c FROM events", "SELECT event_id, date_trunc('hour', ts) AS f, CASE WHEN date_trunc('day', ts) = ts THEN ts ELSE date_trunc('day', ts) + INTERVAL 1 DAY END AS c FROM events")
sql("more_string_functions", "part", "SELECT p_partkey, overlay(p_brand PLACING 'Make' FROM 1 FOR 5) AS made, initcap(p_name) AS title, char_length(p_name) AS n, lpad(p_name, 12, '.') AS wide FROM part", "SELECT p_partkey, 'Make' || substring(p_brand, 6) AS made, array_to_string([upper(w[1:1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' ') AS title, length(p_name)::INT AS n, CASE WHEN length(p_name) >= 12 THEN substring(p_name, 1, 12) ELSE lpad(p_name, 12, '.') END AS wide FROM part")
_ROUND = "CAST(CAST({} AS DECIMAL(24, 6)) AS DOUBLE) AS {}"
_MATHS = [("power(p_size, 2)", "sq"), ("ln(p_retailprice)", "nat"), ("exp(p_size / 10.0)", "up"), ("sin(p_size)", "s"), ("atan2(p_size, 3)", "angle")]
sql("more_math_functions", "part", f"SELECT p_partkey, TRUNCATE(p_retailprice - 1000, 1) AS cut, {', '.join(_ROUND.format(f'round({e}, 6)', n) for e, n in _MATHS)} FROM part", f"SELECT p_partkey, trunc((p_retailprice - 1000) * power(10, 1)) / power(10, 1) AS cut, {', '.join(_ROUND.format(f'round({e}, 6)', n) for e, n in _MATHS)} FROM part")


@query("bind_parameters", "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = 1 AND n_name <> 'NATION_1'")
def _(spark, folder):
    return session(spark, folder, "nation").query("SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = ? AND n_name <> ?", [1, "NATION_1"])


sql("json_extract", "events", "SELECT event_id, get_json_object(props, '$.k') AS k FROM events", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")


@query("scan_programmatic", "SELECT event_id, user_id, value FROM events WHERE (event_type = 'click' AND value > 20) OR (user_id < 10)")
def _(spark, folder):
    s = session(spark, folder, "events")
    return s.scan("events", [[F.col("event_type") == "click", F.col("value") > 20], [F.col("user_id") < 10]], ["event_id", "user_id", "value"])


@query("scan_no_match", "SELECT event_id FROM events WHERE false")
def _(spark, folder):
    return session(spark, folder, "events").scan("events", [], ["event_id"])


@query("values_rows", "SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) t(id, name)")
def _(spark, folder):
    return session(spark, folder).query("SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) t(id, name)")


# -------------------------------------------- truncated comparisons as ranges

_STEPS = {"MINUTE": ("2024-01-02 00:35:00", "2024-01-11 07:31:22"), "HOUR": ("2024-01-09 13:00:00", "2024-01-09 13:20:00"), "DAY": ("2024-01-12 00:00:00", "2024-01-12 05:00:00"), "MONTH": ("1997-05-01 00:00:00", "1997-05-03 00:00:00"), "YEAR": ("1998-01-01 00:00:00", "1998-03-01 12:00:00")}
_NAMES = {">=": "ge", ">": "gt", "<=": "le", "<": "lt", "=": "eq", "<>": "ne"}
for _unit, _both in _STEPS.items():
    _table, _key, _ts = ("orders", "o_orderkey", "o_orderdate") if _unit in ("MONTH", "YEAR") else ("events", "event_id", "ts")
    for _op, _word in _NAMES.items():
        _low = f"date_trunc('{_unit.lower()}', {_ts})"
        _up = f"(CASE WHEN {_low} = {_ts} THEN {_ts} ELSE {_low} + INTERVAL 1 {_unit} END)"
        # aligned and not, in one query: a column tells which held
        for _kind, _plain in (("floor", _low), ("ceil", _up)):
            sql(
                f"filter_{_kind}_{_unit.lower()}_{_word}", _table,
                " UNION ALL ".join(f"SELECT {_key}, {i} AS literal FROM {_table} WHERE {_kind.upper()}({_ts} TO {_unit}) {_op} TIMESTAMP '{v}'" for i, v in enumerate(_both)),
                " UNION ALL ".join(f"SELECT {_key}, {i} AS literal FROM {_table} WHERE {_plain} {_op} TIMESTAMP '{v}'" for i, v in enumerate(_both)),
            )
for _kind in ("floor", "ceil"):
    _each = [(op, v) for op in _NAMES for v in ("50", "50.5")]
    sql(
        f"filter_{_kind}_number", "events",
        " UNION ALL ".join(f"SELECT event_id, {i} AS test FROM events WHERE {_kind.upper()}(value) {op} {v}" for i, (op, v) in enumerate(_each)),
        " UNION ALL ".join(f"SELECT event_id, {i} AS test FROM events WHERE {_kind}(value) {op} {v}" for i, (op, v) in enumerate(_each)),
    )


@query("filter_floor_builder", "SELECT event_id FROM events WHERE date_trunc('day', ts) >= TIMESTAMP '2024-01-20 06:00:00'")
def _(spark, folder):
    return session(spark, folder, "events").scan("events", trunc_cmp("ts", "DAY", ">=", datetime(2024, 1, 20, 6)), ["event_id"])


# ------------------------------------------------------- keys, paging, sorts

sql("rowvalue_asc", "customer orders", "SELECT c_custkey, c_nationkey FROM customer WHERE (c_nationkey, c_custkey) > (7, 300)")
sql("rowvalue_desc_key", "events", "SELECT event_id, user_id FROM events WHERE (user_id, ts, event_id) > (40, TIMESTAMP '2024-01-15 00:00:00', 500)", "SELECT event_id, user_id FROM events WHERE user_id > 40 OR (user_id = 40 AND ts < TIMESTAMP '2024-01-15') OR (user_id = 40 AND ts = TIMESTAMP '2024-01-15' AND event_id > 500)")
sql("limit_offset_pk", "orders", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 35")
sql("offset_without_order", "events", "SELECT event_id, user_id FROM events LIMIT 25 OFFSET 40", "SELECT event_id, user_id FROM events ORDER BY user_id, ts DESC, event_id LIMIT 25 OFFSET 40")
sql("offset_filtered", "events", "SELECT event_id FROM events WHERE user_id = 12 OFFSET 3", "SELECT event_id FROM events WHERE user_id = 12 ORDER BY user_id, ts DESC, event_id OFFSET 3")
sql("fetch_next", "orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 5 ROWS FETCH NEXT 10 ROWS ONLY", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
sql("topn_desc", "events", "SELECT event_id, ts, value FROM events ORDER BY value DESC, event_id LIMIT 15")
sql("sort_nulls_high", "customer orders", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey ORDER BY o_orderkey DESC, c_custkey LIMIT 30", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey ORDER BY o_orderkey DESC NULLS FIRST, c_custkey LIMIT 30")


@query("page_first", "SELECT event_id, user_id FROM events ORDER BY user_id, ts DESC, event_id LIMIT 50")
def _(spark, folder):
    return session(spark, folder, "events").pages("events", 50).page().select("event_id", "user_id")


@query("page_next", "SELECT event_id, user_id FROM events ORDER BY user_id, ts DESC, event_id LIMIT 50 OFFSET 100")
def _(spark, folder):
    pages = session(spark, folder, "events").pages("events", 50)
    each = iter(pages)
    next(each), next(each)
    return pages.page().select("event_id", "user_id")


@query("page_seek_multi_account", "SELECT event_id, user_id FROM events WHERE user_id IN (7, 9) AND (user_id > 7 OR (user_id = 7 AND ts < TIMESTAMP '2024-01-14 00:00:00')) ORDER BY user_id, ts DESC, event_id LIMIT 40")
def _(spark, folder):
    s = session(spark, folder, "events")
    after = seek_after(["user_id", "ts"], [7, datetime(2024, 1, 14)], [False, True])
    return s.scan("events", F.col("user_id").isin(7, 9) & after, ["event_id", "user_id"], limit=40, ordered=True)


@query("scan_sorted", "SELECT event_id, user_id FROM events WHERE user_id = 21 ORDER BY user_id, ts DESC, event_id LIMIT 10 OFFSET 4")
def _(spark, folder):
    return session(spark, folder, "events").scan("events", F.col("user_id") == 21, ["event_id", "user_id"], limit=10, offset=4)


# --------------------------------------------------------------- aggregation

_MONEY = "CAST(value AS DECIMAL(22, 6))"
sql("count_star", "events", "SELECT count(*) AS n, count(value) AS n_value FROM events")
sql("sum_group", "events", f"SELECT event_type, CAST(sum({_MONEY}) AS DOUBLE) AS total FROM events GROUP BY event_type")
sql("min_max_group", "events", "SELECT user_id, min(value) AS low, max(value) AS high, min(ts) AS first_ts FROM events GROUP BY user_id")
sql("avg_stddev", "orders", "SELECT o_orderstatus, CAST(CAST(avg(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(18, 4)) AS DOUBLE) AS mean, CAST(CAST(stddev_samp(o_totalprice) AS DECIMAL(18, 3)) AS DOUBLE) AS sd FROM orders GROUP BY o_orderstatus", "SELECT o_orderstatus, CAST(CAST(round(sum(CAST(o_totalprice AS DECIMAL(18, 2))) / count(*), 4) AS DECIMAL(18, 4)) AS DOUBLE) AS mean, CAST(CAST(stddev_samp(o_totalprice) AS DECIMAL(18, 3)) AS DOUBLE) AS sd FROM orders GROUP BY o_orderstatus")
sql("count_distinct", "events", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
sql("approx_distinct", "events", "SELECT event_type, abs(approx_count_distinct(user_id) - count(DISTINCT user_id)) <= 0.2 * count(DISTINCT user_id) AS near FROM events GROUP BY event_type", "SELECT DISTINCT event_type, true AS near FROM events")
sql("having", "events", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 70")
sql("group_expr", "events", "SELECT 6 - extract(DAY FROM ts) AS d, count(*) AS n FROM events GROUP BY 6 - extract(DAY FROM ts)", "SELECT (6 - extract(DAY FROM ts))::INT AS d, count(*) AS n FROM events GROUP BY 1")
sql("sum_of_nothing", "events", "SELECT sum(event_id) AS s, $SUM0(event_id) AS s0, count(*) AS n FROM events WHERE user_id < 0", "SELECT sum(event_id)::BIGINT AS s, coalesce(sum(event_id), 0)::BIGINT AS s0, count(*) AS n FROM events WHERE user_id < 0")
sql("any_value", "nation", "SELECT n_regionkey, any_value(n_regionkey + 1) AS one FROM nation GROUP BY n_regionkey")
sql("agg_sorted_limit", "orders", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate ORDER BY o_custkey, o_orderdate DESC LIMIT 12")
sql("agg_sorted_offset", "orders", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate ORDER BY o_custkey, o_orderdate DESC LIMIT 12 OFFSET 30")
sql("agg_pinned_prefix", "events", "SELECT ts, count(*) AS n FROM events WHERE user_id = 17 GROUP BY ts ORDER BY ts DESC LIMIT 9")
sql("agg_pk_prefix_then_measure", "orders", "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus ORDER BY o_custkey, n DESC, o_orderstatus LIMIT 20")
sql("agg_sort_by_count", "events", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
sql("rollup_grouping", "orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
sql("cube_grouping", "orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
sql("grouping_sets", "orders", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
sql("agg_star_flow", "lineitem", "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem WHERE FLOOR(l_shipdate TO YEAR) <= TIMESTAMP '1998-01-01 00:00:00' GROUP BY l_returnflag, l_linestatus", "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem WHERE date_trunc('year', l_shipdate) <= TIMESTAMP '1998-01-01' GROUP BY l_returnflag, l_linestatus")


@query("sum0_builder", "SELECT event_type, coalesce(sum(event_id), 0)::BIGINT AS s FROM events WHERE value > 100 GROUP BY event_type")
def _(spark, folder):
    return session(spark, folder, "events").scan("events", F.col("value") > 100).groupBy("event_type").agg(sum0("event_id").alias("s"))


# --------------------------------------------------------------------- joins

sql("join_inner", "orders customer", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
sql("join_left", "customer orders", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 200000")
sql("join_right", "customer orders", "SELECT c_name, o_orderkey FROM customer RIGHT JOIN orders ON c_custkey = o_custkey AND c_acctbal > 0")
sql("join_full", "customer supplier", "SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = s_suppkey AND c_nationkey = s_nationkey")
sql("join_semi", "customer orders", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
sql("join_anti", "customer orders", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
sql("join_theta_range", "nation region", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey > r_regionkey AND n_nationkey < 12")
sql("join_nested_hint", "customer orders", "SELECT /*+ USE_BATCH_NESTED_JOIN */ c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_custkey < 50", "SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_custkey < 50")
sql("join_sort_limit", "orders customer", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY o_custkey, o_orderdate DESC, o_orderkey LIMIT 25")
sql("join_star", "lineitem supplier nation region", "SELECT r_name, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name")
sql("subquery_in", "customer orders", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
sql("subquery_exists", "part lineitem", "SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
sql("subquery_scalar", "orders", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM orders)")


@query("join_batched_builder", "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_nationkey = 3")
def _(spark, folder):
    s = session(spark, folder, "customer", "orders")
    left = s.scan("customer", F.col("c_nationkey") == 3)
    return batched_join(left, s.table("orders"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


# ----------------------------------------------------------- windows and sets

sql("window_rank", "events", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn, rank() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rk, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS dr, ntile(4) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS quarter FROM events", "SELECT event_id, (row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id))::INT AS rn, (rank() OVER (PARTITION BY event_type ORDER BY value, event_id))::INT AS rk, (dense_rank() OVER (PARTITION BY user_id ORDER BY event_type))::INT AS dr, (ntile(4) OVER (PARTITION BY user_id ORDER BY ts, event_id))::INT AS quarter FROM events")
sql("window_frame", "events", f"SELECT event_id, CAST(sum({_MONEY}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DOUBLE) AS running, lag(event_id, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, lead(event_id, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events")
sql("window_values", "orders", "SELECT o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS f, last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l, nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM orders")
sql("window_distribution", "orders", "SELECT o_orderkey, CAST(CAST(percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS DECIMAL(18, 9)) AS DOUBLE) AS pr, CAST(CAST(cume_dist() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS DECIMAL(18, 9)) AS DOUBLE) AS cd FROM orders")
sql("window_range", "orders", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_custkey RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near FROM orders")
sql("union_all", "customer supplier", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
sql("union_distinct", "customer supplier", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
sql("intersect", "customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
sql("intersect_all", "customer supplier", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
sql("except", "part supplier", "SELECT p_size AS k FROM part EXCEPT SELECT s_nationkey FROM supplier")
sql("except_all", "customer supplier", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")


# --------------------------------------------------------------------- cubes


def cubes(spark: SparkSession, folder: str, **config) -> Session:
    """events with money as a decimal, and rollups by hour, day (two) and month."""
    s = Session(spark, config=EngineConfig(**config))
    t = open_table(s, folder, "events")
    frame = s.table("events").withColumns({"amount": F.col("value").cast("decimal(22,6)"), "label": F.upper("event_type")})
    t.columns += [Column("amount", "decimal(22,6)"), Column("label", "string")]
    s._frames["events"] = frame
    open_table(s, folder, "customer")
    measures = [Measure("SUM", "amount", "total"), Measure("COUNT", None, "n"), Measure("MIN", "amount", "low"), Measure("MAX", "amount", "high"), Measure("COUNT", "props", "n_props"), Measure("COUNT", "amount", "n_amount"), Measure("ANY_VALUE", "label", "label")]
    s.register_cube(Cube("by_hour", "events", "ts", "HOUR", ["user_id", "event_type"], measures))
    s.register_cube(Cube("by_day", "events", "ts", "DAY", ["user_id", "event_type"], measures))
    s.register_cube(Cube("by_day_type", "events", "ts", "DAY", ["event_type"], measures))
    s.register_cube(Cube("by_month", "events", "ts", "MONTH", ["event_type"], measures))
    return s


def agree(on: DataFrame, off: DataFrame) -> DataFrame:
    """The first, whose columns must have the names and types of the second."""
    if [(f.name, f.dataType) for f in on.schema.fields] != [(f.name, f.dataType) for f in off.schema.fields]:
        raise AssertionError(f"{on.schema.simpleString()} and {off.schema.simpleString()}")
    return on


def cube_query(name: str, kind: str, oracle: str, where: tuple[list[str], str] | None = None, cube: str | None = None, **q) -> None:
    """A cube query that must take the route ``kind`` (by ``cube``); where: columns used, and a condition on them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        s = cubes(spark, folder)
        asked = AggQuery("events", time="ts", where=[(where[0], F.expr(where[1]))] if where else [], **q)
        found = s.route(asked)
        if found.kind != kind or cube and found.cube.name != cube:
            raise AssertionError(f"{name} took the route {found.kind} {found.cube}")
        return agree(s.aggregate(asked), cubes(spark, folder, disable_materialized_views=True).aggregate(asked))

    query(name, oracle, exact)(run)


_TOTAL = [Agg("SUM", "amount", "total"), Agg("COUNT", None, "n")]
_SUMS = "CAST(CAST(sum(CAST(value AS DECIMAL(22, 6))) AS DECIMAL(32, 6)) AS VARCHAR) AS total, count(*) AS n"
_AT = datetime(2024, 1, 2, 0, 30, 30)
_TO = datetime(2024, 1, 7, 0, 30, 30)

cube_query("cube_exact", "cube", f"SELECT user_id, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-20' GROUP BY user_id", dims=["user_id"], aggs=_TOTAL, lo=datetime(2024, 1, 2), hi=datetime(2024, 1, 20))
cube_query("cube_union", "union", f"SELECT user_id, date_trunc('day', ts) AS bucket, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' GROUP BY 1, 2", dims=["user_id"], aggs=_TOTAL, unit="DAY", lo=_AT, hi=_TO)
cube_query("cube_fact_only", "fact", f"SELECT event_type, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-02 00:59:00' GROUP BY event_type", dims=["event_type"], aggs=_TOTAL, lo=_AT, hi=datetime(2024, 1, 2, 0, 59))
cube_query("cube_no_range", "cube", f"SELECT event_type, {_SUMS} FROM events GROUP BY event_type", dims=["event_type"], aggs=_TOTAL)
cube_query("cube_coarser_unit", "cube", f"SELECT user_id, date_trunc('month', ts) AS bucket, {_SUMS} FROM events GROUP BY 1, 2", dims=["user_id"], aggs=_TOTAL, unit="MONTH")
cube_query("cube_finer_unit", "union", f"SELECT event_type, date_trunc('hour', ts) AS bucket, {_SUMS} FROM events WHERE ts > TIMESTAMP '2024-01-03 10:15:00' GROUP BY 1, 2", dims=["event_type"], aggs=_TOTAL, unit="HOUR", lo=datetime(2024, 1, 3, 10, 15), lo_open=True)
cube_query("cube_minute_from_fact", "fact", f"SELECT date_trunc('minute', ts) AS bucket, {_SUMS} FROM events GROUP BY 1", dims=[], aggs=_TOTAL, unit="MINUTE")
cube_query("cube_subset_dims", "cube", f"SELECT date_trunc('day', ts) AS bucket, {_SUMS} FROM events GROUP BY 1", dims=[], aggs=_TOTAL, unit="DAY")
cube_query("cube_residual_filter", "union", f"SELECT user_id, {_SUMS} FROM events WHERE event_type IN ('click', 'view') AND ts <= TIMESTAMP '2024-01-20 10:00:00' GROUP BY user_id", dims=["user_id"], aggs=_TOTAL, hi=datetime(2024, 1, 20, 10), hi_closed=True, where=(["event_type"], "event_type IN ('click', 'view')"))
cube_query("cube_residual_not_dim", "fact", f"SELECT event_type, {_SUMS} FROM events WHERE value > 50 GROUP BY event_type", dims=["event_type"], aggs=_TOTAL, where=(["value"], "value > 50"))
cube_query("cube_min_max", "union", "SELECT event_type, CAST(min(CAST(value AS DECIMAL(22, 6))) AS VARCHAR) AS low, CAST(max(CAST(value AS DECIMAL(22, 6))) AS VARCHAR) AS high FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' GROUP BY event_type", dims=["event_type"], aggs=[Agg("MIN", "amount", "low"), Agg("MAX", "amount", "high")], lo=_AT, hi=_TO)
cube_query("cube_count_column", "cube", "SELECT event_type, count(props) AS n FROM events GROUP BY event_type", dims=["event_type"], aggs=[Agg("COUNT", "props", "n")])
cube_query("cube_global_empty", "cube", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2030-01-01' AND ts < TIMESTAMP '2030-02-01'", dims=[], aggs=[Agg("COUNT", None, "n")], lo=datetime(2030, 1, 1), hi=datetime(2030, 2, 1))
cube_query("cube_distinct_from_fact", "fact", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type", dims=["event_type"], aggs=[Agg("COUNT", "user_id", "users", True)])
cube_query("cube_open_closed_bounds", "union", f"SELECT event_type, {_SUMS} FROM events WHERE ts > TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-09' GROUP BY event_type", dims=["event_type"], aggs=_TOTAL, lo=datetime(2024, 1, 3), lo_open=True, hi=datetime(2024, 1, 9), hi_closed=True)



cube_query("cube_unit_with_least_facts", "union", f"SELECT event_type, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:00' AND ts < TIMESTAMP '2024-03-05' GROUP BY event_type", dims=["event_type"], aggs=_TOTAL, lo=datetime(2024, 1, 2, 0, 30), hi=datetime(2024, 3, 5), cube="by_hour")
cube_query("cube_any_value", "cube", "SELECT event_type, upper(event_type) AS label, max(user_id) AS top FROM events GROUP BY event_type", dims=["event_type"], aggs=[Agg("ANY_VALUE", "label", "label"), Agg("MAX", "user_id", "top")], cube="by_day")
cube_query("cube_sum0", "cube", "SELECT '0.000000' AS total, 0::BIGINT AS n FROM range(1)", dims=[], aggs=[Agg("SUM0", "amount", "total"), Agg("COUNT", None, "n")], lo=datetime(2030, 1, 1), hi=datetime(2030, 2, 1))
# the average of decimals with six digits has ten, rounded half up; in whole numbers here
_MEAN = "(sum((CAST(value AS DECIMAL(22, 6)) * 1000000)::HUGEINT) * 20000 + count(*)) // (2 * count(*))"
cube_query("cube_average", "union", f"SELECT user_id, (m // 10000000000)::VARCHAR || '.' || lpad((m % 10000000000)::VARCHAR, 10, '0') AS mean FROM (SELECT user_id, {_MEAN} AS m FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' GROUP BY user_id)", dims=["user_id"], aggs=[Agg("AVG", "amount", "mean")], lo=_AT, hi=_TO)


@query("cube_direct", f"SELECT event_type, date_trunc('day', ts) AS ts, {_SUMS} FROM events GROUP BY 1, 2", exact)
def _(spark, folder):
    return cubes(spark, folder).query("SELECT event_type, ts, total, n FROM by_day_type")


@query("cube_with_dimension", f"SELECT c_mktsegment, {_SUMS} FROM events JOIN customer ON user_id = c_custkey WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' GROUP BY c_mktsegment", exact)
def _(spark, folder):
    s = cubes(spark, folder)
    who = Dimension(s.table("customer"), "user_id", "c_custkey", ["c_mktsegment"])
    return s.aggregate(AggQuery("events", ["c_mktsegment"], _TOTAL, "ts", lo=_AT, hi=_TO, joins=[who]))


@query("cube_off", f"SELECT user_id, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-20' GROUP BY user_id", exact)
def _(spark, folder):
    s = cubes(spark, folder, disable_materialized_views=True)
    return s.aggregate(AggQuery("events", ["user_id"], _TOTAL, "ts", lo=datetime(2024, 1, 2), hi=datetime(2024, 1, 20)))


def cube_sql(name: str, statement: str, oracle: str, args: list | None = None) -> None:
    """SQL that a cube must answer, with the names and types that the fact gives."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        s = cubes(spark, folder)
        if s.route_of(statement, args).kind == "fact":
            raise AssertionError(f"{name} took the fact")
        return agree(s.query(statement, args), cubes(spark, folder, disable_materialized_views=True).query(statement, args))

    query(name, oracle, exact)(run)


_AMOUNT = "CAST(value AS DECIMAL(22, 6))"
cube_sql(
    "cube_sql_union",
    "SELECT event_type, FLOOR(ts TO DAY) AS day, SUM(amount) AS total, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' AND event_type <> 'error' GROUP BY event_type, FLOOR(ts TO DAY)",
    f"SELECT event_type, date_trunc('day', ts) AS day, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' AND event_type <> 'error' GROUP BY 1, 2",
)
cube_sql(
    "cube_sql_having_order",
    "SELECT user_id, SUM(amount) AS total, COUNT(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-18 00:00:00' GROUP BY user_id HAVING COUNT(*) > 20 ORDER BY SUM(amount) DESC, user_id LIMIT 15",
    f"SELECT user_id, {_SUMS} FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-18 00:00:00' GROUP BY user_id HAVING count(*) > 20 ORDER BY sum({_AMOUNT}) DESC, user_id LIMIT 15",
)
cube_sql("cube_sql_global", "SELECT MIN(amount) AS low, MAX(amount) AS high, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10 12:00:00'", f"SELECT CAST(min({_AMOUNT}) AS VARCHAR) AS low, CAST(max({_AMOUNT}) AS VARCHAR) AS high, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10 12:00:00'")
cube_sql(
    "cube_sql_join",
    "SELECT c.c_mktsegment, FLOOR(e.ts TO DAY) AS day, SUM(e.amount) AS total, COUNT(*) AS n FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.ts >= TIMESTAMP '2024-01-02 00:30:30' AND e.ts < TIMESTAMP '2024-01-07 00:30:30' AND c.c_nationkey < 15 AND e.event_type <> 'error' GROUP BY c.c_mktsegment, FLOOR(e.ts TO DAY)",
    f"SELECT c_mktsegment, date_trunc('day', ts) AS day, {_SUMS} FROM events JOIN customer ON user_id = c_custkey WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' AND c_nationkey < 15 AND event_type <> 'error' GROUP BY 1, 2",
)
cube_sql(
    "cube_sql_left_join",
    "SELECT c_nationkey, $SUM0(amount) AS total, ANY_VALUE(label) AS label, COUNT(*) AS n FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'view' GROUP BY c_nationkey ORDER BY c_nationkey LIMIT 9",
    f"SELECT c_nationkey, CAST(CAST(sum({_AMOUNT}) AS DECIMAL(32, 6)) AS VARCHAR) AS total, 'VIEW' AS label, count(*) AS n FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'view' GROUP BY c_nationkey ORDER BY c_nationkey LIMIT 9",
)
cube_sql(
    "cube_sql_bind", "SELECT event_type, SUM(amount) AS total, COUNT(*) AS n FROM events WHERE ts >= ? AND ts < ? AND event_type <> ? GROUP BY event_type",
    f"SELECT event_type, {_SUMS} FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-07 00:30:30' AND event_type <> 'error' GROUP BY event_type",
    [_AT, _TO, "error"],
)

# ------------------------------------------- stored tables, inserts, generator

_DDL = """
CREATE TABLE IF NOT EXISTS clicks (
  user_id BIGINT PRIMARY KEY, ts TIMESTAMP PRIMARY KEY DESC ROW_TIMESTAMP, event_id BIGINT PRIMARY KEY,
  event_type VARCHAR, amount DECIMAL(22, 6) DEFAULT 0 COMMENT 'money')
PARTITION BY HASH (user_id) PARTITIONS 4 NUM_REPLICAS 1
"""
_VIEW = "CREATE MATERIALIZED VIEW clicks_by_day AS SELECT SUM(amount) AS total, COUNT(*) AS n, MAX(amount) AS high FROM clicks GROUP BY event_type, FLOOR(ts TO DAY)"


def stored(spark: SparkSession) -> Session:
    """A session on a new folder beside the checkpoints (the session's own temporary one if none is set)."""
    import tempfile
    import uuid

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise EngineError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tallystone-")
    s = Session(spark, f"{base}/store-{uuid.uuid4().hex}", EngineConfig(enable_inserts=True))
    s.sql(_DDL)
    return s


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    e = spark.read.parquet(f"{folder}/events.parquet")
    return e.select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", F.col("value").cast("decimal(22,6)").alias("amount"))


@query("insert_commit", "SELECT 1::BIGINT AS user_id, 10::BIGINT AS event_id, 'view' AS event_type, CAST(2.5 AS DOUBLE) AS amount UNION ALL SELECT 2, 11, 'click', CAST(0 AS DOUBLE) UNION ALL SELECT 3, 12, NULL, CAST(1 AS DOUBLE)")
def _(spark, folder):
    s = stored(spark)
    s.sql("INSERT INTO clicks VALUES (1, TIMESTAMP '2024-01-01 10:00:00', 10, 'view', 2.5)")
    s.sql("INSERT INTO clicks (user_id, ts, event_id, event_type) VALUES (?, ?, ?, ?)", [2, datetime(2024, 1, 2), 11, "click"])
    s.sql("UPSERT INTO clicks (user_id, ts, event_id, amount) VALUES (3, TIMESTAMP '2024-01-03 00:00:00', 12, 1)")
    s.sql("COMMIT")
    return s.table("clicks").drop("ts")


@query("insert_select_alter", "SELECT event_id, event_type, CAST(NULL AS INTEGER) AS extra, 7 AS score FROM events WHERE event_type = 'error'")
def _(spark, folder):
    s = stored(spark)
    open_table(s, folder, "events")
    s.sql("INSERT INTO clicks (user_id, ts, event_id, event_type) SELECT user_id, ts, event_id, event_type FROM events WHERE event_type = 'error'")
    s.commit()
    s.sql("ALTER TABLE clicks ADD COLUMNS (extra INT, score INT NOT NULL DEFAULT 7)")
    return s.sql("SELECT event_id, event_type, extra, score FROM clicks")


@query("alter_drop", "SELECT event_id, user_id, ts, CAST(NULL AS VARCHAR) AS event_type FROM events WHERE user_id < 9")
def _(spark, folder):
    s = stored(spark)
    s.append("clicks", _clicks(spark, folder).filter("user_id < 9"))
    s.commit()
    s.sql("ALTER TABLE clicks DROP COLUMNS (event_type, amount)")
    s.sql("ALTER TABLE clicks ADD COLUMNS (event_type VARCHAR)")  # another column: the old values stay dropped
    return s.sql("SELECT * FROM clicks")


@query("snapshot_read", "SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-12 07:00:00' GROUP BY event_type")
def _(spark, folder):
    s = stored(spark)
    rows = _clicks(spark, folder)
    s.append("clicks", rows.filter("ts < TIMESTAMP_NTZ '2024-01-12 07:00:00'"))
    s.commit()
    between = time.time()
    time.sleep(0.05)
    s.append("clicks", rows.filter("ts >= TIMESTAMP_NTZ '2024-01-12 07:00:00'"))
    s.commit()
    # a session that reads what was newest when the first commit was done
    old = Session(spark, s.store.root, EngineConfig(snapshot_difference_ms=max(1, round((time.time() - between) * 1000) - 10)))
    return old.sql("SELECT event_type, count(*) AS n FROM clicks GROUP BY event_type")


@query("catalog_listing", "SELECT * FROM (VALUES ('customer', 'DIMENSION', 1000), ('events', 'FACT', 1000000000000), ('by_hour', 'CUBE', 1000000000), ('by_day', 'CUBE', 1000000000), ('by_day_type', 'CUBE', 1000000000), ('by_month', 'CUBE', 1000000000)) t(name, kind, estimate)")
def _(spark, folder):
    return spark.createDataFrame(cubes(spark, folder).tables(), "name string, kind string, estimate long")


@query("explain_route", "SELECT 'Route: union' AS route")
def _(spark, folder):
    text = cubes(spark, folder).explain("SELECT event_type, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10 12:30:00' GROUP BY event_type")
    return spark.createDataFrame([(text[:12],)], "route string")


@query("cube_incremental", f"SELECT event_type, {_SUMS}, CAST(max({_AMOUNT}) AS VARCHAR) AS high FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-27 00:30:30' GROUP BY event_type", exact)
def _(spark, folder):
    s = stored(spark)
    rows = _clicks(spark, folder)
    s.append("clicks", rows.filter("ts < TIMESTAMP_NTZ '2024-01-12 07:00:00'"))
    s.commit()
    s.sql(_VIEW)
    s.append("clicks", rows.filter("ts >= TIMESTAMP_NTZ '2024-01-12 07:00:00'"))
    s.commit()
    return s.sql("SELECT event_type, SUM(amount) AS total, COUNT(*) AS n, MAX(amount) AS high FROM clicks WHERE ts >= TIMESTAMP '2024-01-02 00:30:30' AND ts < TIMESTAMP '2024-01-27 00:30:30' GROUP BY event_type")


SCENARIO = {
    "tableName": "parcel_scans", "numRows": 3000,
    "columnNameToValueGenerator": {
        "parcel": {"type": "RandomSidGenerator", "sidPrefix": "PC"},
        "depot": {"type": "ValueListGenerator", "values": ["harbour", "airport", "old town", "mill", "north gate"]},
        "courier": {"type": "SidListGenerator", "sidPrefix": "CR", "numValues": 37},
        "scanned_ms": {"type": "UniformLongValueGenerator", "minValue": 1704067200000, "maxValue": 1706745600000},
        "weight_g": {"type": "UniformIntegerValueGenerator", "minValue": 40, "maxValue": 31500},
        "fee": {"type": "UniformBigDecimalValueGenerator", "maxValue": "84.5"},
        "carrier": {"type": "ConstantValueGenerator", "columnValue": "own"},
    },
    "multipleColumnValueGenerators": [{"type": "CubeGenerator", "groupedColumns": ["depot", "courier"], "counts": [5, 1, 2], "numUniqueGroups": 9}],
}


def _drawn(what: str, of: str = "i") -> str:
    return f"('0x' || substr(md5('42:{what}:' || {of}), 1, 15))::BIGINT"


_ENDS = [5, 6, 8, 13, 14, 16, 21, 22, 24]  # running sums of the nine groups' counts
_GROUP = "CASE " + " ".join(f"WHEN pick < {e} THEN {g}" for g, e in enumerate(_ENDS)) + " END"


@query("datagen_scenario", f"""
    SELECT 'PC' || md5({_drawn("parcel")}::VARCHAR) AS parcel, ['harbour', 'airport', 'old town', 'mill', 'north gate'][({_drawn("depot", "g")} % 5 + 1)::INT] AS depot,
           'CR' || md5(({_drawn("courier", "g")} % 37)::VARCHAR) AS courier, 1704067200000 + {_drawn("scanned_ms")} % 2678400000 AS scanned_ms,
           (40 + {_drawn("weight_g")} % 31460)::INT AS weight_g, ({_drawn("fee")} % 84500000 / 1000000)::DECIMAL(22, 6)::DOUBLE AS fee, 'own' AS carrier
    FROM (SELECT i, {_GROUP} AS g FROM (SELECT range AS i, {_drawn("group0", "range")} % 24 AS pick FROM range(3000)))
""")
def _(spark, folder):
    return generate(spark, SCENARIO, seed=42)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Daily totals per user over an unaligned range, from the facts at the edges and the rollup between."""
    return QUERIES["cube_union"](spark, folder)
