"""Definitions, inserts, commits, the dialect and stored cubes."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.catalog import Catalog, Column, Cube, Measure, Table, kind_of, nests
from tallystone.errors import DuplicateKey, EngineError, UnsupportedOperation
from tallystone.plans import ddl
from tallystone.plans.cubes import Agg, AggQuery
from tallystone.plans.dialect import Dialect
from tallystone.plans.tokens import text, tokenise
from tallystone.session import EngineConfig, Session

ALL_TYPES = """
CREATE TABLE "all types" (
  s VARCHAR, t TIMESTAMP DESC, i8 TINYINT, i16 SMALLINT NULL DEFAULT -5, i32 INT COLUMN_ENCODING 'PLAIN_ENCODING' COMPRESSION 'LZ4',
  i64 BIGINT BLOCK_SIZE 4096, b VARBINARY, yes BOOLEAN, f FLOAT, d DOUBLE, m DECIMAL(22, 6) DEFAULT 1.5 COMMENT 'it''s money',
  PRIMARY KEY (s, t DESC, i8))
PARTITION BY HASH (s) PARTITIONS 3 NUM_REPLICAS = 1 TBLPROPERTIES ('a.b' = 'c')
"""
FACT = "CREATE TABLE f (acct VARCHAR PRIMARY KEY, at TIMESTAMP PRIMARY KEY DESC ROW_TIMESTAMP, id BIGINT PRIMARY KEY, kind VARCHAR, amount DECIMAL(22, 6)) PARTITION BY HASH (acct) PARTITIONS 2"
VIEW = "CREATE MATERIALIZED VIEW f_by_hour AS SELECT SUM(amount) AS total, COUNT(*) AS n, MIN(amount) AS low, COUNT(kind) AS kinds FROM f GROUP BY acct, FLOOR(at TO HOUR)"


@pytest.fixture
def s(spark, tmp_path):
    return Session(spark, f"file://{tmp_path}", EngineConfig(enable_inserts=True, cube_parts=2))


def parsed(sql):
    return ddl.parse(sql)


def test_create_table_parses(spark):
    t = parsed(ALL_TYPES).table
    assert t.key == ["s", "t", "i8"] and t.descending("t") and t.buckets == 3 and t.replicas == 1
    assert t.properties == {"a.b": "c"} and t.column("m").default == Decimal("1.500000") and t.column("m").comment == "it's money"
    assert t.column("i32").options == {"COLUMN_ENCODING": "PLAIN_ENCODING", "COMPRESSION": "LZ4"}
    assert not t.column("s").nullable and t.column("yes").nullable
    assert [f.dataType.simpleString() for f in t.schema().fields] == ["string", "timestamp_ntz", "tinyint", "smallint", "int", "bigint", "binary", "boolean", "float", "double", "decimal(22,6)"]


def test_key_constraint_moves_columns_first():
    t = parsed("CREATE TABLE x (a INT, b INT, c INT, PRIMARY KEY (c, a)) PARTITION BY HASH (c) PARTITIONS 2").table
    assert [c.name for c in t.columns] == ["c", "a", "b"]


@pytest.mark.parametrize("sql", [
    "CREATE TABLE x (a INT PRIMARY KEY, PRIMARY KEY (a)) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT PRIMARY KEY)",
    "CREATE TABLE x (a INT PRIMARY KEY, b DECIMAL) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT PRIMARY KEY, b DATE) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a VARCHAR PRIMARY KEY DESC) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT PRIMARY KEY NULL) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a TIMESTAMP PRIMARY KEY ROW_TIMESTAMP, b TIMESTAMP ROW_TIMESTAMP) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a TINYINT PRIMARY KEY, b TINYINT DEFAULT 200) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT PRIMARY KEY, a INT) PARTITION BY HASH (a) PARTITIONS 2",
    "CREATE TABLE x (a INT PRIMARY KEY, b INT) PARTITION BY HASH (b) PARTITIONS 2",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x",
    "CREATE MATERIALIZED VIEW v AS SELECT * FROM x GROUP BY a, FLOOR(t TO DAY)",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x GROUP BY b",
    "CREATE MATERIALIZED VIEW v AS SELECT AVG(a) FROM x GROUP BY b, FLOOR(t TO DAY)",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x GROUP BY b, FLOOR(t TO WEEK)",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x WHERE a > 1 GROUP BY b, FLOOR(t TO DAY)",
    "CREATE MATERIALIZED VIEW v.w AS SELECT SUM(a) FROM x GROUP BY b, FLOOR(t TO DAY)",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x GROUP BY b, FLOOR(t TO DAY) ORDER BY b",
    "CREATE MATERIALIZED VIEW v AS SELECT SUM(a) FROM x GROUP BY FLOOR(u TO DAY), FLOOR(t TO DAY)",
    "CREATE VIEW v AS SELECT 1", "DROP TABLE x", "UPDATE x SET a = 1", "DELETE FROM x",
    "ALTER TABLE x RENAME TO y", "ALTER TABLE x ADD COLUMNS (b INT NOT NULL)", "ALTER TABLE x ADD COLUMNS (b INT PRIMARY KEY)",
    "INSERT INTO x VALUES (1, ?)", "INSERT INTO x VALUES (1 + 1)", "INSERT INTO x VALUES (1",
])
def test_refused_statements(sql):
    with pytest.raises(EngineError):
        ddl.parse(sql)


def test_definitions(s):
    s.sql(ALL_TYPES)
    s.sql(ALL_TYPES.replace("CREATE TABLE", "CREATE TABLE IF NOT EXISTS"))
    with pytest.raises(EngineError):
        s.sql(ALL_TYPES)
    s.sql(FACT)
    s.sql(VIEW)
    assert s.tables() == [("all types", "DIMENSION", 10**3), ("f", "FACT", 10**12), ("f_by_hour", "CUBE", 10**9)]
    again = Session(s.spark, s.store.root)
    assert again.tables() == s.tables() and again.catalog.cubes["f_by_hour"].physical_name == "f-f_by_hour-Hour-Aggregation"
    with pytest.raises(EngineError):
        s.sql("CREATE MATERIALIZED VIEW g AS SELECT COUNT(*) FROM f GROUP BY kind, FLOOR(id TO DAY)")
    with pytest.raises(EngineError):
        s.sql(VIEW)
    s.sql(VIEW.replace("VIEW f", "VIEW IF NOT EXISTS f"))


def test_cube_on_another_time_needs_an_order(s):
    s.sql("CREATE TABLE x (a BIGINT PRIMARY KEY, t TIMESTAMP PRIMARY KEY ROW_TIMESTAMP, u TIMESTAMP) PARTITION BY HASH (a) PARTITIONS 2")
    with pytest.raises(EngineError):
        s.sql("CREATE MATERIALIZED VIEW v AS SELECT COUNT(*) FROM x GROUP BY a, FLOOR(u TO DAY)")
    s.sql("CREATE MATERIALIZED VIEW v AS SELECT COUNT(*) FROM x GROUP BY a, FLOOR(u TO DAY) ORDER BY FLOOR(u TO DAY) DESC, a")
    assert s.catalog.cubes["v"].order == [("u", True), ("a", False)]


def test_every_type_defaults_and_extremes(s):
    s.sql(ALL_TYPES)
    s.sql("INSERT INTO \"all types\" (s, t, i8, i64, b, yes, f) VALUES ('a''b', TIMESTAMP '2024-01-01 00:00:00.123456', -128, 9223372036854775807, X'00ff', TRUE, 1.5), ('', TIMESTAMP '1960-01-01 00:00:00', 127, -9223372036854775808, NULL, FALSE, -2)")
    s.commit()
    rows = s.sql('SELECT * FROM "all types" ORDER BY i8').collect()
    assert tuple(rows[0]) == ("a'b", datetime(2024, 1, 1, 0, 0, 0, 123456), -128, -5, None, 2**63 - 1, bytearray(b"\x00\xff"), True, 1.5, None, Decimal("1.500000"))
    assert rows[1]["i64"] == -(2**63) and rows[1]["t"] == datetime(1960, 1, 1)


def test_insert_errors(s):
    s.sql(FACT)
    for bad in ("(NULL, TIMESTAMP '2024-01-01 00:00:00', 1, 'k', 1)", "('a', TIMESTAMP '2024-01-01 00:00:00', 'x', 'k', 1)", "('a', TIMESTAMP '2024-01-01 00:00:00', 1, 'k')", "('a', TIMESTAMP '2024-01-01 00:00:00', 1, 'k', 1.23456789)"):
        with pytest.raises(EngineError):
            s.sql(f"INSERT INTO f VALUES {bad}")
    with pytest.raises(EngineError):
        s.sql("INSERT INTO f (acct, nope) VALUES ('a', 1)")
    with pytest.raises(EngineError):
        s.sql("INSERT INTO f (acct, at, id) VALUES (?, ?, ?)", ["a"])
    s.sql(VIEW)
    with pytest.raises(UnsupportedOperation):
        s.sql("INSERT INTO f_by_hour VALUES (1)")
    with pytest.raises(UnsupportedOperation):
        Session(s.spark, s.store.root).sql("INSERT INTO f VALUES ('a', TIMESTAMP '2024-01-01 00:00:00', 1, 'k', 1)")
    with pytest.raises(UnsupportedOperation):
        Session(s.spark, config=EngineConfig(auto_commit=True))


def put(s, acct, at, id_, kind, amount):
    s.insert("f", acct=acct, at=at, id=id_, kind=kind, amount=Decimal(amount))


def test_duplicates_rollback_and_conflicts(s):
    s.sql(FACT)
    put(s, "a", datetime(2024, 1, 1), 1, "k", "1")
    s.rollback()
    s.commit()
    assert s.table("f").count() == 0
    put(s, "a", datetime(2024, 1, 1), 1, "k", "1")
    s.commit()
    for n in (1, 2):
        for _ in range(n):
            put(s, "a", datetime(2024, 1, n), 1, "k", "1")
        with pytest.raises(DuplicateKey):
            s.commit()
        assert s.table("f").count() == 1
    other = Session(s.spark, s.store.root, EngineConfig(enable_inserts=True))
    put(other, "b", datetime(2024, 1, 1), 2, "k", "1")
    put(s, "b", datetime(2024, 1, 1), 3, "k", "1")
    other.commit()
    with pytest.raises(EngineError, match="another session"):
        s.commit()
    s.refresh()
    assert s.table("f").count() == 2


def test_bulk_append_checks_nulls_and_keys(s):
    s.sql(FACT)
    frame = s.spark.range(100).select(F.lit("a").alias("acct"), F.lit(datetime(2024, 1, 1)).alias("at"), F.col("id"), F.lit(2).alias("amount"))
    s.append("f", frame)
    s.commit()
    assert s.sql("SELECT COUNT(*) AS n, SUM(amount) AS t FROM f WHERE kind IS NULL").first() == (100, Decimal(200))
    s.append("f", frame.withColumn("acct", F.lit(None).cast("string")))
    with pytest.raises(EngineError):
        s.commit()
    s.append("f", frame.filter("id = 7"))
    with pytest.raises(DuplicateKey):
        s.commit()


def test_alter(s):
    s.sql(FACT)
    put(s, "a", datetime(2024, 1, 1), 1, "k", "1")
    s.commit()
    s.sql("ALTER TABLE f ADD COLUMNS (note VARCHAR DEFAULT 'none', n INT)")
    s.sql("ALTER TABLE f ADD COLUMNS IF NOT EXISTS (note VARCHAR)")
    s.insert("f", acct="a", at=datetime(2024, 1, 2), id=2, note=None, n=4)
    s.commit()
    assert [tuple(r) for r in s.sql("SELECT id, note, n FROM f ORDER BY id").collect()] == [(1, "none", None), (2, None, 4)]
    s.sql("ALTER TABLE f DROP COLUMNS (note)")
    s.sql("ALTER TABLE f DROP COLUMNS IF EXISTS (note)")
    s.sql("ALTER TABLE f ADD COLUMNS (note INT DEFAULT 3)")
    assert [r["note"] for r in s.sql("SELECT note FROM f").collect()] == [3, 3]
    s.sql(VIEW)
    for bad in ("ALTER TABLE f DROP COLUMNS (nope)", "ALTER TABLE f DROP COLUMNS (acct)", "ALTER TABLE f DROP COLUMNS (amount)", "ALTER TABLE f ADD COLUMNS (n INT)"):
        with pytest.raises(EngineError):
            s.sql(bad)


def test_snapshot_read(s):
    s.sql(FACT)
    put(s, "a", datetime(2024, 1, 1), 1, "k", "1")
    s.commit()
    found = s.store.newest()
    put(s, "a", datetime(2024, 1, 2), 2, "k", "1")
    s.commit()
    assert s.store.newest(found["at_ms"])["version"] >= found["version"]
    import time

    old = Session(s.spark, s.store.root, EngineConfig(snapshot_difference_ms=int(time.time() * 1000) - found["at_ms"] + 1))
    assert "f" not in old.catalog.tables or old.table("f").count() <= 1


def test_cubes_kept_on_write(s):
    s.sql(FACT)
    put(s, "a", datetime(2024, 1, 1, 5, 10), 1, "k", "4")
    s.commit()
    s.sql(VIEW)
    for i in range(2, 8):  # more parts than are kept: they are merged
        put(s, "ab"[i % 2], datetime(2024, 1, 1, 5, i), i, None if i == 3 else "k", str(i))
        s.commit()
    assert len(s._folders["f_by_hour"]) <= 3
    want = {("a", datetime(2024, 1, 1, 5)): (Decimal(16), 4, Decimal(2), 4), ("b", datetime(2024, 1, 1, 5)): (Decimal(15), 3, Decimal(3), 2)}
    got = {(r["acct"], r["at"]): (r["total"], r["n"], r["low"], r["kinds"]) for r in s.sql("SELECT * FROM f_by_hour").collect()}
    assert got == want
    q = "SELECT acct, FLOOR(at TO DAY) AS d, SUM(amount) AS t, COUNT(*) AS n, MIN(amount) AS low FROM f WHERE at >= TIMESTAMP '2024-01-01 00:30:00' AND at < TIMESTAMP '2024-01-01 05:05:00' GROUP BY acct, FLOOR(at TO DAY)"
    assert s.explain(q).startswith("Route: union")
    off = Session(s.spark, s.store.root, EngineConfig(disable_materialized_views=True))
    assert sorted(s.sql(q).collect()) == sorted(off.sql(q).collect())
    skip = Session(s.spark, s.store.root, EngineConfig(enable_inserts=True, disable_cube_aggregation=True))
    put(skip, "z", datetime(2024, 1, 1), 99, "k", "1")
    skip.commit()
    assert skip.sql("SELECT COUNT(*) AS n FROM f_by_hour WHERE acct = 'z'").first()["n"] == 0


def test_null_time_and_null_dims(spark):
    s = Session(spark)
    rows = [("a", None, 1), (None, datetime(2024, 1, 1, 1), 2), ("a", datetime(2024, 1, 1, 2), None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v long")
    s.register(Table("f", [Column("k", "string"), Column("ts", "timestamp_ntz"), Column("v", "bigint")], [], declared_kind="FACT"), df)
    s.register_cube(Cube("c", "f", "ts", "DAY", ["k"], [Measure("SUM", "v"), Measure("COUNT", "v"), Measure("COUNT")]))
    off = Session(spark, config=EngineConfig(disable_materialized_views=True))
    off.register(s.catalog.table("f"), df)
    for q in (
        AggQuery("f", ["k"], [Agg("SUM", "v", "s"), Agg("COUNT", "v", "c"), Agg("COUNT", None, "n"), Agg("AVG", "v", "a")], "ts", "DAY"),
        AggQuery("f", [], [Agg("SUM", "v", "s"), Agg("COUNT", None, "n")], "ts", lo=datetime(2024, 1, 1, 1, 30)),
        AggQuery("f", ["k"], [Agg("COUNT", None, "n")]),
    ):
        assert s.route(q).kind != "fact"
        key = lambda r: str(tuple(r))
        assert sorted(s.aggregate(q).collect(), key=key) == sorted(off.aggregate(q).collect(), key=key)


def test_metadata():
    assert kind_of("F-c-Day-Aggregation") == "CUBE" and kind_of("SystemX") == "SYSTEM" and kind_of("x", {"x"}) == "FACT" and kind_of("x") == "DIMENSION"
    assert nests("HOUR", "DAY") and not nests("MONTH", "DAY")
    c = Catalog()
    c.add(parsed(ALL_TYPES).table)
    assert Catalog.loads(c.dumps()).table("ALL TYPES").key == ["s", "t", "i8"]


def test_dialect():
    c = Catalog()
    c.add(parsed(FACT).table)
    d = Dialect(c)
    assert d.query("EXPLAIN PLAN FOR SELECT 'FLOOR(at TO DAY)' FROM f -- FETCH") == "EXPLAIN SELECT 'FLOOR(at TO DAY)' FROM f"
    assert d.query('SELECT "Kind" FROM f') == "SELECT `Kind` FROM f"
    assert "`acct`, `at` DESC, `id` LIMIT 3 OFFSET 2" in d.query("SELECT id FROM f OFFSET 2 ROWS FETCH FIRST 3 ROWS ONLY")
    assert "at < TIMESTAMP_NTZ '2024-01-01'" in d.query("SELECT * FROM f WHERE (acct, at) > ('a', TIMESTAMP '2024-01-01')")
    assert d.query("SELECT * FROM f WHERE FLOOR(at TO MONTH) > TIMESTAMP '2024-02-10 00:00:00'").endswith("((at >= TIMESTAMP_NTZ '2024-03-01 00:00:00.000000'))")
    assert "date_trunc" in d.query("SELECT * FROM f WHERE FLOOR(at TO MONTH) > other")
    with pytest.raises(UnsupportedOperation):
        d.query("SELECT * FROM f WHERE (acct, at) < ('a', TIMESTAMP '2024-01-01')")
    assert text(tokenise("a/* FLOOR( */b 'it''s' \"q\"\"\" `x`")) == "a b 'it''s' \"q\"\"\" `x`"


def test_pages_cover_a_table(spark):
    s = Session(spark)
    rows = [(a, datetime(2024, 1, 1 + d), i) for a in range(3) for d in range(4) for i in range(5)]
    t = Table("p", [Column("a", "bigint"), Column("at", "timestamp_ntz", desc=True), Column("i", "bigint")], ["a", "at", "i"])
    s.register(t, spark.createDataFrame(rows, "a long, at timestamp_ntz, i long"))
    got = [tuple(r) for page in s.pages("p", 7) for r in page]
    assert got == sorted(rows, key=lambda r: (r[0], -r[1].day, r[2]))
    one = [tuple(r) for page in s.pages("p", 4, F.col("a") == 1) for r in page]
    assert one == [r for r in got if r[0] == 1]


def test_scan_statistics_and_cancel(spark):
    from tallystone.operators import cancellable, timed_count

    out = timed_count(spark.range(100))
    assert out["rows"] == 100 and out["partitions"] >= 1 and 100 >= out["largest_partition"] >= 25 and out["total_s"] > 0
    assert timed_count(spark.range(0))["rows"] == 0
    with cancellable(spark) as cancel:
        cancel()
        assert callable(cancel)


def test_failed_commits_leave_no_folder(s, tmp_path):
    s.sql(FACT)
    s.sql(VIEW)
    row = "('a', TIMESTAMP '2024-01-01 10:00:00', 1, 'k', 2)"
    s.sql(f"INSERT INTO f VALUES {row}")
    s.commit()
    held = sorted(p.name for p in (tmp_path / "data").rglob("_part=*"))
    s.sql(f"INSERT INTO f VALUES {row}")
    with pytest.raises(DuplicateKey):
        s.commit()
    assert sorted(p.name for p in (tmp_path / "data").rglob("_part=*")) == held
    assert s.table("f").count() == 1


def test_two_sessions_publish_one_version(s, spark, tmp_path):
    s.sql(FACT)
    other = Session(spark, f"file://{tmp_path}", EngineConfig(enable_inserts=True))
    for i, x in enumerate((s, other)):
        x.sql(f"INSERT INTO f VALUES ('a', TIMESTAMP '2024-01-01 10:00:00', {i}, 'k', 2)")
    s.commit()
    with pytest.raises(EngineError, match="another session"):
        other.commit()
    other.refresh()
    assert other.table("f").count() == 1 and len(list((tmp_path / "versions").glob("*.json"))) == 2


def test_the_key_check_reads_the_days_of_the_batch(s):
    s.sql(FACT)
    for day in (1, 2, 3):
        s.sql(f"INSERT INTO f VALUES ('a', TIMESTAMP '2024-01-0{day} 10:00:00', 1, 'k', 2)")
        s.commit()
    t = s.catalog.table("f")
    near = s.near(t, s.table("f").filter("at < TIMESTAMP_NTZ '2024-01-02 00:00:00'"))
    assert near.count() == 1
    assert "PartitionFilters: [_day" in near._jdf.queryExecution().explainString(s.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) or "isnotnull(_day" in str(near._jdf.queryExecution().toString())


def test_a_batch_number_is_published_once(s, spark, tmp_path):
    from tallystone.streaming import maintain

    s.sql(FACT)
    made = []
    stream = type("Stream", (), {"writeStream": type("Writer", (), {"foreachBatch": lambda self, f: (made.append(f), self)[1], "option": lambda self, k, v: self})()})
    maintain(stream, s, "f", "here")
    rows = spark.createDataFrame([("a", datetime(2024, 1, 1), 1, "k", Decimal(2))], s.catalog.table("f").schema())
    made[0](rows, 0)
    version = s.store.versions()[-1]
    made[0](rows, 0)  # run again: nothing is written
    assert s.store.versions()[-1] == version and s.done("here") == 0 and s.done("there") == -1
    made[0](rows, 1)
    assert s.table("f").count() == 1 and s.done("here") == 1


def test_averages_of_decimals_have_the_fact_s_rounding(spark):
    import random

    r = random.Random(2)
    rows = [(r.choice("abcdefghij"), datetime(2024, 1, 1, r.randrange(24), 5), Decimal(r.randint(-(10**9), 10**9)).scaleb(-6)) for _ in range(700)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, v decimal(22,6)")
    answers = []
    for off in (False, True):
        one = Session(spark, config=EngineConfig(disable_materialized_views=off))
        one.register(Table("f", [Column("k", "string"), Column("at", "timestamp_ntz", row_timestamp=True), Column("v", "decimal(22,6)")], ["k"]), df)
        one.register_cube(Cube("c", "f", "at", "HOUR", ["k"], [Measure("SUM", "v"), Measure("COUNT", "v"), Measure("COUNT", None)]))
        got = one.query("SELECT k, AVG(v) AS m, SUM(v) AS t, COUNT(*) AS n FROM f GROUP BY k")
        answers.append((got.dtypes, sorted(tuple(x) for x in got.collect())))
    assert answers[0] == answers[1]


def test_the_nested_join_hint_reaches_the_join(spark, monkeypatch):
    from tallystone import session as module

    s = Session(spark)
    for name, n in (("small", 10), ("large", 1000)):
        s.register(Table(name, [Column("k", "bigint"), Column(f"v_{name}", "bigint")], ["k"]), spark.range(n).select(F.col("id").alias("k"), F.col("id").alias(f"v_{name}")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda q: s.query(q)._jdf.queryExecution().executedPlan().toString()
        hint = "SELECT /*+ USE_ANY_NESTED_JOIN */ a.k"
        inner = plan(f"{hint} FROM small a JOIN large b ON a.k = b.k AND a.k < b.v_large + 1")
        assert "BroadcastHashJoin" in inner and "BuildLeft" in inner
        left = plan(f"{hint} FROM small AS a LEFT JOIN large b ON a.k = b.k")
        assert "BroadcastHashJoin" in left and "BuildRight" in left
        assert "BroadcastNestedLoopJoin" in plan(f"{hint} FROM small a JOIN large b ON a.k > b.k")
        assert "SortMergeJoin" in plan("SELECT a.k FROM small a JOIN large b ON a.k = b.k")
        assert "SortMergeJoin" in plan(f"{hint} FROM small a RIGHT JOIN large b ON a.k = b.k")
        assert "SortMergeJoin" in plan(f"{hint} FROM small a JOIN large b ON a.k = b.k AND (a.k = 1 OR b.k = 2)")
        monkeypatch.setattr(module, "LIMIT_BYTES", 10)
        assert "SortMergeJoin" in plan(f"{hint} FROM small a JOIN large b ON a.k = b.k")  # too large to be sent whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pinned_keys():
    from tallystone.operators.scan import pinned

    key = ["a", "b", "c"]
    for condition, want in [("a = 1", "a"), ("a = 'x' AND b = -2", "ab"), ("1 = a AND (b = 2 OR c = 3)", "a"), ("(a = 1 AND b = 2) OR (a = 3 AND c = 1)", "a"), ("a > 1", ""), ("a = b", ""), ("d = 1", ""), ("a BETWEEN 1 AND 2", "")]:
        assert pinned(condition, key) == set(want), condition


def test_bound_values_are_literals(spark):
    s = Session(spark)
    row = s.query("SELECT ? AS a, ? AS b, ? AS c, ? AS d, ? AS e, ? AS f", [1, "it's a \\ 'q' ?", None, datetime(2024, 1, 2, 3), Decimal("1.50"), 2.5]).first()
    assert tuple(row) == (1, "it's a \\ 'q' ?", None, datetime(2024, 1, 2, 3), Decimal("1.50"), 2.5)
    with pytest.raises(EngineError):
        s.query("SELECT ?, ?", [1])
