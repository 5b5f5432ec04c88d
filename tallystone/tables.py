"""The star-schema tables of a folder of Parquet files, with keys and row timestamps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import Column, Table
from .session import Session

#: name -> (key columns; a minus means descending, row timestamp)
KEYS = {
    "region": (["r_regionkey"], None),
    "nation": (["n_nationkey"], None),
    "customer": (["c_custkey"], None),
    "supplier": (["s_suppkey"], None),
    "part": (["p_partkey"], None),
    "orders": (["o_custkey", "-o_orderdate", "o_orderkey"], "o_orderdate"),
    "lineitem": ([], None),  # (l_orderkey, l_linenumber) repeats
    "events": (["user_id", "-ts", "event_id"], "ts"),
}


def open_table(session: Session, folder: str, name: str) -> Table:
    """Registers ``folder``/``name``.parquet."""
    keys, stamp = KEYS[name]
    df = session.spark.read.parquet(f"{folder}/{name}.parquet")
    # stored timestamps are UTC; without a zone they compare with literals as they stand and are still pushed down
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if zoned:
        df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
    down = {k[1:] for k in keys if k.startswith("-")}
    columns = [Column(f.name, f.dataType.simpleString(), True, f.name in down, f.name == stamp) for f in df.schema.fields]
    table = Table(name, columns, [k.lstrip("-") for k in keys], declared_kind="FACT" if name in ("lineitem", "orders", "events") else None)
    session.register(table, df)
    return table


def open_folder(session: Session, folder: str, names: list[str] | None = None) -> Session:
    for name in names or KEYS:
        open_table(session, folder, name)
    return session
