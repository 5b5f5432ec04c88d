"""Versioned Parquet storage.

A version is one small JSON file that names the Parquet folders of every table
and cube.  Folders are written first; creating the version file, which fails if
it exists, publishes fact and cubes together.  A retried commit writes other
folders, so nothing is counted twice, and older versions stay readable: that is
the snapshot read.  All paths go through Spark's file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog, Table
from ..catalog import Column as TableColumn
from ..errors import EngineError


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(f"{self.root}/versions"))

    # -- versions

    def versions(self) -> list[int]:
        found = self.fs.listStatus(self._path(f"{self.root}/versions"))
        names = [f.getPath().getName() for f in found]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def load(self, version: int) -> dict:
        stream = self.fs.open(self._path(f"{self.root}/versions/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self, before_ms: int | None = None) -> dict:
        """The newest version, or the newest not after ``before_ms``."""
        for v in reversed(self.versions()):
            found = self.load(v)
            if before_ms is None or found["at_ms"] <= before_ms:
                return found
        return {"version": 0, "at_ms": 0, "catalog": Catalog().dumps(), "folders": {}, "streams": {}}

    def publish(self, base: int, catalog: Catalog, folders: dict[str, list[dict]], streams: dict[str, int]) -> int:
        """Makes version ``base`` + 1; an error if another session made it first.

        The rename fails if the version exists; the file system must do that in one step (HDFS does).
        """
        version = base + 1
        body = json.dumps({"version": version, "at_ms": int(time.time() * 1000), "catalog": catalog.dumps(), "folders": folders, "streams": streams})
        staged = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        out = self.fs.create(staged, False)
        out.write(bytearray(body.encode()))
        out.close()
        target = self._path(f"{self.root}/versions/{version:012d}.json")
        jvm = self.spark._jvm
        never = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        how = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        how[0] = never
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark._jsc.hadoopConfiguration()).rename(staged, target, how)
        except Py4JJavaError as e:
            self.fs.delete(staged, False)
            if not self.fs.exists(target):
                raise
            raise EngineError("another session has committed meanwhile; nothing was published") from e
        return version

    # -- data

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> dict:
        """A new folder with ``df``; its entry for the version file."""
        path = f"{self.root}/data/{name}/_part={uuid.uuid4().hex}"
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
        return {"path": path, "columns": [c for c in df.columns if c != partition_by]}

    def delete(self, folders: list[dict]) -> None:
        """Deletes folders that no version names."""
        for f in folders:
            self.fs.delete(self._path(f["path"]), True)

    def read(self, table: Table, folders: list[dict], only: Column | None = None) -> DataFrame:
        """The table's rows; a column added after a folder was written has its default there.

        only: a condition on the folders' partition column.
        """
        if not folders:
            return self.spark.createDataFrame([], table.schema())
        by_columns: dict[tuple, list[str]] = {}
        for f in folders:
            by_columns.setdefault(tuple(c.lower() for c in f["columns"]), []).append(f["path"])
        return reduce(DataFrame.unionByName, [self._one(table, set(cols), paths, only) for cols, paths in by_columns.items()])

    def _one(self, table: Table, have: set[str], paths: list[str], only: Column | None) -> DataFrame:
        stored = [c for c in table.columns if c.name.lower() in have]
        df = self._reader(", ".join(f"`{c.name}` {c.type}" for c in stored), paths).parquet(*paths)
        if only is not None:
            df = df.filter(only)
        return df.select(*(F.col(f"`{c.name}`") if c.name.lower() in have else default(c).alias(c.name) for c in table.columns))

    def read_parts(self, schema: str, folders: list[dict]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f["path"] for f in folders]
        names = [f.name for f in self.spark.createDataFrame([], schema).schema.fields]
        return self._reader(schema, paths).parquet(*paths).select(*(F.col(f"`{n}`") for n in names))

    def _reader(self, schema: str, paths: list[str]):
        return self.spark.read.schema(schema).option("basePath", paths[0].rpartition("/")[0])


def default(c: TableColumn):
    value = c.default
    if isinstance(value, str) and c.type == "binary":
        value = value.encode()
    return F.lit(value if value is None or not c.type.startswith(("timestamp", "decimal")) else str(value)).cast(c.type)
