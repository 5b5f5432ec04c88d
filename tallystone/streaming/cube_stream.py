"""Keeping a fact and its cubes current from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..catalog import Cube
from ..plans.cubes import _partial
from ..session import Session


def maintain(stream: DataFrame, session: Session, table: str, checkpoint: str) -> DataStreamWriter:
    """A writer that commits each micro-batch to a stored fact and its cubes.

    A batch's number is published with its rows: a batch that is run again after a failure is known by it and changes
    nothing.  Rows whose key is stored already, by this stream or another, are left out; only the stored days that the
    batch touches are looked at.
    """

    def commit(batch: DataFrame, number: int) -> None:
        session.refresh()
        if number <= session.done(checkpoint):
            return
        meta = session.catalog.table(table)
        session.append(table, batch.dropDuplicates(meta.key).join(session.near(meta, batch), meta.key, "left_anti"))
        session.commit(checkpoint, number)

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)


def rollup_stream(stream: DataFrame, cube: Cube, late: str = "1 hour") -> DataFrame:
    """The cube's rows as a streaming aggregate: buckets close ``late`` after the newest time seen.

    Units of days or less; a stream's time column is a TIMESTAMP.
    """
    width = f"1 {cube.unit.lower()}"
    bucket = F.window(cube.time, width)
    out = stream.withWatermark(cube.time, late).groupBy(*cube.dims, bucket.alias("_bucket")).agg(*(_partial(m.func, m.column).alias(m.name) for m in cube.measures))
    return out.select(*cube.dims, F.col("_bucket.start").alias(cube.time), *(m.name for m in cube.measures))
