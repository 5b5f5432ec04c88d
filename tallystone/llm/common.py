"""Helpers shared by the training-data operators.

Text arrives in the Python workers as Arrow batches.  ``blocks`` cuts a batch
into runs of whole rows of a bounded number of bytes, so that numpy's
eight-byte temporaries stay small however many rows Spark puts in one batch; a
single row longer than the bound forms a block of its own.
"""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Executors get the functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

U64 = np.uint64
BLOCK_BYTES = 2_000_000


_SCRATCH: dict[str, tuple[SparkSession, str, list[str]]] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the checkpoint folder that the session names; it is deleted when the program ends.

    Without a checkpoint folder a local run gets a temporary one; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SCRATCH:
        base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="tallystone-")
            atexit.register(shutil.rmtree, base, True)
            sc.setCheckpointDir(base)
        _SCRATCH[sc.applicationId] = (spark, f"{base.rstrip('/')}/tallystone-{uuid.uuid4().hex}", [])
        atexit.register(clean, sc.applicationId)
    return _SCRATCH[sc.applicationId][1]


def clean(application: str) -> None:
    """Deletes what an application has written to its folder, and its catalog tables; nothing if its session has ended."""
    spark, path, tables = _SCRATCH.pop(application, (None, None, []))
    if spark is None or spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{t}`")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, what: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and outlives executors."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, what: str, buckets: int, *by: str) -> str:
    """Name of a catalog table with ``df``, bucketed and sorted by ``by``, in the shared folder."""
    spark, name = df.sparkSession, f"{what}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    _SCRATCH[spark.sparkContext.applicationId][2].append(name)
    df.write.bucketBy(buckets, *by).sortBy(*by).format("parquet").option("path", path).saveAsTable(name)
    return name


def keep_heap() -> None:
    """In a Python worker: freed arrays of up to 32 MB are used again, in place of pages that must be mapped anew."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD


def give_back() -> None:
    """In a Python worker, at the end of a task: free memory goes back to the system, as an idle worker stays alive."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run):
    """A function of batches that gives memory back when it ends."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and its offsets; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of runs of whole rows with about ``limit`` bytes of text."""
    data, offs = raw(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> U64(31))) * U64(0x7FB5D329728EA185)
    h = (h ^ (h >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


#: Words longer than this are hashed by a digest.
LONG_WORD = 4096


class Words:
    """Words of a block of texts: runs of the bytes that ``table`` maps to a non-zero value, which replaces them."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        self.low = low = table[data]
        n = len(low)
        inside = low != 0
        first = np.zeros(n + 1, bool)
        first[offs] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | first[:n]))
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | first[1:])) + 1
        #: words of row i: per_row[i] to per_row[i + 1]
        self.per_row = np.searchsorted(self.start, offs)

    def hashes(self) -> np.ndarray:
        """64-bit hashes, which stand for the words: eight bytes at a time go through a mixing that has no linear structure."""
        size = self.end - self.start
        eight = np.ndarray(len(self.low) + 1, "<u8", np.concatenate([self.low, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))  # the eight bytes from each place on
        left = np.minimum(size, 8).astype(U64) * U64(8)
        h = mix((eight[self.start] << (U64(64) - left) >> (U64(64) - left)) + size.astype(U64) * U64(0x9E3779B97F4A7C15))
        more, at = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
        while len(more):
            left = np.minimum(size[more] - at, 8).astype(U64) * U64(8)
            x = eight[self.start[more] + at] << (U64(64) - left) >> (U64(64) - left)
            h[more] = mix((h[more] ^ x) + U64(0xD6E8FEB86659FD93))
            at += 8
            more = more[size[more] > at]
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8).digest(), "little")
        return h

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def letters_table() -> np.ndarray:
    """Digits, letters (A-Z as a-z) and every byte of a character past ASCII; the rest separates."""
    t = np.zeros(256, np.uint8)
    t[0x30:0x3A] = np.arange(0x30, 0x3A)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


def spaces_table(lower: bool = True) -> np.ndarray:
    """All bytes but ASCII white space (and NUL, which becomes 0xFF, a byte that no UTF-8 text holds)."""
    t = np.arange(256).astype(np.uint8)
    t[0] = 0xFF
    if lower:
        t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x20] = 0
    t[0x09:0x0E] = 0
    return t


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive entries."""
    n = max(0, len(h) - k + 1)
    acc = np.zeros(n, U64)
    for j in range(k):
        acc = acc * U64(0xA0761D6478BD642F) + h[j : j + n]
    return mix(acc)


def sliding(f, x: np.ndarray, w: int) -> np.ndarray:
    """``f`` (minimum or maximum) over each ``w`` consecutive entries."""
    if len(x) < w:
        return x[:0]
    size = 1
    while size * 2 <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[: len(x) - (w - size)], x[w - size :]) if size < w else x
