"""Media columns: bytes kept as WAV audio, and spectral-peak fingerprints of it.

``to_wav`` stores a text's UTF-8 bytes, padded with 255 to a positive multiple
of 576, as 8-bit mono samples in a WAV file held in a binary column.
``wav_features`` opens the stored file with the wave module, cuts it in frames,
takes a windowed Fourier transform of each (the last is filled up with
silence, so that every sample lies in a frame), keeps the strongest local maxima
of each frame's spectrum as peaks, and pairs each peak with those of the next
frames.  A pair is kept as (frame << 32 | bin << 20 | later bin << 8 | frames
between): an array coded by time.  Power is rounded to whole numbers.  Frames are
transformed in slabs, so that memory stays bounded for very long files.

Defined cases: null or empty text is 576 bytes of 255; of equally strong peaks
the lower bin goes first, and of a flat top the first bin is the maximum; a frame
with fewer maxima has fewer peaks (silence has none), and a file of one frame
has no pairs; equal texts give equal files and features, so repeated rows do; a
very long text is one file; an empty table gives no row; a new column whose name
is taken gets ``_`` in front.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import free_names

UNIT, RATE, FRAME, HOP, PEAKS, REACH, SLAB = 576, 8000, 256, 160, 2, 2, 2048
_WINDOW = np.hanning(FRAME).astype(np.float32)


def encode(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def decode(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % UNIT if text else UNIT)


def filled(samples: bytes) -> bytes:
    """Samples with silence up to the end of the frame that holds the last."""
    rest = max(0, len(samples) - FRAME) % HOP
    return samples + b"\x80" * (HOP - rest) if rest else samples


def pairs(samples: bytes) -> np.ndarray:
    """Fingerprint pairs of 8-bit samples, as 64-bit codes in order of time."""
    x = np.frombuffer(samples, np.uint8)
    frames = 1 + max(0, len(x) - FRAME) // HOP
    peaks = np.empty((frames, PEAKS), np.int64)  # by strength; -1: none
    for at in range(0, frames, SLAB):
        n = min(SLAB, frames - at)
        part = x[at * HOP : (at + n - 1) * HOP + FRAME].astype(np.float32) - 128
        cut = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP] * _WINDOW
        power = np.zeros((n, FRAME // 2 + 2), np.int32)  # no power on both sides of the bins from 1
        power[:, 1:-1] = np.rint(np.abs(np.fft.rfft(cut, axis=1)[:, 1:]))
        top = (power[:, 1:-1] > power[:, :-2]) & (power[:, 1:-1] >= power[:, 2:])
        key = np.where(top, power[:, 1:-1].astype(np.int64) << 8 | (255 - np.arange(FRAME // 2)), -1)  # bin 1 is number 0
        best = -np.partition(-key, PEAKS - 1, axis=1)[:, :PEAKS]
        peaks[at : at + n] = np.where(best >= 0, 255 - (best & 255), -1)
    out = []
    for gap in range(1, min(REACH, frames - 1) + 1):
        a, b = peaks[:-gap, :, None], peaks[gap:, None, :]
        code = np.arange(frames - gap)[:, None, None] << 32 | a << 20 | b << 8 | gap
        out.append(code[(a >= 0) & (b >= 0)])
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _store(text: str, schema: pa.Schema, media: str):
    def run(batches):
        for batch in batches:
            t = batch.column(batch.schema.get_field_index(text))
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                made = pa.array([encode(padded((x.as_py() or "").encode())) for x in t.slice(i, 256)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(part.columns, schema, strict=False)), made], schema=schema)

    return run


def to_wav(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """``docs`` with a binary column of WAV files."""
    (media,) = free_names(docs, media_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(media, T.BinaryType())])
    return docs.mapInArrow(_store(text_col, to_arrow_schema(schema), media), schema)


NEW = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("fingerprint", T.ArrayType(T.LongType()))]


def _read(media: str, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(media))
            for i in range(0, batch.num_rows, 64):
                part, new = batch.slice(i, 64), []
                for x in col.slice(i, 64):
                    m = x.as_py()
                    if m is None:
                        new.append((None,) * len(NEW))
                        continue
                    p = decode(m)
                    new.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), pairs(filled(p))))
                cols = [pa.array(c, schema.field(batch.num_columns + j).type) for j, c in enumerate(zip(*new, strict=True))]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(part.columns, schema, strict=False)), *cols], schema=schema)

    return run


def wav_features(files: DataFrame, media_col: str = "media") -> DataFrame:
    """``files`` with what the stored files hold: size, digests and the fingerprint; all null for a null file."""
    names = free_names(files, *(n for n, _ in NEW))
    schema = T.StructType([*files.schema.fields, *(T.StructField(n, t) for n, (_, t) in zip(names, NEW, strict=True))])
    return files.mapInArrow(_read(media_col, to_arrow_schema(schema)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = wav_features(to_wav(docs).drop("text"))
    feature = F.concat(F.size("fingerprint").cast("string"), F.lit(":"), F.lower(F.hex(F.xxhash64("fingerprint"))))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
