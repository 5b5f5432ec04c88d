"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lowered and taken as code points; n-grams of one to ``max_n``
characters inside a text are hashed to ``bins`` bins.  Training counts bins by
language on the executors and sums them in Spark; the model is a matrix of
``bins`` x languages log probabilities, whose size does not depend on the
number of documents, and is broadcast.  Scoring gathers the rows of a text's
n-grams and adds them up: a sparse matrix product without the zeros.

The classifier is fitted on about ``max_train_rows`` labelled rows at most,
those with the smallest hash of their id; everything else sees all rows.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
without any labelled row every text is ``und``; equal scores go to the
language that sorts first; rows with a null language are not learned from;
repeated rows are learned from and told each; very long texts are taken whole, in
slices that overlap by an n-gram; an empty table gives no row; other columns are
carried along, and a new column whose name is taken gets ``_`` in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, blocks, free_names, mix

BLOCK = 1_000_000
BINS, MAX_N, SMOOTH = 1 << 15, 3, 0.5


def slices(texts: list[str], max_n: int, most: int = BLOCK) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
    """(rows, lowered slices, n-gram starts that are a slice's own): runs of some ``most`` characters of all texts."""
    rows, parts, own, size = [], [], [], 0
    for row, text in enumerate(texts):
        low = text.lower()
        for a in range(0, len(low), most):
            rows.append(row)
            parts.append(low[a : a + most + max_n - 1])
            own.append(min(most, len(low) - a))
            size += own[-1]
            if size >= most:
                yield np.array(rows), parts, np.array(own)
                rows, parts, own, size = [], [], [], 0
    if rows:
        yield np.array(rows), parts, np.array(own)


def bins_of(low: list[str], bins: int, max_n: int, own: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 1.. the bin of the n-gram at each code point (``bins`` where it would leave its text, or is not its own), and the texts' offsets."""
    offs = np.zeros(len(low) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, low), np.int64, len(low)), out=offs[1:])
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    place = np.arange(len(cp))
    room = np.repeat(offs[1:], np.diff(offs)) - place
    if own is not None:
        room[place - np.repeat(offs[:-1], np.diff(offs)) >= np.repeat(own, np.diff(offs))] = 0
    out, h = [], np.zeros(len(cp), U64)
    for n in range(1, max_n + 1):
        h = h[: max(0, len(cp) - n + 1)] * U64(0x9E3779B97F4A7C15) + cp[n - 1 :] + U64(1)
        b = np.full(len(cp), bins, np.int32)
        b[: len(h)] = (mix(h + U64(n)) & U64(bins - 1)).astype(np.int32)
        b[room < n] = bins
        out.append(b)
    return out, offs


def _count(bins: int, max_n: int):
    schema = pa.schema([("lang", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for rows, _, _ in blocks(batch, "text", BLOCK):
                langs = np.array(rows.column(1).to_pylist(), object)
                for lang in set(langs.tolist()):
                    total.setdefault(lang, np.zeros(bins + 1, np.int64))
                    docs[lang] = docs.get(lang, 0) + int((langs == lang).sum())
                for row, parts, own in slices([t or "" for t in rows.column(0).to_pylist()], max_n):
                    found, offs = bins_of(parts, bins, max_n, own)
                    for lang in set(langs[row].tolist()):
                        mine = np.repeat(langs[row] == lang, np.diff(offs))
                        for b in found:
                            total[lang] += np.bincount(b[mine], minlength=bins + 1)
        for lang, here in total.items():
            here[bins] = docs[lang]  # the place of n-grams that leave their text holds the documents
            at = np.flatnonzero(here)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(here[at])], schema=schema)

    return run


def fit(labelled: DataFrame, bins: int = BINS, max_n: int = MAX_N, max_train_rows: int = 20_000) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log probabilities (bins + 1, languages; the last row is 0) and log priors from rows (id, text, lang)."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = rows.count()
    if n > max_train_rows:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(max(1, 1_000_000 * max_train_rows // n)))
    counts = rows.select("text", "lang").mapInArrow(_count(bins, max_n), "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    total = np.zeros((bins + 1, len(langs)))
    where = {x: i for i, x in enumerate(langs)}
    total[counts["bin"].to_numpy(np.int64), counts["lang"].map(where).to_numpy(np.int64)] = counts["n"].to_numpy()
    prior, total = total[bins], total[:bins]
    logp = np.zeros((bins + 1, len(langs)))
    logp[:bins] = np.log(total + SMOOTH) - np.log(total.sum(0) + SMOOTH * bins)
    return langs, logp, np.log(np.maximum(prior, 1) / max(1, prior.sum()))


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def score(texts: list[str], langs: list[str], logp: np.ndarray, prior: np.ndarray, max_n: int) -> tuple[list[str], list[float]]:
    total = np.tile(prior, (len(texts), 1))
    for row, parts, own in slices(texts, max_n):
        found, offs = bins_of(parts, len(logp) - 1, max_n, own)
        for b in found:
            np.add.at(total, row, np.add.reduceat(np.take(logp, b, axis=0), offs[:-1], axis=0))
    best = total.argmax(1)
    p = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    known = [has_letter(t) for t in texts]
    return [langs[i] if k else "und" for i, k in zip(best.tolist(), known, strict=True)], [x if k else 0.0 for x, k in zip(p.tolist(), known, strict=True)]


def _predict(model, max_n: int, text: str, schema: pa.Schema):
    def run(batches):
        langs, logp, prior = model.value
        for batch in batches:
            for rows, _, _ in blocks(batch, text, BLOCK):
                texts = [t or "" for t in rows.column(rows.schema.get_field_index(text)).to_pylist()]
                pred, p = score(texts, langs, logp, prior, max_n) if langs else (["und"] * len(texts), [0.0] * len(texts))
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), pa.array(pred, pa.string()), pa.array(p, pa.float64())], schema=schema)

    return run


def identify(docs: DataFrame, labelled: DataFrame, text_col: str = "text", max_n: int = MAX_N, **fit_args) -> DataFrame:
    """``docs`` with lang_pred and score, learned from ``labelled`` (id, text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled, max_n=max_n, **fit_args))
    names = free_names(docs, "lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(_predict(model, max_n, text_col, to_arrow_schema(schema)), schema)


def held_out(id_col: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)) == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = docs.filter(~held_out("doc_id", 5)).select(F.col("doc_id").alias("id"), "text", "lang")
    return identify(docs.select("doc_id", "text", held_out("doc_id", 5).alias("held_out")), labelled).drop("text")
