"""Benchmark decontamination by winnowing.

Words are hashed and combined to 7-grams; of the seven 7-grams in each window
of 13 words the smallest hash is kept, on both sides, so any 13 words shared
with a benchmark item share a kept fingerprint.  Fingerprints of a text are
joined with those of the benchmark, and each hit is extended: all windows that
hold the 7-gram are compared word by word with the benchmark's windows, so the
result is exact.  Items of fewer than 13 words are one window and are matched
by the hash of all their words, then compared the same way.

A benchmark of at most ``part_bytes`` bytes of item text is broadcast, and each
document is matched in one narrow pass (its row never shuffles).  A larger one
stays a table: of its fingerprints, only which of 2^24 places they fall on is
broadcast, documents keep the windows whose fingerprint falls on such a place,
and those are joined with the benchmark's windows by their words.

Defined cases: null or wordless texts have no words and no hits; wordless items
are no window; equal item ids are one item and a null item id is written as
``null``; an empty benchmark hits nothing; of equal fingerprints in a window all
are kept; very long texts are taken whole; repeated rows are told each; an empty
table gives no row; other columns are carried along, and a new column whose name
is taken gets ``_`` in front.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, Words, blocks, free_names, grams, letters_table, sliding, written

WINDOW, GRAM = 13, 7
SPAN = WINDOW - GRAM + 1
LAST = U64(0xFFFFFFFFFFFFFFFF)
#: Bits of a fingerprint that do not tell its place.
PLACE_SHIFT = 40


def kept_grams(h: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Places of the 7-grams that are the smallest of some window of a row; h: hashes of words, per_row: rows' offsets."""
    g = grams(h, GRAM)
    for j in range(1, GRAM):  # 7-grams that cross rows
        cross = per_row[1:-1] - j
        g[cross[(cross >= 0) & (cross < len(g))]] = LAST
    low = sliding(np.minimum, g, SPAN)
    if not len(low):
        return np.zeros(0, np.int64)
    most = sliding(np.maximum, np.concatenate([np.zeros(SPAN - 1, U64), low, np.zeros(SPAN - 1, U64)]), SPAN)
    return np.flatnonzero((g == most) & (g != LAST))


class Benchmark:
    """One part of the benchmark: window -> item ids, and the fingerprints by which windows are found."""

    def __init__(self, items: list[tuple[str, str]]):
        self.windows: dict[tuple[bytes, ...], set[str]] = {}
        finger: dict[int, list[np.ndarray]] = {}
        table = letters_table()
        for id_, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            w = Words(data, np.array([0, len(data)]), table)
            n = len(w.start)
            if not n:
                continue
            words, size = [w.word(i) for i in range(n)], min(n, WINDOW)
            for i in range(n - size + 1):
                self.windows.setdefault(tuple(words[i : i + size]), set()).add(id_)
            h = w.hashes()
            g = grams(h, GRAM)[kept_grams(h, w.per_row)] if size == WINDOW else grams(h, size)
            finger.setdefault(size, []).append(g)
        self.finger = {k: np.unique(np.concatenate(v)) for k, v in finger.items()}

    def among(self, size: int, g: np.ndarray) -> np.ndarray:
        mine = self.finger[size]
        at = np.searchsorted(mine, g)
        at[at == len(mine)] = 0
        return mine[at] == g

    def hits(self, w: Words, h: np.ndarray) -> dict[int, tuple[set[int], set[str]]]:
        """Row -> (places of hit words in the block, ids of the items)."""
        found: dict[int, tuple[set[int], set[str]]] = {}
        for size in self.finger:
            if size == WINDOW:
                at = kept_grams(h, w.per_row)
                at = at[self.among(size, grams(h, GRAM)[at])]
                starts = (at[:, None] - np.arange(SPAN)[None, :]).ravel()
            else:
                starts = np.flatnonzero(self.among(size, grams(h, size)))
            starts = np.unique(starts[starts >= 0])
            rows = np.searchsorted(w.per_row, starts, "right") - 1
            fits = starts + size <= w.per_row[rows + 1]
            last, words = (-1, -1), []
            for s, r in zip(starts[fits].tolist(), rows[fits].tolist(), strict=True):
                words = [*words[1:], w.word(s + size - 1)] if last == (s - 1, r) else [w.word(i) for i in range(s, s + size)]
                last = (s, r)
                if (ids := self.windows.get(tuple(words))) is not None:
                    places, items = found.setdefault(r, (set(), set()))
                    places.update(range(s, s + size))
                    items |= ids
        return found


def _match(part, text: str, schema: pa.Schema):
    """Adds n_words, places of hit words, and item ids."""

    def run(batches):
        table, mine = letters_table(), Benchmark(part.value)
        for batch in batches:
            for rows, data, offs in blocks(batch, text):
                w = Words(data, offs, table)
                found = mine.hits(w, w.hashes())
                hit, ids = [[] for _ in range(rows.num_rows)], [[] for _ in range(rows.num_rows)]
                for r, (places, names) in found.items():
                    hit[r] = sorted(p - int(w.per_row[r]) for p in places)
                    ids[r] = sorted(names)
                new = [np.diff(w.per_row), hit, ids]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), *(pa.array(x, f.type) for x, f in zip(new, list(schema)[-3:], strict=True))], schema=schema)

    return run


def _fingerprints(h: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of the window of ``size`` words at each place: its smallest 7-gram, or the hash of a short item."""
    return sliding(np.minimum, grams(h, GRAM), SPAN) if size == WINDOW else grams(h, size)


def _item_windows():
    """(id, t) -> the windows of items: fingerprint, number of words, words with NUL between, id."""
    schema = pa.schema([("fp", pa.int64()), ("size", pa.int32()), ("words", pa.binary()), ("item", pa.string())])

    def run(batches):
        table = letters_table()
        for batch in batches:
            for rows, data, offs in blocks(batch, "t"):
                w, out = Words(data, offs, table), []
                h = w.hashes()
                for id_, a, b in zip(rows.column(0).to_pylist(), w.per_row[:-1].tolist(), w.per_row[1:].tolist(), strict=True):
                    size = min(b - a, WINDOW)
                    if size:
                        words = [w.word(i) for i in range(a, b)]
                        out += [(int(fp), size, b"\0".join(words[i : i + size]), id_) for i, fp in enumerate(_fingerprints(h[a:b], size).view(np.int64).tolist())]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _candidates(filter_, text: str, schema: pa.Schema):
    """Adds n_words and the windows (at, words) whose fingerprint falls on a place of the benchmark's."""

    def run(batches):
        table, (places, sizes) = letters_table(), filter_.value
        for batch in batches:
            for rows, data, offs in blocks(batch, text):
                w = Words(data, offs, table)
                h, found = w.hashes(), [[] for _ in range(rows.num_rows)]
                for size in sizes:
                    at = np.flatnonzero(places[_fingerprints(h, size) >> U64(PLACE_SHIFT)])
                    row = np.searchsorted(w.per_row, at, "right") - 1
                    fits = at + size <= w.per_row[row + 1]
                    for s, r in zip(at[fits].tolist(), row[fits].tolist(), strict=True):
                        found[r].append({"at": s - int(w.per_row[r]), "words": b"\0".join(w.word(i) for i in range(s, s + size))})
                new = [np.diff(w.per_row), found]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), *(pa.array(x, f.type) for x, f in zip(new, list(schema)[-2:], strict=True))], schema=schema)

    return run


def _joined(docs: DataFrame, bench: DataFrame, text_col: str, names: tuple[str, str, str]) -> DataFrame:
    """``docs`` with the columns ``names``: number of words, places of hit words, and item ids, by joins."""
    spark, (n_words, hit, items) = docs.sparkSession, names
    windows = written(bench.mapInArrow(_item_windows(), "fp long, size int, words binary, item string"), "windows")
    places = np.zeros(1 << (64 - PLACE_SHIFT), bool)
    places[windows.select(F.shiftrightunsigned("fp", PLACE_SHIFT).cast("int").alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)] = True  # 2^24 at most
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # 13 at most
    k1, k2, found = free_names(docs.select("*", *(F.lit(0).alias(n) for n in names)), "dc_k1", "dc_k2", "dc_found")
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    marked = docs.withColumns({k1: half(1), k2: half(16)})
    schema = T.StructType([*marked.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(found, T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("words", T.BinaryType())])))])
    marked = written(marked.mapInArrow(_candidates(spark.sparkContext.broadcast((places, sizes)), text_col, to_arrow_schema(schema)), schema), "candidates")
    # by text: copies have the same hits
    asked = marked.filter(F.size(found) > 0).select(F.col(k1).alias("t1"), F.col(k2).alias("t2"), F.explode(found).alias("c")).select("t1", "t2", "c.at", "c.words").distinct()
    met = asked.join(windows.select("words", "size", "item").distinct(), "words")
    spans = F.transform("spans", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1))
    hits = met.groupBy("t1", "t2").agg(F.collect_set(F.struct("at", "size")).alias("spans"), F.sort_array(F.collect_set("item")).alias("ids"))
    hits = hits.select("t1", "t2", F.sort_array(F.array_distinct(F.flatten(spans))).alias("hits"), "ids")
    out = marked.join(hits, (marked[k1] == hits["t1"]) & (marked[k2] == hits["t2"]), "left")
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(f"array<{kind}>"))
    return out.select(*(marked[c] for c in docs.columns), marked[n_words], none("hits", "int").alias(hit), none("ids", "string").alias(items))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: int = 20, part_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` with n_words, hit_words (places of hit words), items (ids as strings, sorted) and contaminated.

    contaminated: some word is hit, and hit words are at least one in ``share``.
    """
    spark = docs.sparkSession
    n_words, hit, items, bad = free_names(docs, "n_words", "hit_words", "items", "contaminated")
    bench = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("id"), F.col(item_text_col).alias("t")).filter("t is not null")
    size = bench.agg(F.sum(F.octet_length("t") + F.octet_length("id"))).first()[0] or 0
    if size <= part_bytes:
        schema = T.StructType([*docs.schema.fields, T.StructField(n_words, T.LongType()), T.StructField(hit, T.ArrayType(T.IntegerType())), T.StructField(items, T.ArrayType(T.StringType()))])
        part = spark.sparkContext.broadcast([(r["id"], r["t"]) for r in bench.collect()])  # part_bytes at most
        out = docs.mapInArrow(_match(part, text_col, to_arrow_schema(schema)), schema)
    else:
        out = _joined(docs, bench, text_col, (n_words, hit, items))
    return out.withColumn(bad, (F.size(hit) > 0) & (F.size(hit) * share >= F.col(n_words)))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 13) AS m, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS g FROM bw),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, w, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT doc_id, dw.m, i, item_id FROM dw JOIN win ON win.m = dw.m AND win.g = array_to_string(dw.w[dw.i : dw.i + dw.m - 1], ' ')),
places AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit),
hits AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids.s, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
