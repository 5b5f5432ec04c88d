"""Removal of repeated byte strings by difference-cover suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus, in the same document or another.

1. Equal texts become one text with a count; all of a text of at least
   ``length`` bytes that occurs twice goes, and one copy stays in the search.
2. Each string of ``length`` bytes (a window) belongs to the smallest hash of its
   ``gram``-byte substrings (its anchor): equal windows belong to equal anchors.
   Windows side by side with one anchor are a context; an anchor with one context
   that holds it once owns no repeated window, so only the contexts of the others
   go on: this loses nothing.
3. Contexts are dealt by anchor hash, equal ones at most twice, and the
   suffixes of the contexts of a group of anchors are sorted with a difference
   cover modulo 3: suffixes at places 1 and 2 modulo 3 are sorted by triples,
   the triples' names are sorted recursively until they stand for ``length``
   bytes, and the suffixes at places 0 are merged in.  Neighbours in this order
   are compared on their first ``length`` bytes: equal neighbours are repeats.
   The suffixes of an anchor with more than ``crowd`` bytes of distinct contexts
   are not sorted in one task: its windows are grouped by hash in Spark, exactly.
4. Runs of bytes under a context's repeated windows are merged by text.

Defined cases: null text is empty; texts under ``length`` bytes lose nothing;
a repeated row is another place where its strings start; very long texts are
taken whole, those of one repeated letter included; an empty table gives an
empty result; other columns are carried along, and a new column whose name is
taken gets ``_`` in front.  128-bit hashes stand for texts and contexts, and for
windows in crowds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, blocks, bucketed, free_names, mix, sliding, tidy, written

LENGTH, GRAM, CROWD, CHUNK = 200, 64, 8_000_000, 1_500_000
#: Windows of a context at most, where the same smallest substring stands in it more than once.
STRETCH = 2048


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window, whether it stands there more than once) of the anchors of one text of at least ``length`` bytes."""
    h = (data.astype(U64) + U64(1)) * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    size, base = 1, 0x9E3779B97F4A7C15
    done, at = None, 0  # hash of the first ``at`` bytes of the gram, and its width
    width = gram
    while True:
        if width & 1:
            done = h if done is None else done[: len(h) - at] * U64(pow(base, size, 1 << 64)) + h[at:]
            at += size
        width >>= 1
        if not width:
            break
        h = h[:-size] * U64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    g = mix(done)
    n = length - gram + 1
    low = sliding(np.minimum, g, n)
    # the leftmost place of the minimum moves only forward: a new one begins where the value changes, or where the place has left the window
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(low) - 1]])
    starts, ends, many = [], [], []
    edge = np.zeros(n - 1, U64)
    least = sliding(np.maximum, np.concatenate([edge, low, edge]), n)
    if np.count_nonzero(g == least) == len(first):  # each run has one place
        return low[first], first, last, np.zeros(len(first), bool)
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a < n and np.count_nonzero(g[a : b + n] == low[a]) == 1:
            starts.append(a)
            ends.append(b)
            many.append(False)
            continue
        # the substring repeats nearby: its windows stay together, so that a text of one letter has no context a place
        starts += range(a, b + 1, STRETCH)
        ends += [min(x + STRETCH - 1, b) for x in range(a, b + 1, STRETCH)]
        many += [True] * (len(starts) - len(many))
    starts_ = np.array(starts, np.int64)
    return low[starts_], starts_, np.array(ends, np.int64), np.array(many, bool)


def _anchors(length: int, gram: int):
    schema = pa.schema([("fp", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("run", pa.int64()), ("times", pa.int64())])

    def run(batches):
        for batch in batches:
            for rows, data, offs in blocks(batch, "text"):
                t1, t2 = (rows.column(c).to_numpy() for c in ("t1", "t2"))
                out = []
                for i in range(rows.num_rows):
                    h, lo, hi, many = anchors(data[offs[i] : offs[i + 1]], length, gram)
                    out.append((h.view(np.int64), np.full(len(h), t1[i]), np.full(len(h), t2[i]), lo << 31 | hi, 1 + many.astype(np.int64)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)

    return run


def _contexts(length: int):
    schema = pa.schema([("fp", pa.int64()), ("ctx", pa.binary()), ("c", pa.binary()), ("t1", pa.int64()), ("t2", pa.int64()), ("lo", pa.int64())])

    def run(batches):
        for batch in batches:
            for rows, data, offs in blocks(batch, "text"):
                out = []
                for i, (t1, t2, at) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("t1", "t2", "at")), strict=True)):
                    text = data[offs[i] : offs[i + 1]].tobytes()
                    for x in at:
                        lo, hi = x["run"] >> 31, x["run"] & 0x7FFFFFFF
                        ctx = text[lo : hi + length]
                        out.append((x["fp"], ctx, hashlib.blake2b(ctx, digest_size=16).digest(), t1, t2, lo))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _names(a: np.ndarray, b: np.ndarray, c: np.ndarray, letters: int) -> tuple[np.ndarray, int]:
    """Ranks (from 1) of triples of letters below ``letters``, equal for equal triples; and the largest."""
    if letters**3 <= 1 << 24:
        key = (a * letters + b) * letters + c
        seen = np.zeros(letters**3 + 1, bool)
        seen[key] = True
        rank = np.cumsum(seen)
        return rank[key], int(rank[-1])
    if letters < 1 << 21:
        key = a << 42 | b << 21 | c
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort((c, b, a))
        x, y, z = a[order], b[order], c[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])])
    rank = np.cumsum(new)
    out = np.empty(len(a), np.int64)
    out[order] = rank
    return out, int(rank[-1])


def suffix_order(x: np.ndarray, letters: int, length: int) -> np.ndarray:
    """Places of ``x`` (letters from 1, below ``letters``) in the order of their suffixes; suffixes that agree on
    ``length`` letters stand together, in any order."""
    n = len(x)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: x[i:].tolist()), np.int64)
    p = np.concatenate([x, np.zeros(4, np.int64)])
    one, two, zero = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    names, most = _names(p[sample], p[sample + 1], p[sample + 2], letters)
    rank = np.zeros(n + 4, np.int64)
    if most == len(sample) or length <= 3:
        by = np.argsort(names, kind="stable")
        rank[sample] = names
    else:
        by = suffix_order(names, most + 1, -(-length // 3))
        rank[sample[by]] = np.arange(1, len(sample) + 1)
    sample = sample[by]
    sample = sample[sample < n]
    big = n + 4
    zero = zero[np.argsort(p[zero] * big + rank[zero + 1], kind="stable")]
    from1 = sample % 3 == 1
    s1, s2 = sample[from1], sample[~from1]
    before = np.searchsorted(np.maximum.accumulate(p[s1] * big + rank[s1 + 1]), p[zero] * big + rank[zero + 1])
    if letters * letters < (1 << 62) // big:
        k2, k0 = (p[s2] * letters + p[s2 + 1]) * big + rank[s2 + 2], (p[zero] * letters + p[zero + 1]) * big + rank[zero + 2]
    else:  # pairs of letters by rank, so that the key fits
        pair, _ = _names(np.concatenate([p[s2], p[zero]]), np.concatenate([p[s2 + 1], p[zero + 1]]), np.zeros(len(s2) + len(zero), np.int64), letters)
        k2, k0 = pair[: len(s2)] * big + rank[s2 + 2], pair[len(s2) :] * big + rank[zero + 2]
    before = np.maximum.accumulate(before + np.searchsorted(np.maximum.accumulate(k2), k0))
    out = np.empty(n, np.int64)
    at = before + np.arange(len(zero))
    out[at] = zero
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = sample
    return out


def repeated(contexts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each context, the runs of its bytes under windows that another place in ``contexts`` holds too."""
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    text = np.frombuffer(b"".join(contexts), np.uint8)
    first = np.cumsum(size) - size
    order = suffix_order(text.astype(np.int64) + 1, 257, length)
    room = np.repeat(first + size, size) - np.arange(len(text)) >= length
    order = order[room[order]]
    width = min(8, length)
    packed = np.zeros(len(text) + 1, U64)  # the bytes at a place and after it, as one number
    for k in range(width):
        packed[: len(text) - k] |= text[k:].astype(U64) << U64(8 * k)
    same = np.arange(max(0, len(order) - 1))
    for at in [*range(0, length - width + 1, width), *([length - width] if length % width else [])]:
        same = same[packed[order[same] + at] == packed[order[same + 1] + at]]
    twice = np.zeros(len(text), bool)
    twice[order[same]] = True
    twice[order[same + 1]] = True
    hits = np.flatnonzero(twice)
    owner = np.searchsorted(first, hits, "right") - 1
    # a run ends where the next window begins past the end of this one, or in another context
    ends = np.flatnonzero(np.concatenate([(hits[1:] - hits[:-1] > length) | (owner[1:] != owner[:-1]), [True]])) if len(hits) else hits
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    begin = 0
    for e, c in zip(ends.tolist(), owner[ends].tolist(), strict=True):
        out[c].append((int(hits[begin] - first[c]), int(hits[e] - first[c]) + length))
        begin = e + 1
    return out


def _sorted(length: int, chunk: int):
    """(fp, c, ctx, n) sorted by fp -> (c, start, end) of the repeated run of each context."""
    schema = pa.schema([("c", pa.binary()), ("a", pa.int64()), ("b", pa.int64())])

    def work(rows):
        if not rows:
            return
        # a context that occurs more than once is sorted twice: its own windows are then each other's neighbours
        found = repeated([r[2] for r in rows] + [r[2] for r in rows if r[3] > 1], length)
        out = [(c, a, b) for (_, c, _, _), hit in zip(rows, found, strict=False) for a, b in hit]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if size >= chunk and row[0] != rows[-1][0]:
                    yield from work(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2]) * (1 + (row[3] > 1))
        yield from work(rows)

    return run


def _windows(length: int):
    schema = pa.schema([("w", pa.binary()), ("c", pa.binary()), ("at", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for _, c, ctx, n in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                out += [(hashlib.blake2b(ctx[i : i + length], digest_size=16).digest(), c, i, n) for i in range(len(ctx) - length + 1)]
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut():
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part, out = batch.slice(i, 500), []
                for t1, t2, text, copies, runs in zip(*(part.column(c).to_pylist() for c in ("t1", "t2", "text", "copies", "runs")), strict=True):
                    spans = [(0, len(text))] if copies > 1 else merged([(r["a"], r["b"]) for r in runs or []])
                    if spans:
                        edges = [0, *(e for s in spans for e in s), len(text)]
                        kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                        out.append((t1, t2, [{"a": a, "b": b} for a, b in spans], kept))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def find_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the two columns that name its text (the last two), and a row for each text that loses bytes:
    sd_c1, sd_c2 (the text's name), sd_spans (byte spans a, b) and sd_left (the other bytes)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    k1, k2 = free_names(docs, "sd_t1", "sd_t2")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    digest = F.md5(body)
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    marked = docs.withColumns({k1: half(1), k2: half(16)})
    texts = marked.filter(F.octet_length(text_col) >= length).select(F.col(k1).alias("t1"), F.col(k2).alias("t2"), body.alias("text"))
    texts = texts.groupBy("t1", "t2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = spark.table(bucketed(texts.repartition(n, "t1", "t2"), "suffix_dedup", n, "t1", "t2"))
    found = texts.select("t1", "t2", "text").mapInArrow(tidy(_anchors(length, gram)), "fp long, t1 long, t2 long, run long, times long")
    found = written(found, "anchors")
    shared = written(found.groupBy("fp").agg(F.sum("times").alias("n")).filter("n > 1").select("fp"), "shared")  # a table: Spark can then split a hot anchor's side of the join
    mine = found.join(shared, "fp").groupBy("t1", "t2").agg(F.collect_list(F.struct("fp", "run")).alias("at"))
    near = texts.select("t1", "t2", "text").join(mine, ["t1", "t2"]).mapInArrow(_contexts(length), "fp long, ctx binary, c binary, t1 long, t2 long, lo long")
    near = written(near, "contexts")
    once = near.groupBy("fp", "c").agg(F.first("ctx").alias("ctx"), F.count("*").alias("n"))
    crowded = near.select("fp", "c", F.octet_length("ctx").alias("k")).distinct().groupBy("fp").agg(F.sum("k").alias("m")).filter(F.col("m") > crowd)
    if crowded.isEmpty():
        few, runs = once, None
    else:
        crowded = written(crowded.select("fp"), "crowded")
        few = once.join(crowded, "fp", "left_anti")
        win = written(once.join(crowded, "fp").select("fp", "c", "ctx", "n").mapInArrow(_windows(length), "w binary, c binary, at long, n long"), "windows")
        twice = win.groupBy("w").agg(F.sum("n").alias("s")).filter("s > 1").select("w")
        # windows that begin within ``length`` bytes of each other cover one run
        runs = win.join(twice, "w").groupBy("c", F.floor(F.col("at") / length)).agg(F.min("at").alias("a"), (F.max("at") + length).alias("b")).select("c", "a", "b")
    sorted_ = few.select("fp", "c", "ctx", "n").repartition(n, "fp").sortWithinPartitions("fp", "c").mapInArrow(tidy(_sorted(length, chunk)), "c binary, a long, b long")
    runs = written(sorted_ if runs is None else sorted_.union(runs), "runs")
    lost = near.select("c", "t1", "t2", "lo").join(runs, "c").groupBy("t1", "t2").agg(F.collect_list(F.struct((F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b"))).alias("runs"))
    changed = texts.join(lost, ["t1", "t2"], "left").filter((F.col("copies") > 1) | F.col("runs").isNotNull()).mapInArrow(_cut(), "t1 long, t2 long, spans array<struct<a:long,b:long>>, kept binary")
    changed = changed.select(F.col("t1").alias("sd_c1"), F.col("t2").alias("sd_c2"), F.col("spans").alias("sd_spans"), F.col("kept").alias("sd_left"))
    return marked, changed


def remove_repeats(docs: DataFrame, text_col: str = "text", **args) -> DataFrame:
    """``docs`` with removed (array of byte spans a, b) and kept (the other bytes); arguments as find_repeats."""
    removed, kept = free_names(docs, "removed", "kept")
    marked, changed = find_repeats(docs, text_col, **args)
    k1, k2 = marked.columns[-2:]
    out = marked.join(changed, (marked[k1] == changed["sd_c1"]) & (marked[k2] == changed["sd_c2"]), "left")
    spans = F.coalesce(F.col("sd_spans"), F.array().cast("array<struct<a:bigint,b:bigint>>"))
    out = out.withColumns({removed: spans, kept: F.coalesce(F.col("sd_left"), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))})
    return out.drop(k1, k2, "sd_c1", "sd_c2", "sd_spans", "sd_left")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked, changed = find_repeats(docs)
    text = F.coalesce("text", F.lit("")).cast("binary")
    marked = marked.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"), "sd_t1", "sd_t2")
    gone = F.aggregate("sd_spans", F.lit(0).cast("bigint"), lambda s, x: s + x["b"] - x["a"])
    changed = changed.select("sd_c1", "sd_c2", gone.alias("gone"), F.size("sd_spans").cast("long").alias("spans"), F.sha2("sd_left", 256).alias("left"))
    out = marked.join(changed, (F.col("sd_t1") == F.col("sd_c1")) & (F.col("sd_t2") == F.col("sd_c2")), "left")
    return out.select("doc_id", "n_bytes", F.coalesce("gone", F.lit(0)).alias("n_removed"), F.coalesce("spans", F.lit(0)).alias("n_spans"), F.coalesce("left", "whole").alias("kept_sha256"))
