"""N-gram Jaccard join through a MinHash LSH forest.

A document is the set of its five-word shingles (lower-cased words; fewer than
five words are one shingle).  Documents with equal sets are copies: one class
per set goes on, with its number of copies.  Each of ``trees`` tries holds the
classes by ``deepest`` MinHash values of its own, in order; a class keeps its
whole prefixes.

Prefixes are matched at full length first and shortened from there, for each
class until its target recall: the similarity of two different sets is a
fraction i / (n + m - i) of whole numbers, so the size n of a class's set tells
the lowest similarity at or over the threshold that it can have with another
set, and its depth is the longest at which a pair of that similarity shares a
prefix in some trie with probability ``recall`` or more.  A set that can have no
such neighbour (three shingles at 0.8) is only looked for as a copy.  Two classes
meet at the deeper of their two depths: a class stands in its tries at each
depth that a set of similar size can have.  A trie is a table dealt and sorted
by prefix; classes that agree on a prefix of that depth stand together, and are
candidates.  Candidates are verified exactly on their sets.

No pair becomes a row.
Classes that share a prefix meet in one group, large
groups in blocks of about ``block`` classes against each other; a group counts
each class's links and emits one row a class: links and the smallest class it
is connected to there.  A pair that meets in several tries counts in the first
of them only, which the classes' prefixes tell without asking another group;
a light first pass over prefixes alone tells which classes have a pair that is
new in a trie, and only their sets travel.  Connected components of these rows
are found by alternating large and small stars, written to the shared folder
between rounds.

Result: a row per document with class_id (smallest id of its component),
n_links (other documents at the threshold or more, copies included) and
n_copies (documents with the same set, itself included).

Defined cases: a text without words is linked only to equal non-empty texts;
null and empty texts are linked to nothing; a null id is ignored in class_id
unless all ids of the component are null; a repeated row is a copy; pairs at
exactly the threshold are links; very long texts are taken whole; an empty table
gives no row; other columns are not carried along, so no name can clash.
Words are hashed to 64 bits and sets to 128; the hashes stand for them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, Words, blocks, grams, letters_table, mix, written

SHINGLE, THRESHOLD, TREES, DEEPEST, RECALL, BLOCK, LIGHT = 5, 0.8, 20, 8, 0.9995, 1024, 4096
PLACES = 1 << 20


def depth_for(similarity: float, trees: int, deepest: int, recall: float) -> int:
    """Longest prefix with which a pair of this similarity shares one in some trie with probability ``recall``."""
    depth = deepest
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def lowest_similarity(n: int, threshold: float) -> float | None:
    """The lowest similarity from the threshold on that a set of ``n`` can have with another set; None if there is none."""
    best = None
    for common in range(max(1, math.ceil(threshold * n - 1e-9)), n + 1):
        union = math.floor(common / threshold + 1e-9)  # the largest that keeps the threshold
        if union < n or (common == n and union == n):
            continue
        if best is None or common / union < best:
            best = common / union
    return best


def depths_for(threshold: float, trees: int, deepest: int, recall: float, sizes: int = 512) -> np.ndarray:
    """Depth of a class by the size of its set (0: none can be near it); larger sets have the depth of the threshold."""
    out = np.zeros(sizes + 1, np.int64)
    for n in range(1, sizes + 1):
        low = lowest_similarity(n, threshold)
        out[n] = 0 if low is None else depth_for(low, trees, deepest, recall)
    out[sizes] = depth_for(threshold, trees, deepest, recall)
    return out


def levels_of(n: int, depths: np.ndarray, threshold: float) -> list[int]:
    """Depths at which a set of ``n`` meets others: its own and any deeper one of a set that can be near it."""
    at = lambda m: int(depths[min(m, len(depths) - 1)])
    if not at(n):
        return []
    if n * threshold > len(depths):
        return [at(n)]
    near = range(math.ceil(n * threshold - 1e-9), math.floor(n / threshold + 1e-9) + 1)
    return sorted({max(at(n), at(m)) for m in near if at(m)})


def shingle_sets(w: Words, h: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; empty for a row without words."""
    g = grams(h, size)
    out = []
    for a, b in zip(w.per_row[:-1].tolist(), w.per_row[1:].tolist(), strict=True):
        out.append(np.unique(g[a : b - size + 1]) if b - a >= size else grams(h[a:b], b - a) if b > a else np.zeros(0, U64))
    return out


def key_of(found: np.ndarray, text: bytes) -> bytes | None:
    if len(found):
        return hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return hashlib.blake2b(text, digest_size=16, person=b"text").digest() if text else None


def signatures(found: list[np.ndarray], trees: int, deepest: int) -> np.ndarray:
    """(rows, trees, deepest): the first two bytes of each MinHash value; rows must have shingles."""
    offs = np.cumsum([0, *map(len, found)])[:-1]
    x = (np.concatenate(found) >> U64(32)).astype(np.uint32)
    rng = np.random.default_rng(20)
    out = np.empty((len(found), trees, deepest), np.uint16)
    for t in range(trees):
        for d in range(deepest):
            flip, odd = (np.uint32(v) for v in rng.integers(0, 1 << 32, 2, np.uint64))
            v = (x ^ flip) * (odd | np.uint32(1))
            v ^= v >> np.uint32(15)
            low = np.minimum.reduceat(v * np.uint32(0x2C1B3C6D), offs)
            out[:, t, d] = ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    return out


def cut(prefixes: np.ndarray, depth: int) -> np.ndarray:
    """(rows, trees, deepest) -> (rows, trees): the trie and its prefix of ``depth`` values, as one hash."""
    acc = np.broadcast_to(np.arange(1, prefixes.shape[1] + 1, dtype=U64) * U64(64) + U64(depth), prefixes.shape[:2])
    for d in range(depth):
        acc = mix(acc * U64(0x9E3779B97F4A7C15) + prefixes[:, :, d])
    return acc


def _base(size: int, trees: int, deepest: int):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("key", pa.binary()), ("n", pa.int32()), ("prefixes", pa.binary())])

    def run(batches):
        table = letters_table()
        for batch in batches:
            for rows, data, offs in blocks(batch, "text"):
                w = Words(data, offs, table)
                found = shingle_sets(w, w.hashes(), size)
                full = [i for i, f in enumerate(found) if len(f)]
                prefixes: list[bytes | None] = [None] * len(found)
                if full:
                    for i, p in zip(full, signatures([found[i] for i in full], trees, deepest), strict=True):
                        prefixes[i] = p.tobytes()
                keys = [key_of(f, data[a:b].tobytes() if not len(f) else b"") for f, a, b in zip(found, offs[:-1], offs[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(keys, pa.binary()), pa.array([len(f) for f in found], pa.int32()), pa.array(prefixes, pa.binary())], schema=schema)

    return run


def _explode(trees: int, deepest: int, depths: np.ndarray, threshold: float):
    """(key, n, prefixes) -> a row for each trie and depth at which the class stands."""
    schema = pa.schema([("bucket", pa.int64()), ("tree", pa.int32()), ("depth", pa.int32()), ("key", pa.binary())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                p = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, trees, deepest)
                levels = [levels_of(n, depths, threshold) for n in part.column(1).to_pylist()]
                for depth in sorted({d for x in levels for d in x}):
                    mine = np.flatnonzero([depth in x for x in levels])
                    bucket = np.ascontiguousarray(cut(p[mine], depth)).view(np.int64).ravel()
                    tree = np.tile(np.arange(trees, dtype=np.int32), len(mine))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(tree), pa.array(np.full(len(bucket), depth, np.int32)), part.column(0).take(pa.array(np.repeat(mine, trees)))], schema=schema)

    return run


def _grouped(batches, n_keys: int):
    """Runs of rows with equal first ``n_keys`` columns, as lists of tuples, from sorted batches."""
    run, last = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != last:
                if run:
                    yield run
                run, last = [], row[:n_keys]
            run.append(row)
    if run:
        yield run


def met_before(p: np.ndarray, q: np.ndarray, tree: int) -> np.ndarray:
    """(rows of p, rows of q): whether they share a prefix (see cut) in a tree before ``tree``."""
    out = np.zeros((len(p), len(q)), bool)
    for t in range(tree):
        out |= p[:, t, None] == q[None, :, t]
    return out


def _own(group_n: np.ndarray, depth: int, depths: np.ndarray) -> np.ndarray:
    """Whether each class of a group has the group's depth itself: two classes meet at the deeper of their depths."""
    return depths[np.minimum(group_n, len(depths) - 1)] == depth


def _needed(schema: pa.Schema, trees: int, deepest: int, depths: np.ndarray):
    """Keeps the rows (bucket, tree, depth, m, key, n, copies, prefixes) of classes that meet another here for the first time."""

    def run(batches):
        out: list[tuple] = []
        for group in _grouped(batches, 1):
            tree, depth = group[0][1], group[0][2]
            p = cut(np.frombuffer(b"".join(r[7] for r in group), np.uint16).reshape(-1, trees, deepest), depth)
            own = _own(np.array([r[5] for r in group]), depth, depths)
            for a in range(0, len(group), 512):
                new = ~met_before(p[a : a + 512], p, tree) & (own[a : a + 512, None] | own[None, :])
                new[np.arange(len(new)), np.arange(a, a + len(new))] = False
                out += [group[a + i] for i in np.flatnonzero(new.any(1)).tolist()]
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


SENT = [("bucket", "long", pa.int64()), ("i", "int", pa.int32()), ("j", "int", pa.int32()), ("key", "binary", pa.binary()), ("own", "int", pa.int32()), ("tree", "int", pa.int32()), ("depth", "int", pa.int32()), ("copies", "long", pa.int64()), ("prefixes", "binary", pa.binary()), ("found", "binary", pa.binary())]


def _send(size: int, block: int):
    """(text, key, copies, prefixes, at: array of (bucket, tree, depth, m)) -> rows of SENT, one for each group of blocks."""
    schema = pa.schema([(n, t) for n, _, t in SENT])

    def run(batches):
        table, sent = letters_table(), set()
        for batch in batches:
            for rows, data, offs in blocks(batch, "text"):
                w = Words(data, offs, table)
                found = shingle_sets(w, w.hashes(), size)
                out: list[tuple] = []
                for f, key, copies, prefixes, at in zip(found, *(rows.column(c).to_pylist() for c in ("key", "copies", "prefixes", "at")), strict=True):
                    if key_of(f, b"") != key or key in sent:
                        continue  # another text with this hash, or a repeated row
                    if len(sent) >= 1_000_000:
                        sent.clear()  # (what is sent twice is found to be one class where it arrives)
                    sent.add(key)
                    own_bytes = f.tobytes()
                    for x in at:
                        parts = -(-x["m"] // block)
                        own = int.from_bytes(key[:4], "little") % parts
                        for other in range(parts):
                            out.append((x["bucket"], min(own, other), max(own, other), key, own, x["tree"], x["depth"], copies, prefixes, own_bytes))
                    if len(out) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return run


def common_counts(a: list[np.ndarray], b: list[np.ndarray] | None, most: int = 8_000_000) -> np.ndarray:
    """Sizes of the intersections of the sets in ``a`` with those in ``b`` (None: with each other)."""
    sets = a if b is None else a + b
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[which]
    row, col = row[keep], place[which[keep]]
    n, m = len(a), len(sets)
    out = np.zeros((n, n if b is None else m - n), np.float32)
    width = max(1, most // m)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(col, [at, at + width])
        x = np.zeros((m, min(width, int(shared.sum()) - at)), np.float32)
        x[row[lo:hi], col[lo:hi] - at] = 1
        out += x[:n] @ (x[:n] if b is None else x[n:]).T
    return out


def links_within(keys: list[bytes], copies: np.ndarray, prefixes: np.ndarray, sets: list[np.ndarray], own: np.ndarray, i: int, j: int, tree: int, threshold: float, deep: np.ndarray) -> list[tuple[bytes, int, bytes]]:
    """(key, linked documents, smallest connected key) of classes with a link that counts in this group.

    prefixes: (classes, trees), see cut; deep: whether a class has the group's depth itself.
    """
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    if not len(left) or not len(right):
        return []
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    both = common_counts([sets[k] for k in left], None if i == j else [sets[k] for k in right])
    near = both * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-4
    a, b = np.nonzero(np.triu(near, 1) if i == j else near)
    a, b = left[a], right[b]
    new = deep[a] | deep[b]
    for t in range(tree):
        new &= prefixes[a, t] != prefixes[b, t]
    a, b = a[new], b[new]
    if not len(a):
        return []
    n = np.bincount(a, copies[b], len(keys)) + np.bincount(b, copies[a], len(keys))
    root = np.arange(len(keys))
    while True:
        low = np.minimum(root[a], root[b])
        was = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (was == root).all():
            break
    return [(keys[k], int(n[k]), keys[root[k]]) for k in np.flatnonzero(n).tolist()]


def _verify(threshold: float, trees: int, deepest: int, depths: np.ndarray):
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(batches):
        out: list[tuple] = []
        for group in _grouped(batches, 3):
            rows = list({r[3]: r for r in group}.values())  # sorted by key
            if len(rows) > 1:
                sets, depth = [np.frombuffer(r[9], U64) for r in rows], rows[0][6]
                p = cut(np.frombuffer(b"".join(r[8] for r in rows), np.uint16).reshape(-1, trees, deepest), depth)
                deep = _own(np.fromiter(map(len, sets), np.int64, len(sets)), depth, depths)
                out += links_within([r[3] for r in rows], np.array([r[7] for r in rows], np.int64), p, sets, np.array([r[4] for r in rows]), rows[0][1], rows[0][2], rows[0][5], threshold, deep)
            if len(out) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): alternating large and small stars until nothing changes.

    Each round keeps components and lowers some label, so it ends; a number of rounds that grows with the logarithm of the
    largest component is usual.
    """
    e = written(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sign = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    while True:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "m").filter(F.col("x") != F.col("m")).select(F.col("x").alias("a"), F.col("m").alias("b"))
        e = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        was, sign = sign, e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if was == sign:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL, block: int = BLOCK, light: int = LIGHT, key_col: str | None = None) -> DataFrame:
    """A row per document: its id, class_id, n_links and n_copies; with ``key_col``, also the key of its shingle set (see keyed)."""
    depths = depths_for(threshold, trees, deepest, recall)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    base = written(source.mapInArrow(_base(size, trees, deepest), "id long, h long, key binary, n int, prefixes binary"), "base")
    nodes = base.filter("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("low"), F.coalesce(F.min_by("h", "id"), F.min("h")).alias("rep"), F.max("n").alias("n"), F.max("prefixes").alias("prefixes"))
    nodes = written(nodes, "nodes")
    full = nodes.filter("prefixes is not null").select("key", "copies", "n", "prefixes")
    rows = full.select("key", "n", "prefixes").mapInArrow(_explode(trees, deepest, depths, threshold), "bucket long, tree int, depth int, key binary")
    shared = written(rows.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1"), "shared")
    rows = rows.join(shared, "bucket").join(full, "key")  # prefixes travel only for classes that meet another
    rows = written(rows.select("bucket", "tree", "depth", "m", "key", "n", "copies", "prefixes"), "meets")
    schema = pa.schema([("bucket", pa.int64()), ("tree", pa.int32()), ("depth", pa.int32()), ("m", pa.int64()), ("key", pa.binary()), ("n", pa.int32()), ("copies", pa.int64()), ("prefixes", pa.binary())])
    names = "bucket long, tree int, depth int, m long, key binary, n int, copies long, prefixes binary"
    few = rows.filter(F.col("m") <= light).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_needed(schema, trees, deepest, depths), names)
    need = few.union(rows.filter(F.col("m") > light)).groupBy("key").agg(F.collect_list(F.struct("bucket", "tree", "depth", "m")).alias("at"), F.max("copies").alias("copies"), F.max("prefixes").alias("prefixes"))
    need = written(need.join(nodes.select("key", "low", "rep"), "key"), "need")
    # most texts are in no candidate pair: a set of at most PLACES hash places, small enough to broadcast at any size of
    # the corpus, keeps them from the shuffle
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES)).alias("place")
    some = source.withColumn("place", place("h")).join(F.broadcast(need.select(place("rep")).distinct()), "place", "left_semi")
    one = (F.col("h") == F.col("rep")) & F.col("id").eqNullSafe(F.col("low"))  # a class's sender: its smallest id, and that row's text
    sent = some.join(need.hint("merge"), one).select("text", "key", "copies", "prefixes", "at").mapInArrow(_send(size, block), ", ".join(f"{n} {t}" for n, t, _ in SENT))
    met = sent.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key").mapInArrow(_verify(threshold, trees, deepest, depths), "key binary, links long, root binary")
    met = written(met, "links")
    links = met.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("key").alias("a"), F.col("root").alias("b")))
    of = nodes.select("key", "copies", "low").join(roots, F.col("key") == F.col("node"), "left").select("key", "copies", "low", F.coalesce("root", "key").alias("root"))
    least = of.groupBy("root").agg(F.min("low").alias("class_id"))
    of = written(of.join(least, "root").join(links, "key", "left").select("key", "copies", "class_id", F.coalesce("links", F.lit(0)).alias("links")), "classes")
    out = base.select("id", "key").join(of, "key", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), *([base["key"].alias(key_col)] if key_col else []))


def _keyed(text: str, size: int, schema: pa.Schema):
    def run(batches):
        table = letters_table()
        for batch in batches:
            for rows, data, offs in blocks(batch, text):
                w = Words(data, offs, table)
                keys = [key_of(f, data[a:b].tobytes() if not len(f) else b"") for f, a, b in zip(shingle_sets(w, w.hashes(), size), offs[:-1], offs[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), pa.array(keys, pa.binary())], schema=schema)

    return run


def keyed(docs: DataFrame, text_col: str, key_col: str, size: int = SHINGLE) -> DataFrame:
    """``docs`` with the key of each text's shingle set; null for null and empty texts."""
    schema = T.StructType([*docs.schema.fields, T.StructField(key_col, T.BinaryType())])
    return docs.mapInArrow(_keyed(text_col, size, to_arrow_schema(schema)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
