"""SentencePiece encoding and decoding through a relational lattice.

Documents are cut into pre-tokens wherever two characters meet that no piece
holds side by side: no edge of the lattice could cross the cut, so the best path
over the pre-tokens is the best over the whole text.  Nothing is cut for its
length; the fold copies its places, so its time grows with the square of a
pre-token's length.

Documents are packed in chunks of about ``chunk`` characters: the distinct
pre-tokens of the chunk and, for each document, their numbers in order.  The
pre-tokens of all chunks are dealt by a hash of their text, and each distinct one is
segmented once for the whole corpus: it is exploded to its substrings of bounded
length, which are joined with the piece table (a fixed vocabulary, broadcast),
grouped by pre-token, and folded by position with Spark's ``aggregate``: the
best score to each end is the best over the edges that end there.  A character
that no piece covers has an edge of byte pieces.  The ids then go back to each
chunk that holds the pre-token, compressed by chunk, and meet the chunks where
they lie (a table bucketed by chunk); there the documents are encoded.

The model file holds merge ranks, not probabilities; a piece of rank r scores
-ln(r + 2) (see token_counts.pieces), byte pieces score -20 a character.  Ties
go to the edge that starts first.

Encoding is lossless: a word mark that occurs in the text itself is encoded by
its bytes.  Defined cases: null text is encoded as empty text, which has no
piece; a very long text is a chunk of its own; repeated rows are encoded each;
an empty table gives an empty result; other columns, nulls in them included,
are carried along, and a new column whose name is taken gets ``_`` in front.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bucketed, free_names, tidy
from .token_counts import MARK, MODEL, UNKNOWN, pieces

CHUNK = 8_000_000
#: Buckets of the chunk table for each shuffle partition: few chunks meet in a task.
BUCKETS = 4
#: Buckets of pre-tokens for each shuffle partition, so that partitions are even.
WORD_BUCKETS = 8
#: Partitions of pre-tokens for each shuffle partition: a pre-token has some twenty edges, which are sorted in memory.
SPREAD = 2


class Joins:
    """Which characters stand side by side in some piece."""

    def __init__(self, of: list[tuple[int, str, float]]):
        chars = sorted({c for _, p, _ in of for c in p})
        number = {c: i + 1 for i, c in enumerate(chars)}
        self.number = np.zeros(0x110000, np.int16)  # 0: in no piece
        self.number[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1,) * 2, bool)
        for _, p, _ in of:
            for a, b in zip(p, p[1:], strict=False):
                self.beside[number[a], number[b]] = True

    def cut(self, text: str) -> list[str]:
        n = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        at = [0, *(np.flatnonzero(~self.beside[n[:-1], n[1:]]) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)] if text else []


def pretokens(text: str, joins: Joins | None = None) -> list[str]:
    """Pre-tokens of a text; a literal word mark is the pre-token "" (it has no lattice)."""
    if not text:
        return []
    cut = (joins or Joins(pieces())).cut
    if MARK not in text:
        return cut(MARK + text.replace(" ", MARK))
    out: list[str] = []
    for i, part in enumerate(text.split(MARK)):
        if i:
            out.append("")
        out += cut((MARK if i == 0 else "") + part.replace(" ", MARK))
    return out


PARTS = pa.list_(pa.struct([("bucket", pa.int32()), ("base", pa.int32()), ("words", pa.string())]))


def _pack(rest: pa.Schema, text: str, chunk: int, buckets: int, joins):
    """Rows (chunk, parts, body, rows): the distinct pre-tokens by bucket of their text, joined by blanks, which no
    pre-token holds; the documents' pre-tokens by number (``base`` is the number of a part's first); their other columns."""
    schema = pa.schema([("chunk", pa.int64()), ("parts", PARTS), ("body", pa.binary()), ("rows", pa.binary())])

    def run(batches):
        squeeze, part, made = zstandard.ZstdCompressor(3), TaskContext.get().partitionId(), 0
        number: dict[str, int] = {}
        seqs, ends, size, kept = [], [], 0, []

        def flush():
            sink, count = pa.BufferOutputStream(), len(number)
            with pa.ipc.new_stream(sink, rest) as w:
                for k in kept:
                    w.write_batch(k)
            number.pop("", None)  # the literal word mark has no lattice
            of = sorted((zlib.crc32(w.encode()) % buckets, w) for w in number)
            place = np.zeros(count, np.uint32)
            place[np.fromiter((number[w] for _, w in of), np.int64, len(of))] = np.arange(1, len(of) + 1, dtype=np.uint32)
            bucket = np.array([b for b, _ in of], np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist() if of else []
            parts = [{"bucket": int(bucket[a]), "base": a + 1, "words": " ".join(w for _, w in of[a:b])} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            seq = place[np.concatenate([np.zeros(0, np.uint32), *seqs])]
            body = np.array([len(ends), *ends], np.uint32).tobytes() + _planes(seq)
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | made], pa.int64()), pa.array([parts], PARTS), pa.array([squeeze.compress(body)], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=schema)

        for batch in batches:
            at = batch.schema.get_field_index(text)
            others = [i for i in range(batch.num_columns) if i != at]
            texts = batch.column(at)
            first = 0
            for i in range(batch.num_rows):
                t = texts[i].as_py() or ""
                words = pretokens(t, joins.value)
                seqs.append(np.array([number.setdefault(w, len(number)) for w in words], np.uint32))
                ends.append((ends[-1] if ends else 0) + len(words))
                size += len(t)
                if size >= chunk or i + 1 == batch.num_rows:
                    kept.append(pa.RecordBatch.from_arrays([batch.column(k).slice(first, i + 1 - first).cast(f.type) for k, f in zip(others, rest, strict=True)], schema=rest))
                    first = i + 1
                if size >= chunk:
                    yield flush()
                    made += 1
                    number, seqs, ends, size, kept = {}, [], [], 0, []
        if kept:
            yield flush()

    return run


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers as four runs of their bytes, which compress better."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=at).reshape(4, -1).T).view("<u4").ravel()


def forward(edges: Column) -> Column:
    """For each place in a word from 0: score of the best path to it, and the start and id of that path's last edge.

    edges: array of (stop, start, id, score).  Edges are folded in order of stop; the best to the present stop is kept
    beside the finished places.
    """

    def place(s: Column) -> Column:
        return F.struct(s["score"].alias("score"), s["start"].alias("start"), s["id"].alias("id"))

    def step(s: Column, x: Column) -> Column:
        score = F.when(x["start"] == s["stop"], s["score"]).otherwise(F.element_at(s["best"], x["start"] + 1)["score"]) + x["score"]
        best = F.when(x["stop"] == s["stop"], s["best"]).otherwise(F.concat(s["best"], F.array(place(s))))
        here = F.struct(best.alias("best"), x["stop"].alias("stop"), score.alias("score"), x["start"].alias("start"), x["id"].alias("id"))
        return F.when((x["stop"] == s["stop"]) & (score <= s["score"]), s).otherwise(here)

    start = F.struct(F.array().cast("array<struct<score:double,start:int,id:int>>").alias("best"), F.lit(0).alias("stop"), F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(0).alias("id"))
    return F.aggregate(F.sort_array(edges), start, step, lambda s: F.concat(s["best"], F.array(place(s))))


def backward(lattice: Column) -> Column:
    """Ids on the best path; -1 - code point for a character that is no piece."""
    start = F.struct((F.size(lattice) - 1).alias("at"), F.array().cast("array<int>").alias("ids"))

    def step(state: Column, stop: Column) -> Column:
        last = F.element_at(lattice, stop + 1)
        return F.when(state["at"] == stop, F.struct(last["start"].alias("at"), F.concat(F.array(last["id"]), state["ids"]).alias("ids"))).otherwise(state)

    return F.aggregate(F.sequence(F.size(lattice) - 1, F.lit(1), F.lit(-1)), start, step, lambda s: s["ids"])


def best_paths(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """``words`` (distinct in the column word, not empty, dealt by it or a bucket of it) with the ids of their best paths.

    Substrings of up to ``longest`` characters are joined with ``table`` (id, piece, score: a fixed vocabulary); a single
    character that is no piece keeps an edge of its own, which stands for its byte pieces.
    """
    others = [c for c in words.columns if c != "word"]
    starts = words.select("*", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    subs = starts.select("*", F.explode(F.sequence(F.col("start") + 1, F.least(F.length("word"), F.col("start") + longest))).alias("stop"))
    subs = subs.withColumn("piece", F.substr("word", F.col("start") + 1, F.col("stop") - F.col("start")))
    edges = subs.join(F.broadcast(table), "piece", "left").filter(F.col("id").isNotNull() | (F.col("stop") == F.col("start") + 1))
    edge = F.struct("stop", "start", F.coalesce("id", -1 - F.ascii("piece")).alias("id"), F.coalesce("score", F.lit(UNKNOWN)).alias("score"))
    # the aggregate finds a word's rows in one partition already: nothing is shuffled
    lattice = edges.groupBy("word", *others).agg(F.collect_list(edge).alias("edges")).withColumn("lattice", forward(F.col("edges")))
    return lattice.select("word", *others, backward(F.col("lattice")).alias("ids"))


def _ship(most: int = 1_000_000):
    """(chunk, number, ids) -> (chunk, found): the words of a chunk among some ``most`` rows in one compressed value."""
    schema = pa.schema([("chunk", pa.int64()), ("found", pa.binary())])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(3)

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            chunk, number = t["chunk"].to_numpy(), t["number"].to_numpy()
            lists = t["ids"].combine_chunks()
            offs, flat = np.asarray(lists.offsets).astype(np.int64), np.asarray(lists.values)
            order = np.lexsort((number, chunk))
            cuts = np.flatnonzero(np.concatenate([[True], chunk[order][1:] != chunk[order][:-1], [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                mine = order[a:b]
                k = offs[mine + 1] - offs[mine]
                ids = flat[np.repeat(offs[mine] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
                raw = np.array([b - a], np.uint32).tobytes() + _planes(np.concatenate([np.diff(number[mine], prepend=0), k, ids.astype(np.int64) & 0xFFFFFFFF]))
                yield pa.RecordBatch.from_arrays([pa.array([int(chunk[mine[0]])]), pa.array([squeeze.compress(raw)], pa.binary())], schema=schema)

        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= most:
                yield from flush()
                held, rows = [], 0
        if held:
            yield from flush()

    return run


def _encode(rest: pa.Schema, schema: pa.Schema):
    mark = np.array([3 + b for b in MARK.encode()], np.int32)

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in range(batch.num_rows):
                body = open_.decompress(batch.column("body")[r].as_py())
                n = int(np.frombuffer(body, np.uint32, 1)[0])
                ends, seq = np.frombuffer(body, np.uint32, n, 4).astype(np.int64), _from_planes(body, 4 * (n + 1))
                del body
                count = int(seq.max()) + 1 if len(seq) else 1
                start, length = np.zeros(count, np.int64), np.full(count, len(mark), np.int64)  # number 0 is the literal word mark
                flats, held = [mark], len(mark)
                for blob in batch.column("found")[r].values if batch.column("found")[r].is_valid else []:
                    raw = open_.decompress(blob.as_py())
                    words = int(np.frombuffer(raw, np.uint32, 1)[0])
                    x = _from_planes(raw, 4)
                    flat, size = _bytes_for_unknown(x[2 * words :].astype(np.int32), x[words : 2 * words].astype(np.int64))
                    number = np.cumsum(x[:words])
                    start[number], length[number] = held + np.cumsum(size) - size, size
                    flats.append(flat)
                    held += len(flat)
                flat = np.concatenate(flats).astype(np.int32)
                total = np.zeros(len(seq) + 1, np.int64)
                np.cumsum(length[seq], out=total[1:])
                stops = total[ends]
                del total
                out = [np.zeros(0, np.int32)]
                for a in range(0, len(seq), 1 << 19):
                    s, k = start[seq[a : a + (1 << 19)]], length[seq[a : a + (1 << 19)]]
                    out.append(flat[np.repeat(s - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(np.concatenate(out), pa.int32()))
                del out, seq
                rows = pa.ipc.open_stream(batch.column("rows")[r].as_py()).read_all().combine_chunks()
                cols = [*(c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in rows.columns), lists]
                whole = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
                for a in range(0, whole.num_rows, 1000):
                    yield whole.slice(a, 1000)

    return run


def _bytes_for_unknown(flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with each -1 - code point replaced by the byte pieces of its character."""
    odd = np.flatnonzero(flat < 0)
    if not len(odd):
        return flat, size
    texts = [[3 + b for b in chr(-1 - int(c)).encode()] for c in flat[odd].tolist()]
    more = np.ones(len(flat), np.int64)
    more[odd] = [len(t) for t in texts]
    out = np.repeat(flat, more)
    first = (np.cumsum(more) - more)[odd]
    for i, t in zip(first.tolist(), texts, strict=True):
        out[i : i + len(t)] = t
    owner = np.repeat(np.arange(len(size)), size)
    return out, np.bincount(owner, more, len(size)).astype(np.int64)


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that keeps bucketed scans, and joins sides that are both dealt by one of the
    join's columns as they lie."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL, chunk: int = CHUNK, ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` without its text, with the ids of its pieces; with ``decoded_col``, the same tasks also decode them."""
    spark = docs.sparkSession
    (ids,) = free_names(docs, ids_col)
    rest = T.StructType([f for f in docs.schema.fields if f.name != text_col])
    arrow_rest = to_arrow_schema(rest)
    schema = T.StructType([*rest.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    of = pieces(model)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.mapInArrow(tidy(_pack(arrow_rest, text_col, chunk, WORD_BUCKETS * n, spark.sparkContext.broadcast(Joins(of)))), "chunk long, parts array<struct<bucket:int,base:int,words:string>>, body binary, rows binary")
    name = bucketed(packed, "sp_chunks", BUCKETS * n, "chunk")
    own = _own_session(spark)
    chunks, table = own.table(name), own.createDataFrame(of, "id int, piece string, score double")
    parts = chunks.select("chunk", F.explode("parts").alias("part")).filter("chunk IS NOT NULL AND part.bucket IS NOT NULL AND part.base IS NOT NULL")
    parts = parts.select("chunk", "part.bucket", "part.base", "part.words").repartition(SPREAD * n, "bucket")
    # a row for each chunk that holds a word: no word has more rows than there are chunks
    places = parts.select("chunk", "bucket", "base", F.posexplode(F.split("words", " ")).alias("at", "word")).select("chunk", "bucket", (F.col("base") + F.col("at")).alias("number"), "word")
    words = places.groupBy("bucket", "word").agg(F.min("chunk").alias("chunk1"), F.min("number").alias("number1"))
    paths = best_paths(words, table, max(len(p) for _, p, _ in of)).withColumnsRenamed({"word": "of", "bucket": "bucket1"})
    # (the smallest chunk and number are never above a place's own; as they use all columns of the parts, one exchange
    # of the parts serves both sides)
    at = (paths["bucket1"] == places["bucket"]) & (paths["of"] == places["word"]) & (paths["chunk1"] <= places["chunk"]) & (paths["number1"] <= places["number"])
    found = places.hint("merge").join(paths, at).select(places["chunk"], places["number"], "ids")
    found = found.mapInArrow(tidy(_ship()), "chunk long, found binary").repartition(BUCKETS * n, "chunk")  # as the chunks' table lies
    found = found.groupBy("chunk").agg(F.collect_list("found").alias("found"))
    run = _encode(arrow_rest, to_arrow_schema(schema))
    if decoded_col:
        schema = T.StructType([*schema.fields, T.StructField(free_names_in(schema, decoded_col), T.StringType())])
        run = _both(run, _decode(ids, to_arrow_schema(schema), _piece_bytes(spark, model)))
    return chunks.select("chunk", "body", "rows").join(found, "chunk", "left").select("body", "rows", "found").mapInArrow(tidy(run), schema)


def _both(first, then):
    return lambda batches: then(first(batches))


def free_names_in(schema: T.StructType, name: str) -> str:
    have = {f.name.lower() for f in schema.fields}
    while name.lower() in have:
        name = "_" + name
    return name


def _decode(ids: str, schema: pa.Schema, part):
    def run(batches):
        flat, first, size = part.value
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for i in range(0, batch.num_rows, 500):
                rows = batch.slice(i, 500)
                col = rows.column(at).fill_null([]) if rows.column(at).null_count else rows.column(at)
                all_ids, offs = np.asarray(col.flatten()), np.asarray(col.offsets).astype(np.int64)
                offs = offs - offs[0]
                k = size[all_ids]
                text = flat[np.repeat(first[all_ids] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))]
                total = np.concatenate([[0], np.cumsum(k)])[offs]
                body = text.tobytes()
                out = []
                for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True):
                    t = body[a:b]
                    out.append(t[1:].decode() if t[:1] == b" " else t.decode())
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), pa.array(out, pa.string())], schema=schema)

    return run


def _piece_bytes(spark: SparkSession, model: str):
    """Broadcast of all pieces' bytes in a row, where each begins, and how many they are."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    table = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(sp.get_piece_size())]
    size = np.fromiter(map(len, table), np.int64, len(table))
    return spark.sparkContext.broadcast((np.frombuffer(b"".join(table), np.uint8), np.cumsum(size) - size, size))


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = MODEL, text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; null ids: empty text."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(free_names(encoded, text_col)[0], T.StringType())])
    return encoded.mapInArrow(_decode(ids_col, to_arrow_schema(schema), _piece_bytes(encoded.sparkSession, model)), schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, number and digest of its pieces, and digest of the text decoded from them."""
    out = encode(docs.select("doc_id", "text"), decoded_col="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.lower(F.hex(F.xxhash64("ids"))).alias("pieces_hash"), F.sha2(F.col("decoded").cast("binary"), 256).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
