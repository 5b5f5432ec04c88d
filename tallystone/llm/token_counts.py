"""Token counts by a trie of pre-tokens and unigram forward scores.

Words (runs of bytes other than ASCII white space, with the piece table's word
mark in front) are made distinct over a block of documents and inserted in a
trie, one level a byte.  For each node, once for all the words that share the
prefix, the forward score is the best over the pieces that end there: score of
the piece plus that of the node before it; with it goes the number of pieces.
Terminal nodes store the count of their word, and a document's count is the sum
over its words.  A level is computed for all its nodes at once in numpy.

Bytes that no piece covers are byte pieces, at a fixed low score.  Ties go to
the fewer tokens.  The piece table gives merge ranks, not probabilities; a
piece of rank r has the score -ln(r + 2) (see ``pieces``).

Defined cases: null, empty and blank texts have no word and no token; there is
no limit on the length of a word or text; repeated rows are counted each; an
empty table gives no row; other columns are carried along, and a new column whose
name is taken gets ``_`` in front.  64-bit hashes stand for words within a block.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import U64, Words, blocks, free_names, mix, spaces_table

#: About as many bytes of text share a trie.
BLOCK = 12_000_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN = -20.0  # score of a byte piece
B = U64(0x9E3779B97F4A7C15)


def pieces(model: str = MODEL) -> list[tuple[int, str, float]]:
    """(id, piece, score) of the model's ordinary pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=Path(model).read_bytes())
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return [(i, sp.id_to_piece(i), -float(np.log(r + 2))) for r, i in enumerate(plain)]


class Table:
    """Pieces by hash of their bytes."""

    def __init__(self, of: list[tuple[int, str, float]]):
        keys = [p.encode() for _, p, _ in of]
        self.longest = max(map(len, keys))
        h = np.array([self._hash(k) for k in keys], U64)
        order = np.argsort(h)
        self.hash, self.score = h[order], np.array([s for _, _, s in of])[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hash >> U64(44)] = True

    @staticmethod
    def _hash(k: bytes) -> int:
        h = 0
        for c in k:
            h = (h * int(B) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return int(mix(np.array([h ^ len(k)], U64))[0])

    def scores(self, h: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Score of the piece with each rolling hash and length; -inf if there is none."""
        out = np.full(h.shape, -np.inf)
        m = mix(h ^ length)
        maybe = np.nonzero(self.seen[m >> U64(44)])
        m = m[maybe]
        at = np.searchsorted(self.hash, m)
        at[at == len(self.hash)] = 0
        out[maybe] = np.where(self.hash[at] == m, self.score[at], -np.inf)
        return out


def trie_counts(words: list[bytes], table: Table) -> np.ndarray:
    """Pieces in the best segmentation of each distinct word."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-size, kind="stable")
    data = np.frombuffer(b"".join(words), np.uint8)
    first = (np.cumsum(size) - size)[order]
    size = size[order]
    out = np.zeros(len(words), np.int64)
    # column l - 1: the node l levels up (score, count), and the hash of the last l bytes
    best, count, roll = np.zeros((1, 1)), np.zeros((1, 1), np.int64), np.zeros((1, 0), U64)
    node = np.zeros(len(words), np.int64)
    lengths = np.arange(1, table.longest + 1, dtype=U64)
    depth, live = 0, int(np.searchsorted(-size, 0, "left"))
    while live:  # words longer than depth
        step, at = np.unique(node[:live] << 8 | data[first[:live] + depth], return_inverse=True)
        up, byte = step >> 8, (step & 255).astype(U64)
        width = min(depth + 1, table.longest)
        h = np.zeros((len(step), width), U64)
        h[:, 1:] = roll[up, : width - 1]
        h = h * B + byte[:, None] + U64(1)
        above, tokens = best[up, :width], count[up, :width]
        s = table.scores(h, lengths[:width]) + above
        s[:, 0] = np.maximum(s[:, 0], above[:, 0] + UNKNOWN)
        top = s.max(1)
        n = np.where(s >= top[:, None], tokens, np.iinfo(np.int64).max).min(1) + 1
        best, count, roll = np.concatenate([top[:, None], above], 1), np.concatenate([n[:, None], tokens], 1), h
        depth += 1
        live, was = int(np.searchsorted(-size, -depth, "left")), live
        out[order[live:was]] = n[at[live:was]]
        node = at[:live]
    return out


def _count(part, text: str, schema: pa.Schema):
    def run(batches):
        table, spaces = Table(part.value), spaces_table(lower=False)
        mark = MARK.encode()
        for batch in batches:
            for rows, data, offs in blocks(batch, text, BLOCK):
                w = Words(data, offs, spaces)
                _, where, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
                n = trie_counts([mark + data[w.start[i] : w.end[i]].tobytes() for i in where.tolist()], table)
                total = np.zeros(len(which) + 1, np.int64)
                np.cumsum(n[which], out=total[1:])
                new = [np.diff(w.per_row), total[w.per_row[1:]] - total[w.per_row[:-1]]]
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(rows.columns, schema, strict=False)), *map(pa.array, new)], schema=schema)

    return run


def count_tokens(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``docs`` with n_words and n_tokens.  The piece table (fixed, some 32,000 entries) is broadcast."""
    names = free_names(docs, "n_words", "n_tokens")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    table = docs.sparkSession.sparkContext.broadcast(pieces(model))
    return docs.mapInArrow(_count(table, text_col, to_arrow_schema(schema)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
