"""Line deduplication over levelled sorted runs of line hashes.

Each document's lines are keyed (trimmed of ASCII white space, A-Z lowered)
and hashed to 128 bits.  Documents are dealt into batches by a hash of their
id.  A batch is reduced to one entry a hash (documents, largest id), sorted by
hash, and merge-joined with the runs that exist, which lie bucketed and sorted
by hash.  The join decides where an entry goes: what no run holds (the
anti-join) becomes a new run of level 0; what a run holds becomes a change to
that run, kept beside it.  So each hash lives in one run, and its count is that
run's entry and changes added up; runs are never compared with each other
again.  When ``fanout`` runs share a level they are compacted with their changes
into one of the next level.  Hashes found in ``min_docs`` documents or more
lose their lines everywhere but in the document with the largest id.

There is a batch for each ``batch_docs`` documents, three at least.

Defined cases: null or empty text is one empty line; rows with one id are one
document; a row with a null id is a document of its own, whose id sorts below
all others; rows that share the largest id all keep the line; very long texts
are split whole; an empty table gives an empty result; other columns are
carried along, and a new column whose name is taken gets ``_`` in front.
128-bit hashes stand for keys.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucketed, free_names, written

BLANK = " \t\n\x0b\x0c\r"


def _keys(min_chars: int):
    schema = pa.schema([("h", pa.binary()), ("id", pa.int64()), ("row", pa.int64()), ("at", pa.list_(pa.int32())), ("batch", pa.int32())])

    def run(batches):
        for batch in batches:
            h, ids, rows, ats, dealt = [], [], [], [], []
            texts = batch.column(0)
            for i, (id_, row, part) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                found: dict[bytes, list[int]] = {}
                for at, line in enumerate((texts[i].as_py() or "").split("\n")):
                    if len(line) >= min_chars and len(key := line.strip(BLANK)) >= min_chars:
                        found.setdefault(hashlib.blake2b(key.encode().lower(), digest_size=16).digest(), []).append(at)
                h += found
                ats += found.values()
                for out, value in ((ids, id_), (rows, row), (dealt, part)):
                    out += [value] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((h, ids, rows, ats, dealt), schema, strict=True)], schema=schema)

    return run


@dataclass
class Run:
    """Entries (h, n, id) of hashes that no other run holds, and changes to them."""

    level: int
    entries: DataFrame
    changes: list[DataFrame] = field(default_factory=list)

    def merged(self) -> DataFrame:
        return _summed([self.entries, *self.changes]) if self.changes else self.entries


def _summed(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("h").agg(F.sum("n").alias("n"), F.max("id").alias("id"))


def _stored(entries: DataFrame, what: str) -> DataFrame:
    """``entries`` bucketed and sorted by hash, one file a bucket."""
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.sparkSession.table(bucketed(entries.repartition(n, "h"), what, n, "h"))


def line_runs(keys: DataFrame, batches: int, fanout: int = 2) -> list[Run]:
    """Adds the batches of ``keys`` (h, id, batch) one by one; the runs left."""
    runs: list[Run] = []
    for b in range(batches):
        mine = keys.filter(F.col("batch") == b)
        # a document counts once; the first step spreads a common line over the documents that hold it
        mine = mine.groupBy("h", "id").agg(F.count("*").alias("n")).withColumn("n", F.when(F.col("id").isNull(), F.col("n")).otherwise(F.lit(1).cast("long")))
        mine = mine.groupBy("h").agg(F.sum("n").alias("n"), F.max("id").alias("id")).withColumn("home", F.lit(None).cast("int"))
        for i, r in enumerate(runs):
            held = r.entries.select("h", F.lit(i).alias("run"))
            mine = mine.join(held.hint("merge"), "h", "left").select("h", "n", "id", F.coalesce("home", "run").alias("home"))
        if runs:
            mine = written(mine, "batch", "home")
            for i, r in enumerate(runs):
                r.changes.append(mine.filter(F.col("home") == i).drop("home"))
        runs.append(Run(0, _stored(mine.filter(F.col("home").isNull()).drop("home"), "run0")))
        level = 0
        while len(same := [r for r in runs if r.level == level]) >= fanout:
            level += 1
            parts = [p for r in same for p in (r.entries, *r.changes)]
            runs = [r for r in runs if r.level != level - 1] + [Run(level, _stored(_summed(parts), f"run{level}"))]
    return runs


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int | None = None, fanout: int = 2, batch_docs: int = 1_000_000_000) -> DataFrame:
    """``docs`` with new columns n_lines, n_dropped and kept (the text without the dropped lines)."""
    row, drop, lines, n_lines, n_dropped, kept = free_names(docs, "ld_row", "ld_drop", "ld_lines", "n_lines", "n_dropped", "kept")
    batches = batches or max(3, -(-docs.count() // batch_docs))
    id_, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    mark: Column = F.xxhash64(text, F.length(text))
    found = docs.select(text.alias("text"), id_.cast("long").alias("id"), mark.alias("row"), F.pmod(F.xxhash64(id_), F.lit(batches)).cast("int").alias("batch"))
    keys = written(found.mapInArrow(_keys(min_chars), "h binary, id long, row long, at array<int>, batch int"), "keys", "batch")
    frequent = [r.merged().filter(F.col("n") >= min_docs).select("h", F.col("id").alias("top")) for r in line_runs(keys.select("h", "id", "batch"), batches, fanout)]
    common = frequent[0]
    for f in frequent[1:]:
        common = common.union(f)
    common = written(common, "common")
    lose = keys.join(common, "h").filter(~F.col("id").eqNullSafe(F.col("top")))
    lose = lose.groupBy(F.col("id").alias("ld_id"), F.col("row").alias("ld_of")).agg(F.flatten(F.collect_list("at")).alias("ld_at"))
    d = docs.withColumn(row, mark)
    d = d.join(lose, d[id_col].cast("long").eqNullSafe(lose["ld_id"]) & (d[row] == lose["ld_of"]), "left").drop("ld_id", "ld_of").withColumnRenamed("ld_at", drop)
    d = d.withColumn(lines, F.split(text, "\n", -1)).withColumn(drop, F.array_distinct(F.coalesce(F.col(drop), F.array().cast("array<int>"))))
    d = d.withColumns({n_lines: F.size(lines).cast("long"), n_dropped: F.size(drop).cast("long")})
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    d = d.withColumn(kept, F.when(F.size(drop) == 0, text).otherwise(F.array_join(F.transform(left, lambda i: F.element_at(F.col(lines), i + 1)), "\n")))
    out = d.drop(row, drop, lines)
    return out


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.top AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
