"""A training-corpus pipeline over ``documents``: five stages, each on all that the one before kept.

1. language ID: documents whose language can't be told (no text, no letter) go;
2. line dedup: common lines go from all documents but the one with the largest id;
3. n-gram Jaccard join: of each class of near copies the document with the
   smallest id stays (rows that repeat its id and its set of shingles go; rows with a null id stay);
4. benchmark decontamination: contaminated documents go;
5. SentencePiece encoding and decoding: number and digest of each document's
   pieces, and digest of the text decoded from them.

All but the last return the columns they get, in their order; text changes in
stage 2 only (n_chars is kept as it came).  Columns are found by name; extra
columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import free_names, written
from tallystone.llm.decontaminate import decontaminate
from tallystone.llm.jaccard_forest import jaccard_join, keyed
from tallystone.llm.language_id import held_out, identify
from tallystone.llm.line_dedup import dedup_lines
from tallystone.llm.sp_lattice import digests


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = docs.filter(~held_out("doc_id", 5)).select(F.col("doc_id").alias("id"), "text", "lang")
    told = identify(docs, labelled)
    return told.filter(F.col(told.columns[-2]) != "und").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    kept = F.when(F.col("text").isNotNull(), F.col(out.columns[-1]))
    return out.select(*(kept.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, stays, of = free_names(docs, "_key", "_stays", "_of")
    stay = jaccard_join(docs, key_col=of).filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias(stays), of).distinct()
    known = keyed(docs.filter(F.col("doc_id").isNotNull()), "text", key)
    same = (F.col("doc_id").cast("long") == F.col(stays)) & F.col(key).eqNullSafe(F.col(of))
    kept = known.join(stay, same, "left_semi").dropDuplicates(["doc_id", key])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.filter(~F.col(out.columns[-1])).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("encoded", encoded)]

#: SQL can express neither the classifier, nor the join at this size, nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
