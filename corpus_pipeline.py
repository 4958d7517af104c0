"""A training corpus from raw documents: quality rules, line dedup, near duplicates, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from karyolytics.llm import line_dedup, ngram_join, packing, quality
from karyolytics.llm.common import WHITE, Scratch, gathered, small_batches
from karyolytics.llm.queries import tokenizer


#: Keys of rows are broadcast up to so many.
BROADCAST_KEYS = 1_000_000

_LEFT: list[Scratch] = []


def fresh(spark: SparkSession, name: str) -> Scratch:
    """The scratch of a stage. The result of the stage before is written when the next one begins, so what it left goes."""
    small_batches(spark)
    while _LEFT:
        _LEFT.pop().clear()
    _LEFT.append(Scratch(spark, name))
    return _LEFT[-1]


def whole_files(df: DataFrame, docs: DataFrame) -> DataFrame:
    """A stage's result in files of some hundred MB at scale, of which each core has two at least."""
    return gathered(df, docs.count(), 50_000)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # own columns may have the names of counts
    out = quality.assess(spark, docs.toDF(*names.values()), names["text"], scratch=fresh(spark, "quality"))
    return whole_files(out.filter("kept").select(*names.values()).toDF(*names), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has; those left without any line go."""
    count, drops = (f"_{uuid.uuid4().hex}" for _ in range(2))
    out = line_dedup.dedup_lines(spark, docs, count=count, drops=drops, scratch=fresh(spark, "lines"))
    out = out.filter((F.col(drops) == 0) | (F.btrim("text", F.lit(WHITE)) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return whole_files(out.select(*(f"`{c}`" for c in docs.columns)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id, a null one first.

    Rows that repeat both doc_id and text are one document, of which one row stays; other rows with one doc_id are told apart.
    Texts don't move: the keys of rows that go or repeat are sought where the texts are read. Only texts of repeated rows meet, and
    all of them if those keys are more than BROADCAST_KEYS.
    """
    key, stays = (f"_{uuid.uuid4().hex}" for _ in range(2))
    scratch = fresh(spark, "near")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    groups = ngram_join.near_duplicates(spark, keyed, key, scratch=scratch).select("id", "component_id").distinct()
    rows = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("id")).groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rows = scratch.table(rows.join(groups, "id"), "rows", dealt=True)
    first = rows.groupBy("component_id").agg(F.min(F.struct("doc_id", "id")).alias("first"))
    marks = rows.join(first, "component_id").filter("id <> first.id or n > 1").select(F.col("id").alias(key), (F.col("id") == F.col("first.id")).alias(stays))
    marks = scratch.table(marks, "marks", dealt=True)
    n, again = marks.agg(F.count("*"), F.count_if(F.col(stays))).first()
    left = keyed.join(F.broadcast(marks) if n <= BROADCAST_KEYS else marks, key, "left").filter(F.coalesce(stays, F.lit(True)))
    if n > BROADCAST_KEYS:
        left = left.dropDuplicates([key])
    elif again:
        left = left.filter(F.col(stays).isNull()).unionByName(left.filter(stays).dropDuplicates([key]))
    return whole_files(left.select(*(f"`{c}`" for c in docs.columns)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences."""
    out = packing.pack_documents(spark, docs, tokenizer("byte_bpe_50k.json"), scratch=fresh(spark, "packing"))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("quality_rules", keep_good), ("line_dedup", drop_lines), ("ngram_jaccard_join", drop_near_duplicates), ("best_fit_packing", pack)]

#: The quality posterior, the fuzzy lines and the token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if last is not None:
            scratch.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
