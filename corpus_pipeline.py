"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

``STAGES`` are (name, function) with function(spark, docs, sf_dir) -> DataFrame;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright.llm import common, decontam, linededup, packing, quality, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.classify(docs.select(*COLUMNS), common.table(spark, sf_dir, "labels")).where("keep").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text."""
    cleaned = linededup.clean(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group stays.

    Rows are told apart by a hash of (doc_id, text), so null and repeated ids
    are grouped by their own texts; rows equal in both count as copies.  Rows
    that only share the hash stay.
    """
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    groups = simhash.near_duplicates(docs.select(key.alias("doc_id"), "text"), shingle=4, distance=4)
    ids = docs.select(key.alias("_key"), "doc_id").groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("id"))
    parts = groups.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
    rows = common.cut(ids.join(parts, "_key"))
    first = (rows.groupBy("low").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "_key")).alias("x"))
             .select(F.col("x._key").alias("_key")))
    gone = rows.where("low = high").join(first, "_key", "left_anti")
    repeated = rows.where("n > 1").join(gone, "_key", "left_anti").select("_key")
    marked = docs.withColumn("_key", key)
    once = marked.join(gone.select("_key").unionByName(repeated), "_key", "left_anti")
    copies = marked.join(repeated, "_key", "left_semi").dropDuplicates(["_key", "doc_id", "text"])
    return once.unionByName(copies).select(*COLUMNS)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontam.hits(docs, common.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(found, docs["doc_id"] == found["_gone"], "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_dup_stage),
          ("decontamination", decontam_stage), ("packing", packing_stage)]

#: no SQL: perplexities, fingerprints and token ids are not SQL-expressible
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written below spark.checkpoint.dir and read again."""
    common.prepare(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
