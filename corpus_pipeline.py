"""A corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents. Nulls, empty texts, repeated rows and empty tables have the
results that the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import n_words, text_or_empty, written
from plumbline.llm.op03_sharding import shard
from plumbline.llm.op05_mixing import mix
from plumbline.llm.op08_decontaminate import decontaminate
from plumbline.llm.op09_jaccard import similar
from plumbline.llm.op10_quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; references are those of docs itself."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links of Jaccard similarity 0.8 connect, the one of the least doc_id; rows that share it stay."""
    kept = similar(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    kept = written(kept, "kept")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs, "source", n_words(text_or_empty("text")))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard of 40, of near equal bytes, and its slot there."""
    text = text_or_empty("text")
    slim = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("bytes"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shard(slim, 40, F.col("bytes"), F.col("text_crc32"), F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]
#: SQL can't express the stages: their random choices and joins are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
