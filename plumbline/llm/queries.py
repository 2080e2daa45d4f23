"""The queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import n_words, text_or_empty
from .op01_tokens import op1_tokens
from .op02_extract import op2_extract
from .op03_sharding import op3_sharding
from .op04_lm import op4_lm
from .op05_mixing import copies, op5_mixing
from .op06_warc import op6_warc
from .op07_chat import op7_chat
from .op08_decontaminate import op8_decontamination
from .op09_jaccard import op9_jaccard
from .op10_quality import BASE, op10_quality
from .oracles import ORACLES  # noqa: F401


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_sharding_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op3_sharding's rows."""
    return op3_sharding(spark, sf_dir).select("doc_id", "size", "law")


def llm_mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets of op5_mixing's sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", n_words(text_or_empty("text")).alias("size"))
    return copies(docs, "source", F.col("size")).select("source", "source_size", F.round("target", 3).alias("target")).distinct()


def llm_quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and rules of op10_quality."""
    return op10_quality(spark, sf_dir).select("doc_id", *BASE, "base_failed")


def llm_lm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of op4_lm's texts."""
    return op4_lm(spark, sf_dir).select("doc_id", "n_tokens")


QUERIES = {f.__name__: f for f in (op1_tokens, op2_extract, op3_sharding, op4_lm, op5_mixing, op6_warc, op7_chat, op8_decontamination, op9_jaccard, op10_quality, pipeline, llm_sharding_sizes, llm_mixing_targets, llm_quality_base, llm_lm_counts)}
