"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as
Parquet in the shared folder and reads again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import common, decontaminate, minhash, mixing, quality, sharding


def _as(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``docs``; the number of characters follows the text."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of the others go."""
    return _as(docs, quality.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in whole documents."""
    return mixing.draw(docs).select(docs.columns)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.assign(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mixing),
    ("sharding", shard_assignment),
]

ORACLE_SQL = None  # weighted sampling has no SQL form; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
