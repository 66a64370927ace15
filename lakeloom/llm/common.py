"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import DEFAULT_BROADCAST_BYTES, estimated_bytes, parts_for  # noqa: F401
from ..session import scratch_path

# Word patterns (maximal runs outside these separators).
SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column, separators: str) -> Column:
    """Words of ``text`` between runs of ``separators``; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z, all else unchanged (``lower`` equals that on pure ASCII and is cheaper)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Hand texts to Python in batches of at most ``rows`` (never raises a smaller setting)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key, "10000"))
    if current <= 0 or current > rows:
        spark.conf.set(key, str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table folder in the shared checkpoint folder and read it back.

    Cuts the lineage in storage that outlives executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(table: DataFrame) -> bool:
    """Whether a table that was just written is within the broadcast bound."""
    return estimated_bytes(table) <= DEFAULT_BROADCAST_BYTES


def match(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join large ``rows`` with a table that was just written (its files' size is known):
    broadcast within the bound, else by shuffle. The large side is never broadcast."""
    return rows.join(F.broadcast(table) if is_small(table) else table.hint("merge"), on, how)
