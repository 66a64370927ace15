"""JSON documents with a declared schema (never inferred from a sample)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_json(text: Column, schema_ddl: str) -> Column:
    """Parse a JSON text column with a declared schema; malformed input gives NULL fields."""
    return F.from_json(text, schema_ddl, {"mode": "PERMISSIVE"})


def read_json(spark: SparkSession, path: str, schema_ddl: str, multiline: bool = False) -> DataFrame:
    return spark.read.schema(schema_ddl).option("multiLine", str(multiline).lower()).json(path)
