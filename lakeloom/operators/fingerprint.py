"""Layout-independent output fingerprints.

Each row is brought to a canonical form, serialised, hashed with SHA-256, and the first 60 bits of every
row hash are summed exactly. A sum is order-free and — unlike XOR — does not cancel duplicate rows. The
column names and types are hashed in too, so a type change changes the fingerprint.

Canonical form, at every depth: fields in name order with NULLs kept, maps as entries in key order,
floating-point numbers as text that tells any two of them apart: as a decimal of ten places where
that is exact, else (tiny, huge, not a number) in the shortest digits that give the number back.
Zero has no sign, and all NaNs are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_signature(df: DataFrame) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))


def _number(c: Column, kind: str) -> Column:
    decimal = c.try_cast("decimal(38,10)")
    return F.when(decimal.cast(kind) == c, decimal.cast("string")).otherwise(F.concat(F.lit("b"), c.cast("string")))


def _changes(kind: T.DataType) -> bool:
    """Whether a type holds anything whose serialised form is not canonical yet."""
    if isinstance(kind, T.StructType):
        return True
    if isinstance(kind, T.ArrayType):
        return _changes(kind.elementType)
    return isinstance(kind, (T.DoubleType, T.FloatType, T.MapType))


def canonical(c: Column, kind: T.DataType) -> Column:
    """The canonical form of a value of type ``kind``."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _number(c, kind.typeName())
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[canonical(c.getField(f.name), f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType) and _changes(kind.elementType):
        return F.transform(c, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)  # keys are unique, so they alone decide
    return c


def row_hash(df: DataFrame):
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    own = [canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]
    js = F.to_json(F.struct(*own), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.sha2(js, 256), 1, 15), 16, 10).cast("decimal(20,0)")


def fingerprint(df: DataFrame, signature: str | None = None) -> DataFrame:
    """One row: ``n_rows``, ``row_hash_sum`` and ``fingerprint`` (SHA-256 of all three parts)."""
    sig = signature if signature is not None else schema_signature(df)
    agg = df.select(row_hash(df).alias("_h")).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("_h"), F.lit(0)).cast("decimal(38,0)").alias("row_hash_sum"))
    return agg.select(
        "n_rows", "row_hash_sum",
        F.sha2(F.concat_ws(":", F.lit(sig), F.col("n_rows").cast("string"), F.col("row_hash_sum").cast("string")),
               256).alias("fingerprint"),
    )


def layout_check(df: DataFrame) -> DataFrame:
    """Fingerprint the same rows as scanned, dealt by hash and cut into ranges; expect one value."""
    sig = schema_signature(df)
    keys = sorted(df.columns)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    layouts = [df, df.repartition(n, *keys), df.repartitionByRange(n, keys[0])]
    parts = [fingerprint(x, sig) for x in layouts]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(
        F.count("*").alias("n_layouts"),
        F.count_distinct("fingerprint").alias("n_distinct"),
        F.min("fingerprint").alias("fingerprint"),
        F.min("n_rows").alias("n_rows"),
    )
