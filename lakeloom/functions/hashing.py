"""Content hashes and deterministic buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(*cols: Column, sep: str = "::") -> Column:
    """SHA-256 of the joined values: the same content gives the same id anywhere."""
    return F.sha2(F.concat_ws(sep, *[c.cast("string") for c in cols]), 256)


def sha_bucket(*cols: Column, buckets: int = 100) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of SHA-256 of the row's values.

    Equal to DuckDB's ``CAST(('0x' || substr(sha256(..), 1, 8)) AS UBIGINT) % n``,
    so the split can be checked by an independent engine.
    """
    digest = F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256)
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def murmur_bucket(*cols: Column, buckets: int = 100) -> Column:
    """Bucket from Spark's murmur3 ``hash``; widened first so ``abs`` cannot overflow."""
    return (F.abs(F.hash(*cols).cast("bigint")) % F.lit(buckets)).cast("int")
