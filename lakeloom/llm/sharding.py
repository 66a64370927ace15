"""Sharding: proportional stratified interleaving.

The rows of each source are put in a seeded random order and numbered; a row's fractional
rank is its number over the size of its source. Sorted by fractional rank, every stretch of
the order holds the sources in the proportions of the whole, so cutting the order into
equal counts gives shards that all match the mixture (the law is ``rows``: the counts of
two shards differ by one at most). A source-wise random phase keeps small sources from
meeting at the same fractions.

Only DataFrame functions are used. Both numberings (within the source, and over all) run
by slices of the order (``ordering.running_before``), so a source with a third of all rows
is spread over as many tasks as any other.

Null texts have one byte (the closing one); null sources form a source of their own; rows
that are equal in all of (doc_id, source, text) are interchangeable and each gets a place.
The caller's columns are kept; the operator's own names replace equal ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .ordering import SLICE_DIGITS, digest, fraction, running_before

NAME = "op3_sharding"
SHARDS = 16
SEED = 20240

# The CRC-32 table (polynomial 0xEDB88320) is built by rule.
ORACLE = f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab
  FROM range(256) r(b)),
d AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) AS text_crc32,
         md5(concat_ws('|', '{SEED}', coalesce(cast(doc_id AS varchar), ''), md5(coalesce(text, '')))) AS k,
         ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(source, ''))), 1, 8))::UBIGINT::DOUBLE
           / 4294967296.0 AS phase
  FROM documents, crc),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id) AS rn,
             count(*) OVER (PARTITION BY source) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (rn - phase) / n, source NULLS FIRST, k, doc_id) - 1 AS pos,
             count(*) OVER () AS total FROM r),
s AS (SELECT *, (pos * {SHARDS}) // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, cast(shard AS int) AS shard,
       cast(pos - (shard * total + {SHARDS - 1}) // {SHARDS} AS bigint) AS slot, cast(NULL AS int) AS grown_shard
FROM s
"""

PLACE = ("shard", "slot")


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, source: str = "source") -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard)."""
    taken = {c.lower() for c in docs.columns}
    tag = "__shard"
    while any(c.startswith(tag) for c in taken):
        tag += "_"
    key, part, frac, cut = f"{tag}_key", f"{tag}_part", f"{tag}_frac", f"{tag}_cut"
    rank, n, pos, total = f"{tag}_rank", f"{tag}_n", f"{tag}_pos", f"{tag}_total"
    rows = docs.drop(*[c for c in docs.columns if c.lower() in PLACE]).withColumn(
        key, digest(seed, F.col("doc_id"), F.col("text"))
    ).withColumn(part, F.substring(key, 1, SLICE_DIGITS))
    ranked = running_before(rows, [source], part, [F.col(key), F.col("doc_id")], F.lit(1), rank, n)
    phase = fraction(digest(seed, F.col(source)))
    placed = ranked.withColumn(frac, (F.col(rank) + 1 - phase) / F.col(n)).withColumn(
        cut, F.least(F.floor(F.col(frac) * 16 ** SLICE_DIGITS), F.lit(16 ** SLICE_DIGITS - 1)))
    placed = running_before(
        placed, [], cut, [F.col(frac), F.col(source), F.col(key), F.col("doc_id")], F.lit(1), pos, total)
    shard = F.expr(f"(`{pos}` * {shards}) DIV `{total}`")
    return placed.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.expr(f"`{pos}` - (cast(shard AS long) * `{total}` + {shards - 1}) DIV {shards}"),
    ).drop(key, part, frac, cut, rank, n, pos, total)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the ``rows`` law."""
    docs = common.documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    narrow = common.staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("text"),  # tells texts apart in the order; stands in for the text
    ), "shard-rows")
    return assign(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
