"""Texts from tables and files brought to one shape, cut into pieces, and nested readings unrolled.

A text row has ``text_id``, ``origin``, ``caption`` and ``body``. One function cuts text rows
into pieces for both indexes: the plain one over all origins, and the one over distinct
contents, whose ids are those of the content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunk

# Readings per nested record; format of their times.
RECORD_SLOTS = 168
MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"


def text_rows(df: DataFrame, origin: str, keys: list[str], body: str, caption: Column) -> DataFrame:
    """Rows of ``df`` with a non-empty ``body`` as text rows; the id is a hash of origin and keys."""
    key = F.to_json(F.struct(F.lit(origin).alias("origin"), *[F.col(k).cast("string").alias(k) for k in keys]))
    return df.where(F.length(body) > 0).select(
        F.sha2(key, 256).alias("text_id"), F.lit(origin).alias("origin"), caption.alias("caption"),
        F.col(body).alias("body"))


def pieces(texts: DataFrame, policy: str) -> DataFrame:
    """Overlapping pieces of text rows by a chunking policy; a piece's id hashes its text's id
    and its number, so it is the same wherever the text is the same."""
    cut = chunk.explode_chunks(texts, "body", [c for c in texts.columns if c != "body"], policy)
    named = cut.withColumnsRenamed({"chunk_index": "piece_no", "chunk_text": "piece", "word_count": "n_words"})
    piece_id = F.sha2(chunk.chunk_id(F.col("text_id"), F.col("piece_no"), "/"), 256)
    return named.where("n_words > 0").select(piece_id.alias("piece_id"), *named.columns)


def distinct_texts(df: DataFrame, key: str, body: str, origin: str) -> DataFrame:
    """One text row per distinct ``body``: named by its hash, with the least ``key`` and the
    number of copies. Only hashes are grouped; a text travels once, with its least key."""
    hashed = df.where(F.col(body).isNotNull()).select(F.sha2(body, 256).alias("text_id"), F.col(key).alias("first_key"), body)
    groups = hashed.groupBy("text_id").agg(F.min("first_key").alias("first_key"), F.count("*").alias("copies"))
    return groups.join(hashed.withColumnRenamed(body, "body"), ["text_id", "first_key"]).dropDuplicates(["text_id"]).select(
        "text_id", F.lit(origin).alias("origin"), F.concat(F.lit("text "), F.substring("text_id", 1, 12)).alias("caption"),
        "first_key", "copies", "body")


def nested_readings(events: DataFrame) -> DataFrame:
    """Events as records of parallel arrays: one per user and ``RECORD_SLOTS`` consecutive event
    ids, so no record grows with a busy user."""
    slot = F.struct("event_id", F.date_format("ts", MINUTE_FORMAT).alias("at"), "value", "event_type")
    return events.groupBy("user_id", F.expr(f"event_id DIV {RECORD_SLOTS}").alias("record")).agg(
        F.array_sort(F.collect_list(slot)).alias("s")
    ).select("user_id", "record", F.col("s.event_id").alias("ids"), F.col("s.at").alias("times"),
             F.col("s.value").alias("values"), F.col("s.event_type").alias("types"))


def unroll(records: DataFrame) -> DataFrame:
    """One row per reading: the position is unrolled once and picks from every array."""
    at = records.select("*", F.posexplode("times").alias("k", "time")).withColumn(
        "at", F.try_to_timestamp("time", F.lit(MINUTE_FORMAT))).where("at IS NOT NULL")
    return at.select(
        "user_id", F.get("ids", "k").alias("event_id"), F.col("at").cast("timestamp_ntz").alias("minute_at"),
        F.col("at").cast("date").alias("day"), F.hour("at").alias("hour"), F.get("values", "k").alias("reading"),
        F.get("types", "k").alias("kind")).withColumn("state", state_of(F.col("kind"), F.col("reading")))


def state_of(kind: Column, reading: Column) -> Column:
    """State of a reading: errors are faults, else the level whose bounds hold it."""
    level = F.when(reading <= 0, "idle").when(reading < 25, "quiet").when(reading < 75, "active").when(
        reading >= 75, "peak").otherwise("idle")
    return F.when(kind.eqNullSafe(F.lit("error")), "fault").otherwise(level)
