"""Overlapping word windows, computed with native array expressions (no Python UDF).

Two policies exist side by side:

* ``stop_at_end`` — windows of ``size`` words every ``size - overlap`` words,
  stopping after the first window that reaches the last word; blank text gives
  no chunk. Count = ``1 + max(0, ceil((n - size) / step))`` for ``n > 0``.
* ``fixed_step`` — a window at every start ``0, step, 2*step, ... <= n - 1``;
  the last windows may lie inside earlier ones.

Words follow Python's ``str.split()``: empty strings are never words, so text
that ends in a newline does not gain a trailing empty word, and blank text has
no words (a plain ``split(trim(text), '\\s+')`` would give one empty word).

Each row builds its chunk array once (one ``transform`` over the start
positions) and explodes it, so the word array is not copied per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import content_id
from ..functions.text import words

# Window length and overlap in words.
CHUNK_WORDS = 120
OVERLAP_WORDS = 30


def stop_at_end_count(n: Column, size: int = CHUNK_WORDS, overlap: int = OVERLAP_WORDS) -> Column:
    step = size - overlap
    return F.when(n <= 0, F.lit(0)).otherwise(
        F.lit(1) + F.greatest(F.lit(0), F.ceil((n - F.lit(size)) / F.lit(step)).cast("int")))


def chunk_array(ws: Column, policy: str = "stop_at_end", size: int = CHUNK_WORDS,
                overlap: int = OVERLAP_WORDS) -> Column:
    """``array<struct<chunk_index:int, chunk_text:string, word_count:int>>`` from a word array.

    ``ws`` must be a column reference (not an expression): the lambda below reads
    it once per window, and an expression there would be re-evaluated per window.
    """
    step = size - overlap
    n = F.size(ws)
    if policy == "stop_at_end":
        count = stop_at_end_count(n, size, overlap)
    elif policy == "fixed_step":
        count = F.when(n > 0, F.floor((n - 1) / F.lit(step)).cast("int") + 1).otherwise(F.lit(0))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    idx = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        idx,
        lambda i: F.struct(
            i.alias("chunk_index"),
            F.array_join(F.slice(ws, i * step + 1, size), " ").alias("chunk_text"),
            F.least(F.lit(size), n - i * step).alias("word_count"),
        ),
    )


def explode_chunks(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                   policy: str = "stop_at_end") -> DataFrame:
    """One row per chunk, carrying the ``keep`` columns of its document.

    Words are split once per document into a column; chunk texts are then cut
    from that array, so the cost is linear in the text length.
    """
    keep = keep or []
    with_words = docs.select(*keep, words(F.col(text_col)).alias("_ws"))
    return (
        with_words.select(*keep, F.explode(chunk_array(F.col("_ws"), policy)).alias("_c"))
        .select(*keep, "_c.chunk_index", "_c.chunk_text", "_c.word_count")
    )


def chunk_id(doc_id: Column, index: Column, sep: str = "::") -> Column:
    return F.concat_ws(sep, doc_id.cast("string"), index.cast("string"))


def content_chunk_id(doc_id: Column, index: Column) -> Column:
    """Content-derived chunk id: the same chunk of the same text has the same id anywhere."""
    return content_id(doc_id, index, sep="#")
