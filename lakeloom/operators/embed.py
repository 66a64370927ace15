"""Embedding on executors: a function that each Python worker gets once, fed ordered batches.

:func:`batch_embed` applies any ``list[str] -> list[vector]`` function in calls of at most ``batch_size``
texts. Every call must return exactly one vector per text (a short or long answer fails the task instead
of shifting vectors onto the wrong rows). Vectors go back to Spark as one Arrow array per Arrow batch, not
per call. :class:`HashedTfidf` is such a function, fitted by one pass whose tasks return one count per place.
"""

from __future__ import annotations

import zlib
from typing import Callable, Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EmbedFn = Callable[[Sequence[str]], Sequence[Sequence[float]]]

# Fixed value: the largest batch the embedding service accepts.
MAX_BATCH = 16
FIT_BATCH = 256  # texts counted at once while fitting


class EmbeddingCountMismatch(RuntimeError):
    pass


def batch_embed(df: DataFrame, fn: EmbedFn, id_col: str, text_col: str, batch_size: int = MAX_BATCH,
                dim: int | None = None) -> DataFrame:
    """``(id_col, embedding array<float>, embedding_dim int)`` for every row of ``df``; a null text is an empty one."""
    return with_embedding(df.select(id_col, text_col), fn, text_col, batch_size, dim).select(
        id_col, "embedding", F.size("embedding").alias("embedding_dim"))


def with_embedding(df: DataFrame, fn: EmbedFn, text_col: str, batch_size: int = MAX_BATCH,
                   dim: int | None = None) -> DataFrame:
    """``df`` plus ``embedding``; the other columns don't pass through Python."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")

    def vectors(texts: list[str], width: int | None) -> np.ndarray:
        out = fn(texts)
        whole = isinstance(out, np.ndarray) and out.ndim == 2
        out = out.astype(np.float32) if whole else [np.asarray(v, dtype=np.float32) for v in out]
        if len(out) != len(texts):
            raise EmbeddingCountMismatch(f"sent {len(texts)} texts, got {len(out)} vectors")
        if len({len(v) for v in out} | ({width} if width is not None else set())) > 1:
            raise EmbeddingCountMismatch(f"expected dimension {width or len(out[0])}")
        return out if whole else np.stack(out)

    @F.arrow_udf("array<float>")
    def embed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts, found = column.to_pylist(), []
            for i in range(0, len(texts), batch_size):
                found.append(vectors(texts[i:i + batch_size], len(found[0][0]) if found else dim))
            width = len(found[0][0]) if found else 0
            flat = np.concatenate(found).ravel() if found else np.zeros(0, np.float32)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * width, pa.int32()), pa.array(flat))

    return df.withColumn("embedding", embed(F.coalesce(F.col(text_col), F.lit(""))))


# Whatever str.split() parts words at: above ASCII, and within it as a table to blanks and small letters.
_WIDE_SPACES = [c for c in map(chr, range(0x80, 0x10000)) if c.isspace()]
_PLAIN = bytes(b if b >= 0x80 else 32 if chr(b).isspace() else ord(chr(b).lower()) for b in range(256))


def _coded(text: str) -> bytes:
    """The lower-case text in UTF-8, with blanks for all whitespace."""
    if not text.isascii():
        text = text.lower()
        for c in _WIDE_SPACES:
            if c in text:
                text = text.replace(c, " ")
    return text.encode().translate(_PLAIN)


def _crc_parts(longest: int) -> tuple[np.ndarray, np.ndarray]:
    """A word's CRC-32 is the exclusive or of a part per byte, which depends on the byte and on how many follow it,
    and of the CRC-32 of as many zero bytes."""
    zeros = [zlib.crc32(bytes(n)) for n in range(longest + 1)]
    parts = [zlib.crc32(bytes([b]) + bytes(k)) ^ zeros[k + 1] for k in range(longest) for b in range(256)]
    return np.array(parts, np.uint32), np.array(zeros, np.uint32)


_LONGEST = 48  # bytes; longer words are summed one by one
_PARTS, _ZEROS = _crc_parts(_LONGEST)


def _bags(texts: Sequence[str], dim: int) -> np.ndarray:
    """How often each text's words fall on each place, a word's CRC-32 modulo ``dim``: one row per text.

    All words of the texts are summed at once, as runs of bytes between blanks: none becomes a string.
    """
    coded = [_coded(t) for t in texts]
    together = b" ".join([b"", *coded, b"."])  # the dot closes the last word's run and is no word
    raw = np.frombuffer(together, np.uint8)
    blank = raw == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, last, runs = edges[:-1:2], edges[1::2] - 1, edges[::2].copy()
    if not len(starts):
        return np.zeros((len(coded), dim), np.int64)
    # Row and column of each byte's part; those of blanks are any, as only sums within words are read.
    runs[0] = 0
    at = np.repeat(last << 8, runs[1:] - runs[:-1])
    at -= np.arange(0, len(at) << 8, 256)
    at += raw[:len(at)]
    summed = np.bitwise_xor.accumulate(_PARTS.take(at, mode="clip"))
    sizes = last - starts + 1
    sums = summed[last] ^ summed[starts - 1] ^ _ZEROS.take(sizes, mode="clip")
    if sizes.max() > _LONGEST:
        for i in np.flatnonzero(sizes > _LONGEST).tolist():
            sums[i] = zlib.crc32(together[starts[i]:last[i] + 1])
    first = np.searchsorted(starts, np.cumsum([1] + [len(c) + 1 for c in coded]))
    places = sums.astype(np.int64) % dim + np.repeat(np.arange(len(coded)) * dim, np.diff(first))
    return np.bincount(places, minlength=len(coded) * dim).reshape(len(coded), dim)


class HashedTfidf(NamedTuple):
    """Lower-case words hashed to ``len(idf)`` places, weighed by rarity, scaled to length 1.

    A text without words has a vector of zeros.
    """

    idf: list[float]

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = _bags(texts, len(self.idf)) * np.asarray(self.idf)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1.0)


def fit_hashed_tfidf(corpus: DataFrame, text_col: str, dim: int) -> HashedTfidf:
    """idf = ln((n + 1) / (df + 1)) per hashed place; ``dim + 1`` counts, from one aggregate, reach the driver."""
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(dim + 1, np.int64)  # the last one counts texts
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i in range(0, len(texts), FIT_BATCH):
                counts[:dim] += (_bags(texts[i:i + FIT_BATCH], dim) > 0).sum(0)
            counts[dim] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1, dtype=np.int32)), pa.array(counts)], ["place", "n"])

    texts = corpus.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = np.zeros(dim + 1)
    for r in texts.mapInArrow(held, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    return HashedTfidf(np.log((counts[dim] + 1) / (counts[:dim] + 1)).tolist())
