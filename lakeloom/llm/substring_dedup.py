"""Substring dedup: relative Lempel-Ziv parsing against indexed reference blocks.

A passage is a duplicate if it is made of windows of thirteen words that a document with a
smaller doc_id holds too. The corpus is its own reference, cut by content into blocks (see
``fragments``): a block indexes every window of its fragments. Each document's fragments are
factored greedily against the block that can hold their windows: at a place, the index gives
the earliest copy, the match is extended as far as it goes, and that factor, if at least a
window long, is a duplicate span. A factor's end may cut a window that another copy holds in
full, so parsing goes on at the first window that straddles the end. A document is thus held
against every block that shares a window with it; other blocks could give no long factor.

Words compare as bytes; hashes only choose the block. Null and blank texts have no words.
Rows with equal doc_id count as one document, of which nothing is smaller. Null ids come
first. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .fragments import MULT, Corpus, Documents, mix, repeated_windows

NAME = "op2_substring_dedup"
WINDOW = 13
ANCHOR = 6

ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
wins AS (
  SELECT u, doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x
  FROM (SELECT u, doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM d WHERE len(w) >= {WINDOW})),
dup AS (SELECT u, i FROM (SELECT u, i, doc_id, min(doc_id) OVER (PARTITION BY x) AS m FROM wins) WHERE m < doc_id),
gone AS (SELECT u, list(DISTINCT p) AS ps
         FROM (SELECT u, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM dup) GROUP BY u),
kept AS (
  SELECT u, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT u, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d)
  WHERE (u, p) NOT IN (SELECT u, unnest(ps) FROM gone) GROUP BY u)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(len(ps), 0) AS bigint) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (u) LEFT JOIN kept USING (u)
"""


def load(docs: Documents) -> Corpus:
    """The group's words on one line."""
    per_doc = [t.split() for t in docs.texts]  # splits bytes at ASCII whitespace only
    words = [w for ws in per_doc for w in ws]
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    corpus = Corpus(np.cumsum([0, *map(len, per_doc)]), lambda a, b: mix(codes[a:b] * MULT + MULT),
                    lambda a, b: b" ".join(words[a:b]))
    corpus.words = per_doc
    return corpus


class Reference:
    """The index of a block: the earliest place of every window."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.texts: list[list[bytes]] = []
        self.places: dict[tuple, tuple[int, int]] = {}

    def add(self, words: list[bytes]) -> None:
        self.texts.append(words)
        for i in range(len(words) - self.window + 1):
            self.places.setdefault(tuple(words[i:i + self.window]), (len(self.texts) - 1, i))

    def factors(self, words: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, reference text, place there) of the long factors, left to right."""
        i = 0
        while i + self.window <= len(words):
            place = self.places.get(tuple(words[i:i + self.window]))
            if place is None:
                i += 1
                continue
            source, at = self.texts[place[0]], place[1]
            n = self.window
            while i + n < len(words) and at + n < len(source) and words[i + n] == source[at + n]:
                n += 1
            yield i, n, *place
            i += n - self.window + 1  # windows across the factor's end are still open


def judge(contents: list[bytes], keys, docs, ords, ats) -> Iterator[tuple[int, list[int]]]:
    """Windows that a content of the same key from a smaller doc_id holds."""
    for _, same in groupby(range(len(contents)), key=lambda i: keys[i]):
        same = list(same)
        if len(same) == 1:
            continue
        block = Reference()
        for _, own in groupby(same, key=lambda i: docs[i]):  # contents come in the order of doc_id
            texts = []
            for i in own:
                words = contents[i].split(b" ")
                texts.append(words)
                windows = [w for at, n, _, _ in block.factors(words) for w in range(at, at + n - WINDOW + 1)]
                if windows:
                    yield i, windows
            for words in texts:
                block.add(words)


def finish(docs: Documents, corpus: Corpus, repeated: np.ndarray) -> pa.Table:
    change = np.zeros(corpus.size + 1, np.int32)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + WINDOW, -1)
    gone = np.cumsum(change[:-1]) > 0
    rows = []
    for i, (doc_id, words) in enumerate(zip(docs.out_ids(), corpus.words)):
        own = gone[corpus.bounds[i]:corpus.bounds[i + 1]]
        kept = [w for w, x in zip(words, own.tolist()) if not x] if own.any() else words
        rows.append({"doc_id": doc_id, "n_words": len(words), "n_removed": len(words) - len(kept),
                     "kept": b" ".join(kept)})
    return pa.Table.from_pylist(rows, schema=pa.schema(OUT))


OUT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())]


def dedup(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, text): every document without its duplicate spans."""
    found = repeated_windows(docs, WINDOW, ANCHOR, load, judge, finish, OUT, by_position=False, **options)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document and the digest of what is kept."""
    return dedup(common.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
