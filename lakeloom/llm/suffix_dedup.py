"""Suffix-array dedup: two-stage suffix sorting and adjacent common prefixes.

A byte is removed if it lies in a string of 100 bytes that also starts earlier: in a document
with a smaller doc_id, or before in the same one. Blocks of text that can hold equal strings
are brought together by content (see ``fragments``). A block's suffixes are sorted in two
stages: only suffixes smaller than their successors are sorted directly (by their first 100
bytes, eight at a time); a scan over the buckets of first bytes, from small to large, then
induces the others, each standing before its successor in the text. Neighbours in the suffix
array with a common prefix of 100 bytes are equal strings; the earliest place stays.

Real bytes decide, hashes only choose the block. Null and empty texts have no bytes. Rows with
equal doc_id follow each other in the order of their texts as one document would, so a repeated
row is removed. Null ids come first. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .fragments import BYTE_HASH, Corpus, Documents, repeated_windows

NAME = "op10_suffix_dedup"
LENGTH = 100
ANCHOR = 32
END = 255  # closes a content; no byte of UTF-8

ORACLE = None  # byte-wise strings of every place are too slow in SQL; tests hold it against brute force


def load(docs: Documents) -> Corpus:
    """The group's bytes on one line."""
    line = b"".join(docs.texts)
    codes = np.frombuffer(line, np.uint8)
    return Corpus(np.cumsum([0, *map(len, docs.texts)]), lambda a, b: BYTE_HASH[codes[a:b]], lambda a, b: line[a:b])


def words_of(text: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from every place as one number (the text padded so that depth bytes follow)."""
    x = np.concatenate([text, np.full(depth + 8, END, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        x = (x[:-size] << np.uint64(8 * size)) | x[size:]
    return x


def sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by their first ``depth`` bytes; equal ones stand together."""
    order = places[np.argsort(words[places], kind="stable")]
    value = words[order]
    new = np.concatenate([[True], value[1:] != value[:-1]]) if len(order) else np.empty(0, bool)
    for at in range(8, depth, 8):
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        value = words[order[rows] + at]
        by = np.lexsort((value, group[rows]))
        order[rows] = order[rows][by]
        value = value[by]
        new[rows[1:]] |= (value[1:] != value[:-1]) & (group[rows[1:]] == group[rows[:-1]])
    return order


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    # Smaller than the successor: the next different byte is larger. The last suffix is not.
    differs = np.append(text[1:] != text[:-1], True)
    nearest = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    smaller = np.append(text, 0)[nearest + 1] > text
    smaller[nearest == n - 1] = False
    direct = sort_directly(np.flatnonzero(smaller), words, depth)
    ends = np.searchsorted(text[direct], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    fronts[text[-1]].append(np.array([n - 1]))
    out = []
    for c in np.flatnonzero(np.bincount(text, minlength=256)).tolist():
        induced = np.concatenate(fronts[c]) if fronts[c] else np.empty(0, np.int64)
        bucket = [induced]
        while len(induced):  # runs of the same byte: each round is one byte further to the left
            before = induced[induced > 0] - 1
            induced = before[text[before] == c]
            bucket.append(induced)
        scanned = np.concatenate([*bucket, direct[ends[c]:ends[c + 1]]])
        before = scanned[scanned > 0] - 1
        before = before[text[before] > c]
        order = np.argsort(text[before], kind="stable")
        before = before[order]
        cut = np.flatnonzero(np.diff(text[before])) + 1
        for part in np.split(before, cut) if len(before) else ():
            fronts[text[part[0]]].append(part)
        out.append(scanned)
    return np.concatenate(out)


def equal_neighbours(suffixes: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Whether the common prefix of each suffix with the one before it reaches ``depth`` bytes."""
    equal = np.zeros(len(suffixes), bool)
    rows = np.arange(1, len(suffixes))
    for at in [*range(0, depth - 7, 8), depth - 8]:
        rows = rows[words[suffixes[rows] + at] == words[suffixes[rows - 1] + at]]
    equal[rows] = True
    return equal


def _may_repeat_itself(content: bytes) -> bool:
    """Two equal strings inside one content overlap so far that its middle occurs twice."""
    shift = len(content) - LENGTH
    return shift >= LENGTH - ANCHOR or content.find(content[shift:LENGTH]) != shift


def judge(contents: list[bytes], keys, docs, ords, ats) -> Iterator[tuple[int, list[int]]]:
    """Strings of the contents that start earlier in a content of the piece."""
    keys = np.asarray(keys)
    alone = np.ones(len(keys), bool)  # the only content of its key has no twin but in itself
    alone[1:] &= keys[1:] != keys[:-1]
    alone[:-1] &= keys[1:] != keys[:-1]
    own = [i for i in range(len(contents)) if not alone[i] or _may_repeat_itself(contents[i])]
    if not own:
        return
    sizes = np.array([len(contents[i]) + 1 for i in own])
    text = np.frombuffer(b"".join(contents[i] + bytes([END]) for i in own), np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    of = np.repeat(np.arange(len(own)), sizes)
    offset = np.arange(len(text)) - starts[of]
    words = words_of(text, LENGTH)
    suffixes = suffix_array(text, words, LENGTH)
    suffixes = suffixes[offset[suffixes] + LENGTH < sizes[of[suffixes]]]
    equal = equal_neighbours(suffixes, words, LENGTH)
    group = np.cumsum(~equal)
    several = equal.copy()
    several[:-1] |= equal[1:]
    suffixes, group = suffixes[several], group[several]
    c = of[suffixes]
    rows = np.array(own)[c]
    order = np.lexsort((np.asarray(ats)[rows] + offset[suffixes], np.asarray(ords)[rows], np.asarray(docs)[rows], group))
    later = np.zeros(len(order), bool)
    later[1:] = group[order][1:] == group[order][:-1]
    late = suffixes[order[later]]
    by = np.argsort(of[late], kind="stable")
    late = late[by]
    cut = np.flatnonzero(np.diff(of[late])) + 1
    for part in np.split(late, cut) if len(late) else ():
        yield own[of[part[0]]], offset[part].tolist()


OUT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
       ("kept", pa.binary())]


def finish(docs: Documents, corpus: Corpus, repeated: np.ndarray) -> pa.Table:
    change = np.zeros(corpus.size + 1, np.int32)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    rows = []
    for i, (doc_id, text) in enumerate(zip(docs.out_ids(), docs.texts)):
        own = gone[corpus.bounds[i]:corpus.bounds[i + 1]]
        spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
        kept = np.frombuffer(text, np.uint8)[~own].tobytes() if spans else text
        rows.append({"doc_id": doc_id, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": spans,
                     "kept": kept})
    return pa.Table.from_pylist(rows, schema=pa.schema(OUT))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` are the remaining bytes."""
    return repeated_windows(docs, LENGTH, ANCHOR, load, judge, finish, OUT, by_position=True, **options)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document and the digest of what is kept."""
    return dedup(common.documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
