"""License scans: fuzzy search for short notices.

Each notice may be found with up to ``k`` edits. By the pigeonhole principle a text
within ``k`` edits of a notice holds one of its ``k + 1`` pieces unchanged, so an
automaton over all pieces yields every place worth a look; there the bounded-error
matching of ``regex`` decides, counts the edits and gives the span. Work is linear in
the text and needs no shuffle. Three exact phrases (the base) are counted beside it.

Null and empty texts have no words, no places and score 0. Repeated rows are scanned
each on its own. Extra columns of the input are dropped, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

NAME = "op9_license_scan"
ORACLE = None  # bounded-error matching has no SQL form; tests hold it against brute force

# Exact phrases and their labels.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Short notices (lower-case words) and their labels; edits allowed: one in EDIT_SHARE characters.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the gnu general public license version", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("licensed under the creative commons attribution", "cc-by"),
    ("licensed under cc by", "cc-by"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved by the author", "reserved"),
)
EDIT_SHARE = 12

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first:long,last:long,edits:int>>"
)

# Bytes that belong to words stay (A-Z folded); every other byte becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normalise(text: bytes) -> tuple[int, bytes]:
    """(number of words, the words each between single spaces)."""
    words = text.translate(_FOLD).split()
    return len(words), b" " + b" ".join(words) + b" "


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` near-equal pieces of the notice with their offsets."""
    n = len(notice)
    cuts = [i * n // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeFinder:
    """The automaton over all pieces and one bounded-error pattern per notice."""

    def __init__(self, notices=NOTICES, edit_share: int = EDIT_SHARE):
        import ahocorasick
        import regex

        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, label) in enumerate(notices):
            edits = len(notice) // edit_share
            pattern = regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}")
            self.notices.append((notice, label, edits, pattern))
            for offset, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, similarity) of notices in a normalised text."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for k, offset in uses:
                notice, _, edits, _ = self.notices[k]
                start = end + 1 - length - offset
                lo, hi = max(0, start - edits), start + len(notice) + edits
                own = windows.setdefault(k, [])
                # A long text's places arrive in order of their ends; starts may step back a little.
                if own and lo <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(lo, own[-1][0]), max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        found = []
        for k, spans in windows.items():
            notice, label, _, pattern = self.notices[k]
            for lo, hi in spans:
                while (m := pattern.search(text, lo, min(hi, len(text)))) and m.end() > m.start():
                    edits = sum(m.fuzzy_counts)
                    found.append((label, m.start(), m.end(), edits, 1 - edits / len(notice)))
                    lo = m.end()
        return sorted(found, key=lambda x: (x[1], x[2], x[0], x[3]))


def word_numbers(norm: bytes, places: list[int]) -> dict[int, int]:
    """Number of the word at, or after the space at, each place of a normalised text."""
    numbers, n, past = {}, 0, 0
    for at in sorted(set(places)):
        n += norm.count(b" ", past, at + 1)
        past = at + 1
        numbers[at] = n - 1
    return numbers


def scan_text(text: bytes, finder: NoticeFinder) -> dict:
    n_words, norm = normalise(text)
    base, labels = [], set()
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at = norm.find(needle)
        while at >= 0:
            base.append(at)
            labels.add(label)
            at = norm.find(needle, at + 1)
    fuzzy = finder.find(norm.decode("latin-1"))
    number = word_numbers(norm, base + [x[1] for x in fuzzy] + [x[2] - 1 for x in fuzzy])
    starts = [number[at] for at in base]
    spans = [{"label": label, "first": number[a], "last": number[b - 1] - (norm[b - 1:b] == b" "), "edits": edits}
             for label, a, b, edits, _ in fuzzy]
    return {
        "n_words": n_words, "n_base": len(starts),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(labels)),
        "labels": ",".join(sorted(labels | {x[0] for x in fuzzy})),
        "score": 1.0 if starts else max((x[4] for x in fuzzy), default=0.0),
        "spans": spans,
    }


def scan(docs: DataFrame, notices=NOTICES, edit_share: int = EDIT_SHARE) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): base counts, labels, score, spans."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(notices, edit_share)
        span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int32())])
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
            ("score", pa.float64()), ("spans", pa.list_(span)),
        ])
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            rows = [{"doc_id": i} | scan_text(t.as_py() or b"", finder) for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.selectExpr("cast(doc_id as long) AS doc_id", "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license places, labels and score."""
    return scan(common.documents(spark, sf_dir))
