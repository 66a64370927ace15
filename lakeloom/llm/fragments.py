"""Finding all repeated windows of a corpus by content-anchored fragments.

A window is ``k`` consecutive symbols (bytes or words) of one document. Two equal windows
must meet in one task, however large the corpus, without shuffling every window:

* The anchor of a window is the least hash among its ``m``-grams, a function of the
  window's content alone. Consecutive windows mostly share their anchor; such a run is one
  *fragment* (the run's windows overlap, so it is little longer than a window).
* Documents are dealt to groups by a hash of their id (the only time texts move). Each group
  counts its anchors; the counts meet per anchor, and each group learns which of its anchors
  occur elsewhere too. An anchor that occurs once marks windows that occur once, so nothing
  more happens to them.
* Fragments of shared anchors go, once per distinct content and group, to the block that
  owns the anchor. There an operator compares real contents (no hash decides) and answers
  which windows have an earlier twin.
* An anchor found in very many groups (a stock phrase in ever different surroundings) would
  make one block grow with the corpus; windows of such anchors are dealt by a hash of the
  whole window instead. Equal windows still meet, results are the same.

Steps are one lazy plan: the three reads of the dealt texts share one shuffle. A group or
block is bounded by the sizes chosen from the input's size; long texts and large blocks are
worked on piece by piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

GROUP_BYTES = 4 << 20  # compressed input per group
HOT_GROUPS = 4096
PIECE = 1 << 20  # symbols worked on at a time
NO_ID = -(1 << 63)  # stands for a null doc_id; sorts first

# Odd multipliers for mixing 64-bit values.
MULT = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
BYTE_HASH = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= MIX
    x ^= x >> np.uint64(27)
    return x


def gram_hashes(x: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all runs of ``m`` symbols, by doubling the length of a polynomial hash."""
    if len(x) < m:
        return np.empty(0, np.uint64)
    power = lambda e: np.uint64(pow(int(MULT), e, 1 << 64))
    cur, size, acc, done = x, 1, None, 0
    while True:
        if m & size:
            if acc is None:
                acc = cur
            else:
                n = len(x) - done - size + 1
                acc = acc[:n] * power(size) + cur[done:done + n]
            done += size
        if done == m:
            return mix(acc[:len(x) - m + 1].copy())
        cur = cur[:-size] * power(size) + cur[size:]
        size *= 2


def sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over all runs of ``w`` values."""
    if len(x) < w:
        return np.empty(0, x.dtype)
    cur, size = x, 1
    while 2 * size <= w:
        cur = pick(cur[:-size], cur[size:])
        size *= 2
    return cur if size == w else pick(cur[:len(x) - w + 1], cur[w - size:])


@dataclass
class Corpus:
    """A group's documents as one line of symbols; document ``i`` is [bounds[i], bounds[i + 1])."""

    bounds: np.ndarray
    hashes: Callable[[int, int], np.ndarray]  # symbol hashes of a stretch
    content: Callable[[int, int], bytes]  # the symbols of a stretch, as bytes

    @property
    def size(self) -> int:
        return int(self.bounds[-1])


def scan(corpus: Corpus, k: int, m: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: (first window, anchor of each window or 0 where no window fits, position
    hashes of the piece, whether a position is some window's anchor)."""
    w = k - m + 1
    for lo in range(0, max(corpus.size - k + 1, 0), PIECE):
        hi = min(lo + PIECE, corpus.size - k + 1)  # windows lo to hi - 1
        back = max(lo - (w - 1), 0)
        grams = gram_hashes(corpus.hashes(back, hi + k - 1), m) | np.uint64(2)
        grams &= ~np.uint64(1)
        anchors = sliding(grams, w, np.minimum)
        # Windows must not cross the end of a document.
        ends = corpus.bounds[1:]
        ends = ends[(ends > back) & (ends < hi + k)]
        crossing = np.zeros(len(anchors) + 1, np.int32)
        starts = np.maximum(ends - k + 1, np.concatenate([[0], ends])[:len(ends)]) - back
        inside = np.clip(starts, 0, len(anchors))
        np.add.at(crossing, inside, 1)
        np.add.at(crossing, np.clip(ends - back, 0, len(anchors)), -1)
        anchors[np.cumsum(crossing[:-1]) > 0] = 0
        # A position is an anchor if the largest of the windows' minima over it is its own hash.
        padded = np.concatenate([np.zeros(w - 1, np.uint64), anchors, np.zeros(w - 1, np.uint64)])
        is_anchor = sliding(padded, w, np.maximum) == grams
        first = lo - back
        last = len(grams) if hi == corpus.size - k + 1 else hi - back
        yield lo, anchors[first:], grams[first:last], is_anchor[first:last]


def anchor_counts(corpus: Corpus, k: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors and at how many positions (or, for one symbol line, places) each stands."""
    found = [grams[is_anchor] for _, _, grams, is_anchor in scan(corpus, k, m)]
    return np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)


def fragment_runs(corpus: Corpus, k: int, m: int, shared: np.ndarray, hot: np.ndarray,
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, key) of the runs under shared anchors, in order."""
    out = []
    for lo, anchors, _, _ in scan(corpus, k, m):
        cut = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        first = np.concatenate([[0], cut])
        length = np.diff(np.concatenate([first, [len(anchors)]]))
        key = anchors[first]
        keep = np.isin(key, shared) & (key > 0)
        first, length, key = first[keep], length[keep], key[keep]
        if len(hot) and (split := np.isin(key, hot)).any():
            starts = np.concatenate([np.arange(a, a + n) for a, n in zip(first[split], length[split])])
            whole = gram_hashes(corpus.hashes(lo, min(lo + len(anchors) + k - 1, corpus.size)), k)[starts] | np.uint64(1)
            first = np.concatenate([first[~split], starts])
            length = np.concatenate([length[~split], np.ones(len(starts), length.dtype)])
            key = np.concatenate([key[~split], whole])
            order = np.argsort(first, kind="stable")
            first, length, key = first[order], length[order], key[order]
        out.append((first + lo, length, key))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate([x[i] for x in out]) for i in range(3))


@dataclass
class Classes:
    """Distinct fragment contents of a group, by first occurrence."""

    content: list[bytes]
    key: list[int]
    first: list[int]  # place of the first occurrence
    length: list[int]
    runs: list[tuple[int, int]]  # (class, place) of every run, in order


def classes(corpus: Corpus, k: int, m: int, shared: np.ndarray, hot: np.ndarray) -> Classes:
    own, out = {}, Classes([], [], [], [], [])
    for at, n, key in zip(*[x.tolist() for x in fragment_runs(corpus, k, m, shared, hot)]):
        content = corpus.content(at, at + n + k - 1)
        c = own.setdefault((key, content), len(out.key))
        if c == len(out.key):
            out.content.append(content)
            out.key.append(key)
            out.first.append(at)
            out.length.append(n)
        out.runs.append((c, at))
    return out


def _uint64(blobs) -> np.ndarray:
    parts = [np.frombuffer(b, np.uint64) for b in blobs if b]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


class Documents:
    """A group's rows in the order of their ids."""

    def __init__(self, table: pa.Table):
        ids = [NO_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]

    def out_ids(self) -> list:
        return [None if i == NO_ID else i for i in self.ids.tolist()]


BLOCK_FIELDS = [("block", pa.int64()), ("g", pa.int64()), ("cls", pa.list_(pa.int32())), ("key", pa.list_(pa.int64())),
                ("doc", pa.list_(pa.int64())), ("ord", pa.list_(pa.int64())), ("at", pa.list_(pa.int64())),
                ("content", pa.list_(pa.binary()))]
ANSWER_FIELDS = [("g", pa.int64()), ("whole", pa.list_(pa.int32())), ("cls", pa.list_(pa.int32())),
                 ("win", pa.list_(pa.int32()))]


def _ddl(fields) -> str:
    names = {pa.int64(): "long", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>",
             pa.list_(pa.binary()): "array<binary>", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{n} {names[t]}" for n, t in fields)


def _rows(rows: list[dict], fields) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=pa.schema(fields))


def repeated_windows(docs: DataFrame, k: int, m: int, load: Callable[[Documents], Corpus], judge: Callable,
                     finish: Callable, out_fields: list, by_position: bool, hot_groups: int = HOT_GROUPS,
                     group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Run the steps of the module's docstring over ``docs`` (doc_id, text).

    ``load`` turns a group's documents into a line of symbols. ``judge(contents, keys, docs,
    ords, ats)`` gets a piece of a block (distinct contents with their first places, ordered)
    and yields (content number, window numbers) of windows with an earlier twin. ``finish``
    makes the result of a group from (documents, corpus, repeated first windows). With
    ``by_position`` a repeat inside one document counts as well.
    """
    common.small_batches(docs.sparkSession)
    n_parts = common.parts_for(docs, group_bytes)
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2 * n_parts)).alias("g"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    ).repartition(n_parts, "g")

    def count(table: pa.Table) -> pa.Table:
        own = Documents(table)
        corpus = load(own)
        g = table.column("g")[0].as_py()
        if by_position:
            keys, n = anchor_counts(corpus, k, m)
        else:  # a key counts once per document id
            pairs = [np.empty((0, 2), np.uint64)]
            for lo, _, grams, is_anchor in scan(corpus, k, m):
                at = np.flatnonzero(is_anchor)
                doc = own.ids[np.searchsorted(corpus.bounds, at + lo, side="right") - 1]
                pairs.append(np.stack([grams[at], doc.view(np.uint64)], 1))
            both = np.concatenate(pairs)
            both = both[np.lexsort((both[:, 1], both[:, 0]))]
            new = np.ones(len(both), bool)
            new[1:] = (both[1:] != both[:-1]).any(1)
            keys, n = np.unique(both[new][:, 0], return_counts=True)
        keys = keys | (n > 1).astype(np.uint64)
        bucket = ((keys >> np.uint64(1)) * MULT >> np.uint64(33)) % np.uint64(n_parts)
        order = np.argsort(bucket, kind="stable")
        keys, bucket = keys[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        rows = [{"bucket": int(b[0]), "g": g, "keys": part.tobytes()}
                for b, part in zip(np.split(bucket, cut), np.split(keys, cut)) if len(part)]
        return _rows(rows, [("bucket", pa.int64()), ("g", pa.int64()), ("keys", pa.binary())])

    def share(table: pa.Table) -> pa.Table:
        groups, blobs = table.column("g").to_pylist(), table.column("keys").to_pylist()
        keys = _uint64(blobs)
        own, inverse, n = np.unique(keys >> np.uint64(1), return_inverse=True, return_counts=True)
        several = (n > 1)[inverse] | (keys & np.uint64(1)).astype(bool)
        answer = (keys & ~np.uint64(1)) | (n > hot_groups)[inverse].astype(np.uint64)
        ends = np.cumsum([len(b) // 8 for b in blobs])
        rows = [{"g": g, "keys": x[s].tobytes()} for g, x, s in zip(groups, np.split(answer, ends[:-1]), np.split(several, ends[:-1])) if s.any()]
        return _rows(rows, [("g", pa.int64()), ("keys", pa.binary())])

    def shared_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys = _uint64(table.column("keys").to_pylist())
        plain = keys & ~np.uint64(1)
        return np.sort(plain), np.sort(plain[(keys & np.uint64(1)) > 0])

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([], BLOCK_FIELDS)
        own = Documents(left)
        corpus = load(own)
        found = classes(corpus, k, m, *shared_keys(right))
        g = left.column("g")[0].as_py()
        doc = np.searchsorted(corpus.bounds, found.first, side="right") - 1
        rows: dict[int, dict] = {}
        for c, (content, key, at, d) in enumerate(zip(found.content, found.key, found.first, doc.tolist())):
            block = ((key >> 1) * int(MULT) % (1 << 64) >> 33) % n_parts
            row = rows.setdefault(block, {"block": block, "g": g, "cls": [], "key": [], "doc": [], "ord": [], "at": [],
                                          "content": []})
            row["cls"].append(c)
            row["key"].append(key - (1 << 63))
            row["doc"].append(int(own.ids[d]))
            row["ord"].append(d)
            row["at"].append(at)
            row["content"].append(content)
        return _rows(list(rows.values()), BLOCK_FIELDS)

    def decide(table: pa.Table) -> pa.Table:
        flat = {n: table.column(n).combine_chunks().flatten() for n, _ in BLOCK_FIELDS[2:]}
        sizes = table.column("cls").combine_chunks().value_lengths().to_numpy()
        g = np.repeat(table.column("g").to_numpy(), sizes)
        cls, key, doc, ord_, at = (flat[n].to_numpy() for n in ("cls", "key", "doc", "ord", "at"))
        order = np.lexsort((at, ord_, doc, key))
        whole: dict[int, list[int]] = {}
        part: dict[int, tuple[list[int], list[int]]] = {}

        def piece(rows: list[int]) -> None:
            """Rows of whole keys, ordered by key and place: the first of equal contents owns it."""
            owner: dict[tuple[int, bytes], int] = {}
            for i in rows:
                o = owner.setdefault((int(key[i]), flat["content"][i].as_py()), i)
                if o != i and (by_position or doc[o] != doc[i]):
                    whole.setdefault(int(g[i]), []).append(int(cls[i]))
            owners = list(owner.values())
            for c, windows in judge([x[1] for x in owner], key[owners], doc[owners], ord_[owners], at[owners]):
                lists = part.setdefault(int(g[owners[c]]), ([], []))
                lists[0].extend([int(cls[owners[c]])] * len(windows))
                lists[1].extend(windows)

        held, size, last = [], 0, None
        for i in order.tolist():
            if size > PIECE and key[i] != last:
                piece(held)
                held, size = [], 0
            held.append(i)
            size += len(flat["content"][i].as_buffer())
            last = key[i]
        piece(held)
        rows = [{"g": x, "whole": whole.get(x, []), "cls": part.get(x, ([], []))[0], "win": part.get(x, ([], []))[1]}
                for x in sorted(whole.keys() | part.keys())]
        return _rows(rows, ANSWER_FIELDS)

    def apply(left: pa.Table, shared: pa.Table, answers: pa.Table) -> pa.Table:
        own = Documents(left)
        corpus = load(own)
        repeated = np.zeros(corpus.size + 1, bool)
        if shared.num_rows:
            found = classes(corpus, k, m, *shared_keys(shared))
            whole = set()
            windows: dict[int, list[int]] = {}
            for row in answers.to_pylist():
                whole.update(row["whole"])
                for c, x in zip(row["cls"], row["win"]):
                    windows.setdefault(c, []).append(x)
            doc = own.ids[np.searchsorted(corpus.bounds, [at for _, at in found.runs], side="right") - 1]
            first_doc = own.ids[np.searchsorted(corpus.bounds, found.first, side="right") - 1]
            for (c, at), d in zip(found.runs, doc):
                later = at != found.first[c] if by_position else d != first_doc[c]
                if c in whole or later:
                    repeated[at:at + found.length[c]] = True
                elif c in windows:
                    repeated[at + np.array(windows[c])] = True
        return finish(own, corpus, np.flatnonzero(repeated))

    counted = dealt.groupBy("g").applyInArrow(count, "bucket long, g long, keys binary")
    shared = counted.groupBy("bucket").applyInArrow(share, "g long, keys binary")
    # What a group gets back, both kinds in one table: its shared keys (kind 0), the answers (1).
    sent = dealt.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(send, _ddl(BLOCK_FIELDS))
    answers = sent.groupBy("block").applyInArrow(decide, _ddl(ANSWER_FIELDS))
    back = shared.select("g", "keys", F.lit(None).cast("array<int>").alias("whole"),
                         F.lit(None).cast("array<int>").alias("cls"), F.lit(None).cast("array<int>").alias("win")
                         ).unionByName(answers.select("g", F.lit(None).cast("binary").alias("keys"), "whole", "cls", "win"))

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows([], out_fields)
        is_keys = pa.compute.is_valid(right.column("keys"))
        return apply(left, right.filter(is_keys), right.filter(pa.compute.invert(is_keys)))

    return dealt.groupBy("g").cogroup(back.groupBy("g")).applyInArrow(last, _ddl(out_fields))
