"""Words of many texts at once, as arrays.

Texts are cut in blocks of bounded bytes; a block is folded with a byte table, cut into
words by comparing bytes, and its words are numbered by Arrow's dictionary encoding, so no
Python object is made for a word. Words are whole byte strings: equal numbers mean equal words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 8 << 20
SPACE, BREAK = 32, 10
_ODD = np.uint64(0x9E3779B97F4A7C15)


def byte_table(space: Iterable[int], breaks: Iterable[int] = ()) -> bytes:
    """A-Z to a-z, ``space`` bytes to a space, ``breaks`` to a newline, all else unchanged."""
    table = bytearray(range(256))
    for c in range(65, 91):
        table[c] = c + 32
    for c in space:
        table[c] = SPACE
    for c in breaks:
        table[c] = BREAK
    return bytes(table)


@dataclass
class Words:
    """Words of some texts: ``vocabulary`` (distinct words), and for every word in turn its number
    there, the number of its text and the number of its piece (texts begin new pieces)."""

    vocabulary: pa.Array
    code: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def words(texts: list[bytes], table: bytes) -> Words:
    joined = b"\n".join(texts).translate(table)
    raw = np.frombuffer(joined, np.uint8)
    inside = (raw != SPACE) & (raw != BREAK)
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts])
    # The newlines between texts may themselves be turned into spaces by ``table``: cut there anyway.
    inside[ends_of_texts[:-1] - 1] = False
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    first, last = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(last - first))).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside].tobytes())])
    coded = flat.dictionary_encode()
    text = np.searchsorted(ends_of_texts, first, side="right")
    breaks = np.flatnonzero(raw == BREAK)
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), text,
                 np.searchsorted(breaks, first) + text)


def blocks(rows: Iterable[tuple[object, bytes]], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(tags, texts) of consecutive rows, cut once ``limit`` bytes are reached; no text is cut."""
    tags, texts, size = [], [], 0
    for tag, text in rows:
        tags.append(tag)
        texts.append(text)
        size += len(text) + 1
        if size >= limit:
            yield tags, texts
            tags, texts, size = [], [], 0
    if texts:
        yield tags, texts


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of every (non-empty) word; for filters only, never for equality."""
    if not len(vocabulary):
        return np.zeros(0, np.uint64)
    bounds = np.frombuffer(vocabulary.buffers()[1], np.int64)[vocabulary.offset:vocabulary.offset + len(vocabulary) + 1]
    raw = np.frombuffer(vocabulary.buffers()[2], np.uint8)[bounds[0]:bounds[-1]].astype(np.uint64)
    length = np.diff(bounds)
    place = np.arange(len(raw)) - np.repeat(bounds[:-1] - bounds[0], length)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(length.max()), _ODD))
        return mix(np.add.reduceat((raw + np.uint64(1)) * powers[place], bounds[:-1] - bounds[0]))
