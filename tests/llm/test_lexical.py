"""Ranked search against full scoring, and the bounds of NRA."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score long, rank int, item_id long, term string"
ITEMS = "item_id long, text string, doc_id long, item int"


def tables(spark, docs, items):
    return (spark.createDataFrame([(*d, 1, 2, 3, "t") for d in docs], DOCS).repartition(3),
            spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS))


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in set(items):
        wanted = set(terms(text))
        found = []
        for d, c, n in held:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                found.append((-score, d is None, d))
        found.sort()
        out.update((item, r, d, -s) for r, (s, _, d) in enumerate(found[:k], 1))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)] + ["Étude", "ẞ", "X1", "9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return "".join(w + rng.choice([" ", "-", "_", "\x00", "\n"]) for w in rng.choices(vocabulary, weights, k=n))

    docs = [(i, text(rng.randint(0, 60))) for i in range(300)]
    docs += [(5, docs[5][1]), (5, docs[5][1]), (None, docs[5][1]), (400, None), (401, ""), (402, "--"), (403, "t3 " * 100_000)]
    items = [(i, text(rng.randint(1, 25))) for i in range(25)]
    return docs, items + [(3, items[3][1]), (3, "t1 t2"), (90, None), (91, ""), (92, "unknown"), (None, "t5 X1")]


@pytest.mark.parametrize("k", [7, 1000])
def test_matches_full_scoring(spark, k):
    docs, items = corpus(k)
    got = Counter(tuple(r) for r in lexical.search(*tables(spark, docs, items), k=k).collect())
    assert got == brute(docs, items, k)


def test_query_blocks_change_nothing(spark):
    docs, items = corpus(2)
    got = lexical.search(*tables(spark, docs, items), k=9, query_bytes=100)
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, items, 9)


@pytest.mark.parametrize("block_bytes, matrix, depth", [(400, 64, 1), (5000, 1 << 20, 4), (1 << 20, 500, 64)])
def test_layout_changes_nothing(block_bytes, matrix, depth):
    docs, items = corpus(3)
    items = list(dict.fromkeys(items))
    held = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(map(bool, held)), sum(sum(c.values()) for c in held)
    names = sorted({t.encode() for _, text in items for t in terms(text)})
    df = [sum(n.decode() in c for c in held) for n in names]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df])
    own = [np.array(sorted({names.index(t.encode()) for t in terms(text)}), np.int64) for _, text in items]
    block = type("Shared", (), {"value": (names, weights, own)})
    batch = lexical.pa.record_batch([lexical.pa.array([d for d, _ in docs]),
                                     lexical.pa.array([t or "" for _, t in docs])], ["doc_id", "text"])
    out = Counter()
    for found in lexical._searcher(block, 9, n_docs, total, block_bytes, matrix, depth)(iter([batch])):
        for rank, row in enumerate(found.to_pylist(), 1):
            out[(items[row["item"]][0], rank, row["doc_id"], row["score"])] += 1
    assert out == brute(docs, items, 9)


def test_reading_stops_before_the_end_of_the_lists():
    class Read(np.ndarray):
        deepest = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Read.deepest = max(Read.deepest, min(key.stop, len(self)))
            return super().__getitem__(key)

    n = 20_000
    lists = [(np.arange(n), np.concatenate((np.arange(9000, 8990, -1), np.ones(n - 10, np.int64))).view(Read))
             for _ in range(3)]
    place, score = lexical.nra(lists, np.arange(n), 5)
    assert place.tolist() == [0, 1, 2, 3, 4] and score.tolist() == [27000 - 3 * i for i in range(5)]
    assert Read.deepest < n // 10


def test_ties_are_resolved_by_id():
    ids = np.array([9, 2, 7, 4, 1])
    lists = [(np.array([0, 1, 2, 3, 4]), np.array([3, 3, 3, 3, 1])), (np.array([4]), np.array([2]))]
    place, score = lexical.nra(lists, ids, 2)
    assert ids[place].tolist() == [1, 2] and score.tolist() == [3, 3]
    place, score = lexical.nra(lists, ids, 2, least=(3, 2))
    assert ids[place].tolist() == [1, 2]


def test_lengths_whose_products_pass_64_bits():
    got = lexical.impacts(np.array([5]), np.array([3]), np.array([10 ** 9]), 10 ** 12, 10 ** 14)
    m = 50 + 50 * 10 ** 9 * 10 ** 12 // 10 ** 14
    assert got.tolist() == [5 * (3 * 10 ** 9 // (3000 + 20 * m))]


def test_empty_tables(spark):
    docs, items = tables(spark, [(1, "a")], [(1, "a")])
    assert lexical.search(docs.where("false"), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0
    assert lexical.search(docs, items).count() == 1
