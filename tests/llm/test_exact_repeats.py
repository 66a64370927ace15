import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.llm import substring_dedup, suffix_dedup
from lakeloom.llm.fragments import gram_hashes, sliding
from tests.llm import brute

# A hot threshold of 0 sends every shared anchor's windows one by one.
MODES = [{}, {"hot_groups": 0}]


def texts(seed, n=40, words=60):
    """Documents that share passages of many lengths, inside and between each other."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdé", k=rnd.randint(1, 6)))
    base = [[word() for _ in range(words)] for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            b = rnd.choice(base)
            a = rnd.randrange(len(b))
            parts += b[a:a + rnd.randint(1, 40)] if rnd.random() < 0.7 else [word() for _ in range(rnd.randint(1, 20))]
        rows.append((i * 7 % n, " ".join(parts) + ("\n\t x" if i % 3 else "")))
    rows += [(n, "aaaa " * 60), (n + 1, "a" * 350), (n + 2, None), (n + 3, ""), (n + 4, rows[3][1]), (n + 5, rows[3][1] + " tail"),
             (5, rows[5][1]), (None, rows[7][1]), (n + 6, " \n ")]
    return rows


def substring_rows(df, **options):
    out = substring_dedup.dedup(df, **options)
    return Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256)).collect())


def suffix_rows(df, **options):
    out = suffix_dedup.dedup(df, **options)
    return Counter(tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


@pytest.mark.parametrize("options", MODES)
def test_substring_dedup_matches_brute_force(make, options):
    rows = texts(1)
    assert substring_rows(make(rows), **options) == brute.substring(rows)


@pytest.mark.parametrize("options", MODES)
def test_suffix_dedup_matches_brute_force(make, options):
    rows = texts(2)
    assert suffix_rows(make(rows), **options) == brute.suffix(rows)


def test_empty_tables_and_clashing_columns(make, spark):
    none = make([])
    assert substring_rows(none) == suffix_rows(none) == Counter()
    rows = [(1, "w " * 40), (2, "w " * 40)]
    df = make(rows).withColumns({"g": F.lit(1), "keys": F.lit("k"), "block": F.lit(2), "kept": F.lit(0)})
    assert substring_rows(df) == brute.substring(rows) and suffix_rows(df) == brute.suffix(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=400), st.integers(1, 40))
def test_two_stage_order(values, depth):
    text = np.array(values, np.uint8)
    words = suffix_dedup.words_of(text, 100)
    got = suffix_dedup.suffix_array(text, words, depth).tolist()
    assert sorted(got) == list(range(len(values)))
    padded = bytes(text) + b"\xff" * 200
    cut = depth - depth % 8 if depth >= 8 else 0
    keys = [padded[i:i + cut] for i in got if i + depth <= len(values)]
    assert keys == sorted(keys)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80), st.integers(1, 12))
def test_hashes_and_sliding_values(values, m):
    x = np.array(values, np.uint64)
    grams = gram_hashes(x, m)
    assert len(grams) == max(0, len(values) - m + 1)
    by = {}
    for i, h in enumerate(grams.tolist()):
        assert by.setdefault(tuple(values[i:i + m]), h) == h
    assert len(set(by.values())) == len(by)
    assert sliding(x, m, np.minimum).tolist() == [min(values[i:i + m]) for i in range(len(values) - m + 1)]


def test_factors_extend_and_reopen_at_their_end():
    block = substring_dedup.Reference(3)
    block.add(b"a b c d e".split())
    block.add(b"d e f g".split())
    got = list(block.factors(b"x a b c d e f g y".split()))
    assert [(i, n) for i, n, _, _ in got] == [(1, 5), (4, 4)]  # the second straddles the end of the first


def test_pieces_of_a_line_give_the_same_windows(monkeypatch, make):
    from lakeloom.llm import fragments

    rows = texts(3, n=12)
    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    corpus = suffix_dedup.load(fragments.Documents(table))
    whole = fragments.anchor_counts(corpus, 100, 32)
    monkeypatch.setattr(fragments, "PIECE", 97)
    cut = fragments.anchor_counts(corpus, 100, 32)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()
