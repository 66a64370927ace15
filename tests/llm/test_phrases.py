"""Phrase mining against a plain version: all phrases counted, scored and dropped by definition."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, a long, bar long, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute(rows, top, min_count):
    out = set()
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, 5):
                    f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in held.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 80 * f[p[i:i + k]]:
                        gone.add(p[i:i + k])
        found = []
        for p, a in held.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "ß", "NUL\x00L", "x\x1fy"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    stock = [rng.choices(vocabulary, k=rng.randint(2, 6)) for _ in range(12)]
    rows = []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(1, 40):
            words += rng.choice(stock) if rng.random() < 0.3 else rng.choices(vocabulary, weights)
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ! "]) for w in words)
        rows.append((text, rng.choice(["aa", "aa", "aa", "bb", None, "und"])))
    return rows + [(None, "aa"), ("", "bb"), (" ,,. ", None), ("lone", "cc"), ("a a a a a a a a", "dd")]


@pytest.mark.parametrize("top", [5, 5000])
def test_matches_brute_force(spark, top):
    rows = corpus(top)
    got = phrases.mine(docs(spark, rows), top=top, min_count=4)
    assert {tuple(r) for r in got.collect()} == brute(rows, top, 4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_lower_bars_are_taken_until_settled(spark, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(phrases, "BAR_RANKS", (1, 2))
    got = {tuple(r) for r in phrases.mine(docs(spark, rows), top=12, min_count=4).collect()}
    assert got == brute(rows, 12, 4)


def test_a_longer_phrase_whose_other_part_is_below_the_bar_still_drops(spark, monkeypatch):
    # "end of world now" holds each "end of world"; "of world now" lies below the bar, as "of" and "now" are frequent.
    rows = [("end of world now", "aa")] * 10 + [("of", "aa"), ("now", "aa")] * 500
    rows += [(f"left{i} right{i}", "aa") for i in range(8) for _ in range(9)]
    monkeypatch.setattr(phrases, "BAR_RANKS", (1,))
    got = {tuple(r) for r in phrases.mine(docs(spark, rows), top=3, min_count=4).collect()}
    assert got == brute(rows, 3, 4)


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_counts_with_a_sieve_that_holds_nothing_back(size):
    texts = [t or "" for t, _ in corpus(9, 100)]
    everything = type("Shared", (), {"value": np.full(1 << 16, 15, np.uint8)})
    batch = pa.record_batch([pa.array(["l"] * len(texts)), pa.array(texts)], ["lang", "text"])
    got = Counter()
    for found in phrases._counter(size, everything)(iter([batch])):
        got.update({r["phrase"]: r["a"] for r in found.to_pylist()})
    f, n = Counter(), 0
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n += len(w)
            f.update(" ".join(w[i:i + size]) for i in range(len(w) - size + 1))
    assert got == (f + Counter({None: n}) if size == 1 else f)


def test_very_long_text_and_hot_phrase(spark):
    rows = [("new york city " * 100_000 + "x " * 1000, "aa"), ("x" * 1_000_000, "aa")]
    got = {tuple(r) for r in phrases.mine(docs(spark, rows), top=50, min_count=30).collect()}
    assert got == brute(rows, 50, 30)


def test_empty_table(spark):
    assert phrases.mine(docs(spark, [("a", "b")]).where("false")).count() == 0


def test_products_beyond_64_bits(spark):
    big = 9 * 10 ** 15
    counts = {1: spark.createDataFrame([("l", "a", big), ("l", "b", big + 1)], phrases.COUNTS),
              2: spark.createDataFrame([("l", "a b", big - 7)], phrases.COUNTS)}
    row = phrases._scored(counts[2], counts, 2).first()
    assert row["score"] == 2000000 * (big - 7) // (2 * big + 1)
