import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.operators import embed
from lakeloom.operators.embed import batch_embed, fit_hashed_tfidf, with_embedding


def test_hook_keeps_order_and_batches(spark):
    def letters(texts):
        assert len(texts) <= 16
        return [[float(len(t)), float(t.count("a"))] for t in texts]

    df = spark.createDataFrame([(i, "a" * i) for i in range(40)], "id long, text string")
    got = {r["id"]: r["embedding"] for r in batch_embed(df, letters, "id", "text", batch_size=16).collect()}
    assert got == {i: [float(i), float(i)] for i in range(40)}


def test_hook_rejects_count_mismatch(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, text string")
    with pytest.raises(Exception, match="EmbeddingCountMismatch|got 0 vectors"):
        batch_embed(df, lambda ts: [], "id", "text").collect()


def test_hook_rejects_other_dimensions_and_takes_null_texts(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, text string")
    assert {r["id"]: r["embedding"] for r in batch_embed(df, lambda ts: [[len(t)] for t in ts], "id", "text").collect()} \
        == {1: [1.0], 2: [0.0]}
    with pytest.raises(Exception, match="expected dimension 3"):
        batch_embed(df, lambda ts: [[1.0, 2.0] for _ in ts], "id", "text", dim=3).collect()


def test_hashed_tfidf_equals_a_plain_version(spark):
    texts = {1: "Red red apples\u00a0fall", 2: "red \u00c9tudes", 3: "", 4: None, 5: "apples " * 50}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    model = fit_hashed_tfidf(df, "text", 32)
    place = lambda w: zlib.crc32(w.encode()) % 32
    bags = {i: Counter(place(w) for w in (t or "").lower().split()) for i, t in texts.items()}
    idf = [math.log(6 / (sum(p in b for b in bags.values()) + 1)) for p in range(32)]
    assert model.idf == pytest.approx(idf)
    for r in with_embedding(df, model, "text", dim=32).collect():
        plain = [bags[r["id"]][p] * idf[p] for p in range(32)]
        norm = math.sqrt(sum(v * v for v in plain)) or 1.0
        assert r["embedding"] == pytest.approx([v / norm for v in plain], abs=1e-6)


def test_vectors_of_many_calls_come_back_as_one_batch(spark):
    """Calls hold ``batch_size`` texts, but Arrow batches are Spark's: per-call batches cost most of the time."""
    df = spark.range(40).selectExpr("id", "repeat('a', int(id)) AS text").coalesce(1)
    plan = batch_embed(df, lambda ts: [[float(len(t))] for t in ts], "id", "text")
    assert "predict" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["embedding"] for r in plan.collect()} == {i: [float(i)] for i in range(40)}
    assert batch_embed(df.where("false"), lambda ts: [], "id", "text").count() == 0


def test_words_are_hashed_together_and_as_one_by_one(monkeypatch):
    """A call per word took most of the time of fitting and embedding; only very long words get one."""
    odd = [c for c in map(chr, range(0x3100)) if c.isspace()] + list("aBZ\u00c9\u0130\u03a3\u65e5\U0001f600.\x00\x7f\x84")
    texts = ["".join(odd[(i * j + j // 7) % len(odd)] for j in range(i)) for i in range(0, 90, 3)]
    texts += ["", " ", "x" * 48, "y" * 49 + " z", "\u00e9" * 40 + "\u2003Q", "a\x1cb\x85c"]
    calls = []
    monkeypatch.setattr(embed.zlib, "crc32", lambda w, crc=zlib.crc32: calls.append(w) or crc(w))
    got = {dim: embed._bags(texts, dim) for dim in (1, 32, 1009)}
    monkeypatch.undo()
    assert calls and all(len(w) > embed._LONGEST for w in calls)
    for dim, bags in got.items():
        want = np.zeros((len(texts), dim), int)
        for i, text in enumerate(texts):
            for w in text.lower().split():
                want[i, zlib.crc32(w.encode()) % dim] += 1
        assert (bags == want).all()
    assert embed._bags([], 4).shape == (0, 4)
