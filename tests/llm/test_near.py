import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import minhash
from lakeloom.llm.components import components
from tests.llm import brute


def near_rows(seed=4, groups=12, copies=6, words=120):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6)))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(c % 4):  # few edits: well above the threshold
                own[rnd.randrange(words)] = word()
            rows.append(" ".join(own))
    rows += [" ".join(word() for _ in range(words)) for _ in range(20)]
    rows += ["one two", "one two", "one  two", None, "", " \n", "x"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def class_of(df, **options):
    return {r["doc_id"]: r["class_id"] for r in minhash.classes(df, **options).collect()}


@pytest.mark.parametrize("chunk", [4096, 3])
def test_classes_match_brute_force(make, chunk):
    rows = near_rows()
    truth = brute.similar_classes(rows)
    first = {}
    for d, t in rows:
        first.setdefault(truth[t or ""], d)
    assert class_of(make(rows), chunk=chunk) == {d: first[truth[t or ""]] for d, t in rows}


def test_one_row_per_class_stays(make):
    rows = near_rows(seed=5, groups=4) + [(3, near_rows(seed=5, groups=4)[3][1]), (None, "null id")]
    df = make(rows).withColumns({"h": F.lit("h"), "rep": F.lit(1), "bands": F.lit(2)})
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(map(str, set(class_of(make(rows)).values())))


def test_empty_table(make):
    assert minhash.classes(make([])).count() == 0 and minhash.keep_one(make([])).count() == 0


def test_equal_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    shingle = np.sort(rng.choice(1 << 47, 600, replace=False).astype(np.uint64))
    level = rng.integers(0, 40, 600)
    a, b = np.arange(600) < 500, np.arange(600) >= 100
    doc = np.concatenate([np.zeros(a.sum()), np.ones(b.sum())]).astype(np.int64)
    weight = np.exp(level / minhash.GRID)
    want = weight[a & b].sum() / weight.sum()
    hits = []
    for turn in range(40):
        own = minhash.mix(shingle * np.uint64(2 * turn + 1)) & np.uint64((1 << 48) - 1)
        s = minhash.signatures(doc, np.concatenate([own[a], own[b]]), np.concatenate([level[a], level[b]]))
        hits.append((s[0] == s[1]).mean())
    assert abs(np.mean(hits) - want ** minhash.ROWS) < 0.08


def test_components_of_chains_and_stars(spark):
    links = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("z", f"s{i}") for i in range(50)] + [("k", "k")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {got[f"c{i:03}"] for i in range(1, 61)} == {"c000"} and "k" not in got
    assert {got.get(f"s{i}", "s0") for i in range(50)} | {got["z"]} == {"s0"}
