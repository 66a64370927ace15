"""Sparse retrieval equals plain scoring of every text."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.operators import postings


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(questions, corpus, k):
    held = {(did, at): Counter(split(text)) for at, (did, text) in enumerate(corpus) if did is not None and split(text)}
    df = Counter(t for c in held.values() for t in c)
    idf = {t: math.floor(1000 * math.log((len(held) + 1) / n)) for t, n in df.items()}

    def weights(counts):
        raw = {t: n * idf.get(t, 0) for t, n in counts.items() if idf.get(t, 0) > 0}
        length = math.sqrt(sum(r * r for r in raw.values()))
        return {t: math.floor(r * postings.UNIT / length) for t, r in raw.items()}

    docs = {d: weights(c) for d, c in held.items()}
    asked = defaultdict(Counter)
    for qid, text in questions:
        if qid is not None:
            asked[qid].update(split(text))
    out = {}
    for qid, counts in asked.items():
        own = weights(counts)
        points = ((d, sum(w * own.get(t, 0) for t, w in ws.items())) for d, ws in docs.items())
        best = sorted(((-p, d) for d, p in points if p > 0))[:k]
        if best:
            out[qid] = [(d[0], -p) for p, d in best]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r["query_id"]]) + 1 and r["score"] == pytest.approx(r["points"] / 1e12)
        out[r["query_id"]].append((r["doc_id"], r["points"]))
    return dict(out)


def frames(spark, questions, corpus):
    return (spark.createDataFrame(questions, "query_id string, text string"),
            spark.createDataFrame(corpus, "doc_id long, text string"))


def test_best_texts_equal_plain_scoring(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]  # w0 stands in most texts
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    corpus = [(i, text(rng.randint(1, 40))) for i in range(400)]
    corpus += [(1000 + i, corpus[7][1].upper()) for i in range(9)]  # ties beyond k
    corpus += [(2000, ""), (2001, None), (2002, "--- !!"), (None, "w1 w2"), (3, "w250 w251"), (2003, "w0 " * 30_000 + "w299")]
    questions = [(f"q{i}", text(rng.randint(1, 12))) for i in range(25)]
    questions += [("same", corpus[7][1]), ("none", "unknown words"), ("blank", ""), ("null", None), (None, "w1"), ("often", "w0 w1 w2")]
    q, d = frames(spark, questions, corpus)
    index = postings.build(d)
    want = brute(questions, corpus, 4)
    for probe in (1, 60, 10**6):
        assert found(postings.topk(q, index, 4, probe_rows=probe)) == want
    assert found(postings.topk(q, index, 1000)) == brute(questions, corpus, 1000)


def test_lists_of_frequent_words_are_left_out(spark):
    rng = random.Random(5)
    corpus = [(i, "the of and " + " ".join(rng.choices("abcdefghij", k=6))) for i in range(300)]
    corpus += [(1000 + i, "the of rare special word") for i in range(6)] + [(2000, "zebra")]
    questions = [("q", "the and of rare special word")]
    q, d = frames(spark, questions, corpus)
    index = postings.build(d)
    assert found(postings.topk(q, index, 3)) == brute(questions, corpus, 3)
    assert postings.read_share(q, index, 3) < 0.1


def test_nothing_indexed_or_asked(spark):
    q, d = frames(spark, [("q", "a b")], [(1, "a b"), (2, "c")])
    empty = d.where("false")
    assert postings.topk(q, postings.build(empty), 3).count() == 0
    assert postings.topk(q.where("false"), postings.build(d), 3).count() == 0
    assert postings.read_share(q.where("false"), postings.build(d), 3) == 0.0
    assert found(postings.topk(q, postings.build(d), 3)) == {"q": [(1, brute([("q", "a b")], [(1, "a b"), (2, "c")], 3)["q"][0][1])]}


def test_the_vocabulary_is_not_broadcast(spark, monkeypatch):
    corpus = [(i, f"all {'most' if i % 2 else 'some'} own{i}") for i in range(200)]
    q, d = frames(spark, [("q", "all most own7 own8")], corpus)
    monkeypatch.setattr(postings, "FREQUENT", 10)
    index = postings.build(d)
    counted = postings._counted(d, "doc_id", "text", "did")
    plan = postings._rarities(counted, index.lists)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert postings._rarities(counted, index.lists).count() == 600
    want = brute([("q", "all most own7 own8")], corpus, 3)
    assert found(postings.topk(q, index, 3)) == want
    monkeypatch.setattr(postings, "ASKED_BYTES", 0)
    assert found(postings.topk(q, index, 3)) == want


def test_terms_are_counted_in_blocks(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choices("aBZz09 -\u00e9\u65e5\U0001f600.\x7f{`[@/:\n", k=rng.randint(0, 14))) for _ in range(300)]
    texts += [None, "", "abc", "def", "", "x" * 90, None]
    for own, column in ((texts, pa.array(["zz", *texts, "q"]).slice(1, len(texts))), ([], pa.array([], pa.string())),
                        ([None], pa.array([None], pa.string())), (texts, pa.array(texts, pa.large_string()))):
        found, term, place, tf = postings._term_counts(column)
        got = defaultdict(Counter)
        for t, p, n in zip(term.tolist(), place.tolist(), tf.tolist()):
            got[p][found[t].as_py()] += n
        assert got == {i: Counter(split(x)) for i, x in enumerate(own) if split(x)}
    monkeypatch.setattr(postings, "BLOCK_BYTES", 40)
    rows = pa.table([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    for size in (1, 7, 1000):
        blocks = list(postings._sliced(iter(rows.to_batches(max_chunksize=size))))
        assert pa.Table.from_batches(blocks).equals(rows) and len(blocks) > 20
        lengths = [[len((x or "").encode()) for x in b.column(1).to_pylist()] for b in blocks]
        assert all(sum(n) <= 40 or len(n) == 1 for n in lengths)


def test_sums_of_squares_of_any_size():
    raw, place = np.array([3, 4, 5, 4 * 10**9 + 1, 2 * 10**9 + 3]), np.array([0, 0, 2, 3, 3])
    want = [25.0, 0.0, 25.0, float((4 * 10**9 + 1) ** 2 + (2 * 10**9 + 3) ** 2)]
    assert postings._squares(raw, place).tolist() == want
    assert postings._squares(raw[:0], place[:0]).tolist() == []


def test_no_table_has_a_row_per_text_and_term(spark, monkeypatch):
    """Counts and postings were shuffled and written one by one, which took most of the disk and time of an index."""
    corpus = [(i, f"all {'most' if i % 2 else 'some'} own{i}") for i in range(200)]
    q, d = frames(spark, [("q", "all most own7 own8")], corpus)
    held, plain = [], postings.landed
    monkeypatch.setattr(postings, "landed", lambda df, name: held.append((name, plain(df, name))) or held[-1][1])
    index = postings.build(d.repartition(3))
    sizes = {name: rows.count() for name, rows in held}
    assert sizes == {"term-counts": 200 + 200 + 3 * 3, "terms": 203, "postings": 200 + 3 * 3, "lists": 203}
    assert postings._unpacked(index.postings).count() == 600
    assert found(postings.topk(q, index, 3)) == brute([("q", "all most own7 own8")], corpus, 3)


def test_neither_vocabulary_nor_lookups_are_broadcast_under_any_bound(spark, monkeypatch):
    """Lookups of every text in reach, with all terms left out, filled the driver under Spark's usual bound."""
    corpus = [(i, f"all {'most' if i % 2 else 'some'} own{i}") for i in range(200)]
    q, d = frames(spark, [("q", "all most own7 own8")], corpus)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    try:
        plans, plain = {}, postings.landed
        monkeypatch.setattr(postings, "landed", lambda df, name: plans.update({name: plan(df)}) or plain(df, name))
        index = postings.build(d)
        asked = postings._asked(q, index, "query_id", "text")
        for name in ("lists", "asked"):
            assert "BroadcastHashJoin" not in plans[name].split("SortMergeJoin")[0] and "SortMergeJoin" in plans[name]
        pairs = spark.createDataFrame([("q", r["did"], 5) for r in index.ids.collect()], "qid string, did long, partial long")
        few = postings._completed(pairs, asked, index)
        monkeypatch.setattr(postings, "WANTED_ROWS", 799)
        many = postings._completed(pairs, asked, index)
        assert "SortMergeJoin" not in plan(few) and "SortMergeJoin" in plan(many)
        assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 200
        assert found(postings.topk(q, index, 3)) == brute([("q", "all most own7 own8")], corpus, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
