import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lakeloom.operators import retrieve


def brute(q, d, k, exclude_self=False, q_ids=None, d_ids=None):
    qn = q / np.where(np.linalg.norm(q, axis=1) == 0, 1, np.linalg.norm(q, axis=1))[:, None]
    dn = d / np.where(np.linalg.norm(d, axis=1) == 0, 1, np.linalg.norm(d, axis=1))[:, None]
    s = qn @ dn.T
    out = {}
    for i, qid in enumerate(q_ids):
        cand = [(-s[i, j], d_ids[j]) for j in range(len(d_ids)) if not (exclude_self and d_ids[j] == qid)]
        out[qid] = [did for _, did in sorted(cand)[:k]]
    return out


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    d = rng.normal(size=(300, 8)).astype(np.float32)
    d[5] = 0  # zero vector keeps norm 1
    d[7] = d[8]  # exact tie broken by smaller id
    ids = list(range(100, 400))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, d)], "id long, embedding array<float>")
    want = brute(d.astype(np.float64), d.astype(np.float64), 4, True, ids, ids)
    for cast in ("long", "string"):
        own = df.withColumn("id", F.col("id").cast(cast))
        rows = {}
        for r in retrieve.topk_similar(own, own.repartition(5), k=4, q_id="id", d_id="id", exclude_self=True).orderBy(
                "query_id", "rank").collect():
            rows.setdefault(int(r["query_id"]), []).append(int(r["doc_id"]))
        assert rows == want
    # Questions in many blocks, and through an index.
    index = retrieve.pivot_index(df, d_id="id", pivots=5)
    for found in (retrieve.topk_similar(df, df, k=4, q_id="id", d_id="id", exclude_self=True, block_bytes=2000),
                  retrieve.topk_indexed(df, index, k=4, q_id="id", exclude_self=True, block_bytes=8000)):
        rows = {}
        for r in found.orderBy("query_id", "rank").collect():
            rows.setdefault(r["query_id"], []).append(r["doc_id"])
        assert rows == want


def test_scores_held_at_once_are_bounded(monkeypatch):
    """However many questions there are, and whatever the size of a batch; the rows found stay as they were."""
    held = []
    plain = retrieve._normalise
    monkeypatch.setattr(retrieve, "_normalise", lambda m: held.append(len(m)) or plain(m))
    monkeypatch.setattr(retrieve, "SCORE_CELLS", 70)
    rng = np.random.default_rng(6)
    d = rng.normal(size=(120, 5)).astype(np.float32)
    ids = [f"{i:03}" for i in rng.permutation(120)]
    q, q_ids = d[:10], ids[:10]
    batches = [pd.DataFrame({"did": ids[a:b], "dvec": list(d[a:b])}) for a, b in ((0, 2), (2, 50), (50, 50), (50, 120))]
    for own in (False, True):
        run = retrieve._partial_topk(np.array(q_ids), plain(q.astype(np.float64)), 4, own)
        found = pd.concat(run(iter(batches))).groupby("query_id")["doc_id"].agg(list).to_dict()
        assert found == brute(q.astype(np.float64), d.astype(np.float64), 4, own, q_ids, ids)
    assert max(held) <= 70 and 7 in held


def test_index_skips_what_no_question_reaches(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "PROBE_SHARE", 4)
    rng = np.random.default_rng(4)
    centres = np.eye(12)[:10]
    d = np.concatenate([c + 0.02 * rng.normal(size=(60, 12)) for c in centres] + [np.zeros((3, 12))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(d)], "doc_id long, embedding array<double>")
    q = np.concatenate([centres[:2] + 0.01, -centres[2:3]])
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q[:2])], "query_id long, embedding array<double>")
    index = retrieve.pivot_index(df, pivots=20)
    got = {}
    for r in retrieve.topk_indexed(qs, index, k=5).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert got == brute(q[:2], d, 5, q_ids=[0, 1], d_ids=list(range(len(d))))
    assert 0 < retrieve.needed_share(qs, index, k=5) < 0.5


def test_index_of_nothing_and_more_neighbours_than_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "doc_id long, embedding array<double>")
    qs = spark.createDataFrame([(7, [1.0, 1.0])], "query_id long, embedding array<double>")
    rows = retrieve.topk_indexed(qs, retrieve.pivot_index(df), k=9).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == [1, 2]
    assert retrieve.topk_indexed(qs, retrieve.pivot_index(df.where("false")), k=9).count() == 0
    assert retrieve.topk_indexed(qs.where("false"), retrieve.pivot_index(df), k=9).count() == 0
    zeros = retrieve.topk_indexed(qs, retrieve.pivot_index(df.where("doc_id = 2")), k=1).collect()
    assert [(r["doc_id"], r["score"]) for r in zeros] == [(2, 0.0)]


def test_cited_context_orders_hits(spark):
    hits = spark.createDataFrame([(1, 2, 10, 0.5), (1, 1, 11, 0.9)], "query_id long, rank int, doc_id long, score double")
    labels = spark.createDataFrame([(10, 3), (11, 4)], "doc_id long, label int")
    r = retrieve.cited_context(hits, labels, "label").first()
    assert r["cited_ids"] == [11, 10] and r["top_score"] == 0.9
    assert r["context"].startswith("[1] vec 11 (label 4, score 0.900000)\n\n[2] vec 10")


def test_all_pieces_of_all_texts_are_ranked_under_the_ids_of_the_chunk_operator(spark, monkeypatch):
    """retrieve_cited against plain scoring of every piece that the statement of retrieve_postings cuts."""
    import zlib
    from collections import Counter

    import duckdb

    from lakeloom import catalog
    from lakeloom.operators import chunk
    from lakeloom.queries.search import _TEXTS
    from lakeloom.queries.text import _pieces_sql, _stop_at_end_sql
    from tests.conftest import SF_SMALL

    named, plain = [], chunk.chunk_id
    monkeypatch.setattr(chunk, "chunk_id", lambda *a: named.append(a) or plain(*a))
    got = {r["item_id"]: r["sources"] for r in catalog.queries()["retrieve_cited"](spark, SF_SMALL).collect()}
    assert named
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    pieces = con.execute(f"SELECT piece_id, piece FROM ({_pieces_sql(_stop_at_end_sql(_TEXTS, 'text_id, caption'))})").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()

    def bags(texts):
        out = np.zeros((len(texts), 256))
        for i, text in enumerate(texts):
            for w, n in Counter(text.lower().split()).items():
                out[i, zlib.crc32(w.encode()) % 256] += n
        return out

    held, asked = bags([p for _, p in pieces]), bags([t for _, t in items])
    idf = np.log((len(held) + 1) / ((held > 0).sum(0) + 1))
    unit = lambda m: (m * idf) / np.linalg.norm(m * idf, axis=1, keepdims=True)
    scores, ids = unit(asked) @ unit(held).T, [i for i, _ in pieces]
    for (item, _), own in zip(items, scores):
        best = sorted(own, reverse=True)[:4]
        assert np.allclose([own[ids.index(s)] for s in got[item]], best, atol=1e-5)
    assert len(got) == len(items)
