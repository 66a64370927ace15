"""The registered queries against DuckDB, and the pipeline against plain versions of its stages."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lakeloom.llm import catalog, common, minhash
from tests.conftest import SF_SMALL
from tests.llm import brute


def norm(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    found = con.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    got = Counter(tuple(norm(x) for x in r) for r in df.select(*columns).collect())
    assert got == Counter(tuple(norm(x) for x in r) for r in found.fetchall())


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF_SMALL}/documents.parquet')").fetchall()


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_suffix_query(spark):
    got = Counter(tuple(r) for r in entry.queries()["op10_suffix_dedup"](spark, SF_SMALL).collect())
    assert got == brute.suffix(documents())


def test_license_query(spark):
    rows = entry.queries()["op9_license_scan"](spark, SF_SMALL).collect()
    assert Counter(tuple(r)[:6] for r in rows) == Counter((d, *brute.licenses(t)) for d, t in documents())


def test_near_duplicate_query(spark):
    truth, first = brute.similar_classes(documents()), {}
    for d, t in sorted(documents()):
        first.setdefault(truth[t], d)
    got = {r["doc_id"]: r["class_id"] for r in entry.queries()["op6_minhash"](spark, SF_SMALL).collect()}
    assert got == {d: first[truth[t]] for d, t in documents()}


def test_pipeline_stages(spark):
    docs = common.documents(spark, SF_SMALL)
    columns, rows = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.staged(stage(spark, docs, SF_SMALL), "stage")
        rows.append([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
        assert docs.columns[:len(columns)] == columns
        if name == "near-duplicate removal":
            own = [(r["doc_id"], r["text"]) for r in before.collect()]
            truth, first = brute.similar_classes(own), {}
            for d, t in sorted(own):
                first.setdefault(truth[t], d)
            assert sorted(d for d, _ in rows[-1]) == sorted(first.values())
        if name == "benchmark decontamination":
            items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()
            clean = {k[0] for k in brute.leaks([(r["doc_id"], r["text"]) for r in before.collect()], items) if not k[5]}
            assert {d for d, _ in rows[-1]} == clean
    assert Counter(rows[-1]) == Counter(rows[-2]) and len(rows[-1]) > 50
    by_shard = Counter(r["shard"] for r in docs.collect())
    assert set(by_shard) == set(range(16)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    again = Counter((r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert again == Counter((r["doc_id"], r["shard"], r["slot"]) for r in docs.collect())


def test_classes_do_not_depend_on_the_split_of_components(spark):
    docs = common.documents(spark, SF_SMALL)
    whole = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert {r["doc_id"]: r["class_id"] for r in minhash.classes(docs, chunk=2).collect()} == whole
