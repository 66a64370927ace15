"""Language ID against a plain version of its kernel and regression, and on edge cases."""

import zlib

import duckdb
import numpy as np

import __spark_entry__ as entry
from lakeloom.llm import language
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, at string, digest string, bits string, has string"
WORDS = {"a1": "ba be bi bo", "b2": "zu zy zo zw", "c3": "ñéà çôü"}


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", None) for r in rows], SCHEMA).repartition(3)


def grams(text):
    """The n-grams of one to three letters, with one blank for each run of others after a letter."""
    folded, out = "", set()
    for c in text.lower() + " ":
        folded += c if c.isalpha() else "" if folded[-1:] in ("", " ") else " "
    for n in range(1, language.MAX_N + 1):
        out |= {folded[i:i + n] for i in range(len(folded) - n + 1)}
    return out - {" "}


def test_sets_are_those_of_the_plain_version():
    texts = ["Ab c", "ab  c!", "", "123", "Ünter Straße, 𝔸b", "é", "a-b" * 50, "-x"]
    bits, has = language.presence(texts)
    assert has.tolist() == [any(c.isalpha() for c in t) for t in texts]
    # Few n-grams don't collide: their number is that of the places, for a text as for two together.
    for i, t in enumerate(texts):
        assert bits[i].sum() == len(grams(t))
        assert all((bits[i] | other).sum() == len(grams(t) | grams(u)) for u, other in zip(texts, bits))
    # Case, the kind of separators and a text's neighbours don't matter.
    assert (bits[0] == bits[1]).all() and (bits[0] == language.presence(["AB C"])[0][0]).all()
    for t, row in zip(texts, bits):
        assert (row == language.presence([t])[0][0]).all()


def test_regression_is_exact_with_all_texts_as_landmarks():
    rng = np.random.default_rng(3)
    bits = (rng.random((30, language.DIMS)) < 0.02).astype(np.uint8)
    labels = ["x" if i % 3 else "y" for i in range(30)]
    model = language.fit(bits, labels, n_landmarks=30)
    k = bits.astype(float) @ bits.T
    k /= np.sqrt(bits.sum(1))[:, None] * np.sqrt(bits.sum(1))[None, :]
    target = np.array([[1.0 if x == lang else -1.0 for lang in model.langs] for x in labels])
    exact = k @ np.linalg.solve(k + language.RIDGE * 30 * np.eye(30), target)
    got = language.kernel(bits, model.landmarks) @ model.coefficients
    assert np.abs(exact - got).max() < 1e-2


def test_edge_cases(spark):
    rows = [(i, f"{WORDS[lang]} {WORDS[lang][i % 5:]}", lang) for i in range(60) for lang in WORDS]
    odd = [(None, "ba be", None), (900, None, "a1"), (901, "", "a1"), (902, "12 ... 3", "b2"),
           (903, "ba be bi " * 200_000, None), (904, "zu zy zo", "a1"), (904, "zu zy zo", "a1")]
    table = docs(spark, rows + odd)
    model = language.learn(table.where(~language.held_out(table["doc_id"])))
    got = language.identify(table, model).collect()
    assert len(got) == len(rows) + len(odd)
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"}
    assert [(r.lang_pred, r.held_out) for r in got if r.doc_id is None] == [("a1", False)]
    assert [r.lang_pred for r in got if r.doc_id == 903] == ["a1"]
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 904}) == 1
    truth = {}
    for i, _, lang in rows:
        truth.setdefault(i, set()).add(lang)
    assert all(r.lang_pred in truth[r.doc_id] for r in got if r.doc_id in truth)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)


def test_nothing_to_learn_and_empty_table(spark):
    none = docs(spark, [(1, "ba be", None), (2, "zu", None)])
    model = language.learn(none)
    assert {(r.lang_pred, r.score) for r in language.identify(none, model).collect()} == {("und", 0.0)}
    empty = none.where("false")
    assert language.identify(empty, language.learn(empty)).count() == 0


def test_sample_bound_and_one_learned_language(spark):
    table = docs(spark, [(i, f"ba {'be' * (i % 40 + 1)}", "a1") for i in range(80)])
    model = language.learn(table, sample=8)
    assert len(model.landmarks) == 8 and model.langs == ["a1"]
    assert {r.lang_pred for r in language.identify(table, model).collect()} == {"a1"}


def test_held_out_accuracy_on_the_tables(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM read_parquet('{SF_SMALL}/documents.parquet')").fetchall())
    got = entry.queries()["op11_language"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert len(held) > 40 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
