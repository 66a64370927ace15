"""PSI on Spark against its own definition (NumPy) on lognormal fixtures."""

import numpy as np
import pytest

from lakeloom.operators import psi


def numpy_psi(ref, cur, buckets=10):
    edges = np.quantile(ref, np.linspace(0, 1, buckets + 1))
    edges[0], edges[-1] = -np.inf, np.inf
    r, _ = np.histogram(ref, bins=edges)
    c, _ = np.histogram(cur, bins=edges)
    r = np.clip(r / max(r.sum(), 1), 1e-6, None)
    c = np.clip(c / max(c.sum(), 1), 1e-6, None)
    return float(np.sum((c - r) * np.log(c / r)))


@pytest.fixture(scope="module")
def ref_values():
    return np.random.default_rng(42).lognormal(2.4, 0.5, 20_000)


def spark_psi(spark, ref, cur):
    r = spark.createDataFrame([(float(x),) for x in ref], "x double")
    c = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return psi.psi_table(r, c, ["x"]).first()["psi"]


def test_identical_is_zero(spark, ref_values):
    assert spark_psi(spark, ref_values, ref_values) == pytest.approx(0.0, abs=1e-9)


def test_fresh_sample_is_stable(spark, ref_values):
    fresh = np.random.default_rng(7).lognormal(2.4, 0.5, 5_000)
    got = spark_psi(spark, ref_values, fresh)
    assert got < psi.PSI_WARN
    assert got == pytest.approx(numpy_psi(ref_values, fresh), abs=1e-12)


@pytest.mark.parametrize("factor", [1.35, 1 / 1.35])
def test_inflation_breaches_both_directions(spark, ref_values, factor):
    cur = ref_values[:5000] * factor
    got = spark_psi(spark, ref_values, cur)
    assert got > psi.PSI_BREACH
    assert got == pytest.approx(numpy_psi(ref_values, cur), abs=1e-12)


def test_out_of_range_and_empty_buckets_finite(spark, ref_values):
    cur = np.concatenate([ref_values[:3750], np.full(1250, ref_values.max() * 10)])
    got = spark_psi(spark, ref_values, cur)
    assert np.isfinite(got) and got == pytest.approx(numpy_psi(ref_values, cur), abs=1e-12)
    single = np.full(5000, float(np.median(ref_values)))
    got1 = spark_psi(spark, ref_values, single)
    assert np.isfinite(got1) and got1 == pytest.approx(numpy_psi(ref_values, single), abs=1e-12)


def test_repeated_edges_follow_numpy(spark):
    ref = np.array([1.0] * 50 + [2.0] * 30 + [3.0] * 20)
    cur = np.array([1.0] * 10 + [2.0] * 10 + [3.0] * 80)
    assert spark_psi(spark, ref, cur) == pytest.approx(numpy_psi(ref, cur), abs=1e-12)


@pytest.mark.parametrize("slices", [None, 16])
def test_exact_quantiles_match_linear_interpolation(spark, slices):
    rng = np.random.default_rng(3)
    a = np.round(rng.lognormal(2.0, 0.7, 3000), 2)
    b = rng.integers(0, 7, 500).astype(float)  # heavy ties
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(rows, "feature string, value double")
    probs = [i / 10 for i in range(1, 10)]
    got = {r["feature"]: r["edges"] for r in psi.exact_quantiles(df, probs, slices=slices).collect()}
    for name, data in (("a", np.sort(a)), ("b", np.sort(b))):
        pos = np.array(probs) * (len(data) - 1)
        lo, hi = np.floor(pos).astype(int), np.ceil(pos).astype(int)
        want = data[lo] + (data[hi] - data[lo]) * (pos - lo)
        assert got[name] == pytest.approx(list(want), abs=1e-12)


def test_exact_quantiles_with_a_poor_sketch_and_repeated_sketching(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = np.round(rng.lognormal(1.0, 1.0, 20_000), 3)
    df = spark.createDataFrame([("x", float(v)) for v in values] + [("x", None), ("x", float("nan")), ("lone", 3.0)],
                               "feature string, value double").repartition(4)
    want = np.quantile(values, [0.001, 0.5, 0.999])
    for k, rows in ((8, 10 ** 6), (4096, 50)):  # brackets that miss; brackets sketched again
        monkeypatch.setattr(psi, "SKETCH_K", k)
        monkeypatch.setattr(psi, "BRACKET_ROWS", rows)
        got = {r["feature"]: r["edges"] for r in psi.exact_quantiles(df, [0.001, 0.5, 0.999]).collect()}
        assert got["x"] == pytest.approx(list(want), abs=1e-12) and got["lone"] == [3.0, 3.0, 3.0]


def test_quantiles_of_nothing(spark):
    assert psi.exact_quantiles(spark.createDataFrame([], "feature string, value double"), [0.5]).count() == 0
