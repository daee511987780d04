"""Drift statistics: invariants and brute-force equivalents of the scipy/numpy formulas."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.functions.stats import _gammaincc
from tabsmith.operators import drift


def frames(spark, ref, cur, name="x"):
    return (spark.createDataFrame(pd.DataFrame({name: ref}), f"{name} double"),
            spark.createDataFrame(pd.DataFrame({name: cur}), f"{name} double"))


def brute_ks_w(a, b):
    a, b = np.sort(a), np.sort(b)
    allv = np.sort(np.concatenate([a, b]))
    ca = np.searchsorted(a, allv, side="right") / len(a)
    cb = np.searchsorted(b, allv, side="right") / len(b)
    d = np.max(np.abs(ca - cb))
    w = np.sum(np.abs(ca - cb)[:-1] * np.diff(allv))
    return d, w


def brute_psi(ref, cur, bins=10):
    edges = np.histogram_bin_edges(ref, bins=bins)
    r, _ = np.histogram(ref, bins=edges)
    c, _ = np.histogram(cur, bins=edges)
    rp, cp = r / r.sum() + 1e-8, c / c.sum() + 1e-8
    return float(np.sum((cp - rp) * np.log(cp / rp)))


def test_ks_wasserstein_psi_match_brute_force(spark):
    rng = np.random.default_rng(3)
    ref = np.round(rng.normal(0, 1, 700), 2)
    cur = np.round(rng.normal(0.3, 1.2, 500), 2)
    r, c = frames(spark, ref, cur)
    kw = drift.ks_wasserstein(r, c, ["x"]).first()
    d, w = brute_ks_w(ref, cur)
    assert kw["ks_statistic"] == pytest.approx(d, abs=1e-12)
    assert kw["wasserstein"] == pytest.approx(w, abs=1e-9)
    p = drift.psi(r, c, ["x"]).first()
    assert p["psi"] == pytest.approx(brute_psi(ref, cur), abs=1e-9)


def test_identical_samples_have_no_drift(spark):
    x = np.arange(100, dtype=float)
    r, c = frames(spark, x, x)
    assert drift.ks_wasserstein(r, c, ["x"]).first()["ks_statistic"] == 0
    assert drift.psi(r, c, ["x"]).first()["psi"] == pytest.approx(0.0, abs=1e-12)
    n = drift.numeric_drift(r, c, ["x"]).first()
    assert n["p_value"] == 1.0 and n["drift_severity"] == "low" and not n["drift_detected"]


def test_wasserstein_symmetric(spark):
    a, b = np.array([0.0, 1, 3]), np.array([5.0, 6, 8, 9])
    r, c = frames(spark, a, b)
    w1 = drift.ks_wasserstein(r, c, ["x"]).first()["wasserstein"]
    w2 = drift.ks_wasserstein(c, r, ["x"]).first()["wasserstein"]
    assert w1 == pytest.approx(w2) == pytest.approx(brute_ks_w(a, b)[1])


def test_psi_edges_constant_reference_and_out_of_range(spark):
    r, c = frames(spark, [5.0] * 10, [5.0, 5.2, 7.0, -1.0])
    want = brute_psi(np.array([5.0] * 10), np.array([5.0, 5.2, 7.0, -1.0]))
    assert drift.psi(r, c, ["x"]).first()["psi"] == pytest.approx(want, abs=1e-12)
    # values exactly on edges, including the closed last edge
    ref = np.linspace(0, 1, 11)
    cur = np.array([0.0, 0.1, 0.2, 0.3, 1.0, 1.0, 0.9999])
    r, c = frames(spark, ref, cur)
    assert drift.psi(r, c, ["x"]).first()["psi"] == pytest.approx(brute_psi(ref, cur), abs=1e-12)


def test_psi_empty_current_in_range_is_null(spark):
    r, c = frames(spark, [1.0, 2.0, 3.0], [10.0, 11.0])
    row = drift.psi(r, c, ["x"]).first()
    assert row["psi"] is None and row["interpretation"] == "Significant population change"


def test_empty_side_is_skipped(spark):
    r = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    c = spark.createDataFrame([(None,)], "x double")
    assert drift.numeric_drift(r, c, ["x"]).count() == 0


def test_chi2_sf_known_values():
    assert _gammaincc(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)
    assert _gammaincc(1.0, 5.991464547107979 / 2) == pytest.approx(0.05, abs=1e-9)
    assert _gammaincc(2.0, 9.487729036781154 / 2) == pytest.approx(0.05, abs=1e-9)
    assert _gammaincc(5.0, 0.0) == 1.0


def test_categorical_drift_yates_2x2(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [("b",)] * 10, "x string")
    cur = spark.createDataFrame([("a",)] * 15 + [("b",)] * 25, "x string")
    row = drift.categorical_drift(ref, cur, ["x"]).first()
    o = np.array([[30, 10], [15, 25]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    d = np.maximum(np.abs(o - e) - 0.5, 0)
    want = float((d * d / e).sum())
    assert row["chi2_statistic"] == pytest.approx(want)
    assert row["dof"] == 1
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(want / 2)), abs=1e-10)
    assert row["max_proportion_difference"] == pytest.approx(0.375)


def test_categorical_single_category_and_empty_side(spark):
    ref = spark.createDataFrame([("a",)] * 3, "x string")
    row = drift.categorical_drift(ref, ref, ["x"]).first()
    assert row["chi2_statistic"] == 0.0 and row["p_value"] == 1.0
    empty = spark.createDataFrame([(None,)], "x string")
    row = drift.categorical_drift(ref, empty, ["x"]).first()
    assert row["status"] == "error" and row["p_value"] is None


def test_summary_and_alerts(spark):
    rng = np.random.default_rng(5)
    ref = pd.DataFrame({"a": rng.normal(0, 1, 400), "b": rng.normal(0, 1, 400), "c": ["x", "y"] * 200})
    cur = pd.DataFrame({"a": rng.normal(3, 1, 400), "b": rng.normal(0, 1, 400), "c": ["x", "y"] * 200})
    r, c = spark.createDataFrame(ref), spark.createDataFrame(cur)
    rep = drift.drift_report(r, c, ["a", "b", "missing"], ["c"]).first()
    assert rep["total_features"] == 4 and rep["evaluated_features"] == 3
    assert rep["drifted_features"] == 1 and rep["overall_drift_score"] == 0.25
    assert rep["high_drift_features"] == ["numerical_a"]
    assert rep["alerts"] == [drift.ALERT_LOW]
    assert rep["recommendations"][0] == drift.RECS_LOW[0]
    assert rep["recommendations"][1] == drift.REC_HIGH_FEATURES + "numerical_a"
    assert rep["recommendations"][2] == drift.REC_PSI_FEATURES + "a"
    assert rep["reference_rows"] == 400
