import numpy as np
import pandas as pd
import pytest

from tabsmith.operators import table_stats, tables


def frame(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(100, 20, n).round(2), "b": rng.integers(-5, 9, n), "c": np.full(n, 4.0), "s": "x"})
    pdf.loc[::7, "a"] = np.nan
    pdf["d"] = pdf["a"] * 2 + rng.normal(size=n)
    return pdf


GROUP = {"name": "numbers", "columns": ["a", "b", "c", "d", "s"]}


def test_append_equals_recompute(spark, tmp_path):
    pdf = frame()
    parts = [pdf.iloc[:500], pdf.iloc[500:501], pdf[(pdf.index > 500) & (pdf["a"] < 100)], pdf[(pdf.index > 500) & ~(pdf["a"] < 100)]]
    frames = [spark.createDataFrame(p) for p in parts]
    tables.create_feature_group(frames[0], "id", GROUP, f"{tmp_path}/grown")
    for f in frames[1:]:
        tables.insert_rows(f.drop("s"), f"{tmp_path}/grown", "numbers")
    tables.create_feature_group(spark.createDataFrame(pdf), "id", GROUP, f"{tmp_path}/whole")
    grown, whole = (table_stats.read_statistics(spark, f"{tmp_path}/{k}", "numbers", 1) for k in ("grown", "whole"))
    g, w = (sorted(map(tuple, x["histogram"].collect())) for x in (grown, whole))
    assert g == w and {r[0] for r in g} >= {"a", "b", "c", "d"}
    g, w = ({r["feature"]: r for r in x["describe"].collect()} for x in (grown, whole))
    assert set(g) == set(w)
    for c in ("a", "b", "c", "d"):
        v = pdf[c].dropna()
        for r in (g[c], w[c]):
            assert (r["count"], r["min"], r["max"]) == (len(v), v.min(), v.max())
            assert (r["mean"], r["std"]) == pytest.approx((v.mean(), v.std()), rel=1e-12)
            assert abs(r["approx_distinct"] - v.nunique()) <= 0.05 * v.nunique() and (v.nunique() > 20 or r["approx_distinct"] == v.nunique())
            assert (v < r["approx_q50"]).mean() <= 0.52 and (v <= r["approx_q50"]).mean() >= 0.48
    want = pdf[["a", "b", "c", "d"]].corr()
    for r in grown["correlation"].collect():
        if {"a", "b", "c", "d"} >= {r["feature_a"], r["feature_b"]}:
            assert r["corr"] is None if "c" in (r["feature_a"], r["feature_b"]) else r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]])


def test_histogram_widths(spark, tmp_path):
    """At most about twice BINS bins, of a power of two; a constant takes one."""
    df = spark.createDataFrame([(float(x), 7.0, None) for x in (1, 2, 3, 1000)], "a double, k double, e double")
    table_stats.append_statistics(df, str(tmp_path), "g", 1, ["a", "k", "e"])
    rows = table_stats.read_statistics(spark, str(tmp_path), "g", 1)["histogram"].collect()
    assert {(r["feature"], r["lower"], r["upper"], r["count"]) for r in rows if r["feature"] == "a"} == {("a", 0.0, 32.0, 3), ("a", 992.0, 1024.0, 1)}
    assert [(r["count"], r["lower"] <= 7 < r["upper"]) for r in rows if r["feature"] == "k"] == [(4, True)] and not [r for r in rows if r["feature"] == "e"]


def test_version_rows_stay_apart_from_statistics(spark, tmp_path):
    tables.create_feature_group(spark.createDataFrame(frame(50)), "id", GROUP, str(tmp_path))
    assert tables.read_group(spark, str(tmp_path), "numbers").columns[-1] == "version" and tables.read_group(spark, str(tmp_path), "numbers").count() == 50
