"""Profiling, quality suites and model metrics."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import models, profile, quality, select


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 300), "b": rng.integers(0, 10, 300).astype(float)})
    pdf.loc[::7, "a"] = None
    d = profile.describe_numeric(spark.createDataFrame(pdf), ["a", "b"]).toPandas().set_index("feature")
    ref = pdf.describe().T
    for c in ["a", "b"]:
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert d.loc[c, ours] == pytest.approx(ref.loc[c, theirs], rel=1e-9)


def test_top_n_exact_under_skew(spark):
    vals = ["hot"] * 500 + [f"v{i % 40}" for i in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    top = profile.top_values(df, ["c"], 3).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in top] == [("hot", 500), ("v0", 10), ("v1", 10)]
    oth = {r["c"]: r["count"] for r in profile.top_with_others(df, "c", 2).collect()}
    assert oth == {"hot": 500, "v0": 10, "Others": 390}


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(6).normal(0, 1, 1000)
    h = profile.histogram(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"], 30).orderBy("bin").toPandas()
    want, edges = np.histogram(x, bins=30)
    assert list(h["count"]) == list(want)
    assert np.allclose(h["lower"], edges[:-1]) and np.allclose(h["upper"], edges[1:])


def test_correlation_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, None], "b": [2.0, 4, 5, None, 1], "c": [5.0, 3, 2, 1, 0]})
    got = profile.correlation(spark.createDataFrame(pdf), ["a", "b", "c"]).toPandas()
    want = pdf.corr()
    for _, r in got.iterrows():
        assert r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]])


def test_box_stats_and_density(spark):
    x = np.array([1.0, 2, 3, 4, 5, 6, 7, 8, 100])
    b = profile.box_stats(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"]).first()
    q1, q3 = np.percentile(x, [25, 75])
    assert (b["q1"], b["q3"]) == (q1, q3) and b["n_outliers"] == 1 and b["upper_whisker"] == 8
    d = profile.density_curve(spark.createDataFrame(pd.DataFrame({"x": x})), "x", grid_size=5) \
        .orderBy("i").toPandas()
    h = np.std(x, ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 5)
    want = [np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi)) for g in grid]
    assert np.allclose(d["density"], want) and np.allclose(d["grid_x"], grid)


def test_missing_reports(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "b")], "k int, x double, s string")
    m = {r["column"]: r["missing"] for r in profile.missing_by_column(df).collect()}
    assert m == {"x": 2, "s": 1}
    rows = {r["k"]: r["missing_pct"] for r in profile.missing_by_row(df, "k").collect()}
    assert rows == {1: 50.0, 2: 100.0, 3: 0.0}


def test_quality_suite(spark):
    df = spark.createDataFrame([(20, "M"), (15, "F"), (None, "X")], "age int, g string")
    rules = [{"type": "expect_table_row_count_to_be_between", "min": 1, "max": 5},
             {"type": "expect_column_values_to_be_between", "column": "age", "min": 16, "max": 100},
             {"type": "expect_column_values_to_not_be_null", "column": "age"},
             {"type": "expect_column_values_to_be_in_set", "column": "g", "value_set": ["M", "F"]},
             {"type": "expect_table_columns_to_match_set", "columns": ["age"], "exact": None},
             {"type": "expect_column_to_exist", "column": "zzz"}]
    same, res = quality.run_suite(df, rules)
    assert same is df
    got = {(r["rule"], r["column"]): (r["success"], r["unexpected"]) for r in res.collect()}
    assert got[("expect_table_row_count_to_be_between", None)] == (True, 0)
    assert got[("expect_column_values_to_be_between", "age")] == (False, 1)
    assert got[("expect_column_values_to_not_be_null", "age")] == (False, 1)
    assert got[("expect_column_values_to_be_in_set", "g")] == (False, 1)
    assert got[("expect_table_columns_to_match_set", None)][0] is True
    assert got[("expect_column_to_exist", "zzz")][0] is False
    assert quality.suite_passes(df, rules) is False
    assert quality.suite_passes(df, quality.get_suite("no_such_suite")) is True
    with pytest.raises(ValueError):
        quality.run_suite(df, rules, on_fail="raise")


def test_macro_metrics_by_hand(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "true_label int, predicted_label int")
    m = models.macro_metrics(pred).first()
    # class 0: p=1, r=.5, f1=2/3; class 1: p=2/4, r=1, f1=2/3; class 2: 0
    assert m["accuracy"] == pytest.approx(0.6)
    assert m["precision_macro"] == pytest.approx(0.5)
    assert m["recall_macro"] == pytest.approx(0.5)
    assert m["f1_macro"] == pytest.approx(4 / 9)
    conf = {(r["true_label"], r["predicted_label"]): r["row_rate"] for r in models.confusion(pred).collect()}
    assert conf[(0, 0)] == 0.5 and conf[(2, 1)] == 1.0


def test_chi2_independence_and_mi(spark):
    pdf = pd.DataFrame({"x": ["a"] * 30 + ["b"] * 10 + ["a"] * 15 + ["b"] * 25,
                        "y": ["p"] * 40 + ["q"] * 40})
    df = spark.createDataFrame(pdf)
    r = select.chi2_independence(df, ["x"], "y").first()
    o = np.array([[30, 15], [10, 25]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    d = np.maximum(np.abs(o - e) - 0.5, 0)
    assert r["dof"] == 1 and r["chi2"] == pytest.approx(float((d * d / e).sum()))
    p = o / o.sum()
    mi = float((p * np.log(p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True)))).sum())
    assert select.mutual_information(df, ["x"], "y").first()["mutual_information"] == pytest.approx(mi)
    w = {r["y"]: r["class_weight"] for r in select.class_weights(df, "y").collect()}
    assert w == {"p": 1.0, "q": 1.0}


def test_permutation_of_constant_feature_is_zero(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": range(200), "x": rng.normal(0, 1, 200), "const": 1.0})
    pdf["y"] = (pdf["x"] > 0).astype(float)
    df = spark.createDataFrame(pdf)
    m = models.train_forest(df, ["x", "const"], "y", {"n_estimators": 5, "max_depth": 3})
    pi = {r["feature"]: r for r in models.permutation_importance(m, df, ["x", "const"], "y", "k", 3).collect()}
    assert pi["const"]["importance_mean"] == 0.0 and pi["const"]["importance_std"] == 0.0
    assert pi["x"]["importance_mean"] > 0.1


def test_schema_difference_and_profile_bundle(spark):
    from tabsmith.operators.columns import schema_difference
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(1, "s")], "k int, y string")
    got = sorted(tuple(r) for r in schema_difference(spark, a, b).collect())
    assert got == [("x", "left"), ("y", "right")]
    bundle = profile.profile(spark.createDataFrame([(i, float(i) if i % 3 else None) for i in range(20)],
                                                   "k int, x double"), "k", ["x"], n_head=5)
    assert set(bundle) == {"describe", "missing", "shape", "head"}
    assert bundle["shape"].first()["rows"] == 20 and bundle["head"].count() == 5
    assert bundle["missing"].first()["missing"] == 7
