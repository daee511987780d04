"""Encoders, feature engineering and splits: invariants from the survey's test strategy."""
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import encode, features, split


def test_label_encoder_sorted_null_last(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "y string")
    m = {r["value"]: r["label"] for r in encode.fit_labels(df, "y").collect()}
    assert m == {"a": 0, "b": 1, "c": 2, None: 3}
    out = encode.encode_labels(df, encode.fit_labels(df, "y"), "y")
    back = encode.decode_labels(out, encode.fit_labels(df, "y"), "y")
    assert sorted(map(str, (r[0] for r in back.collect()))) == sorted(map(str, ["b", "a", None, "c", "a"]))
    codes = [r[0] for r in encode.category_codes(df, "y").collect()]
    assert codes == [1, 0, -1, 2, 0]


def test_one_hot_drop_first_and_row_sums(spark):
    train = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    cats = encode.fit_one_hot(train, ["c"])
    assert cats == {"c": ["x", "y", "z", None]}
    other = spark.createDataFrame([("x",), ("z",), ("w",), (None,)], "c string")
    out = encode.one_hot(other, cats)
    assert out.columns == ["c_y", "c_z", "c_nan"]
    sums = [sum(r) for r in out.collect()]
    assert all(s <= 1 for s in sums) and sums == [0, 1, 0, 1]
    with pytest.raises(Exception):
        encode.one_hot(other, cats, on_unseen="error").collect()


def test_frequency_encoding_sums_to_one_and_unseen_zero(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    m = encode.fit_frequency(train, ["c"])
    assert sum(r["freq"] for r in m.collect()) == pytest.approx(1.0)
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    got = [r["Enc c"] for r in encode.frequency(test, m, ["c"]).orderBy(F.col("c").asc_nulls_last()).collect()]
    assert got == [0.5, 0.0, 0.25]
    ties = encode.frequency_ties(m).collect()
    assert ties and ties[0]["tied_values"] == 2


def test_sine_cosine(spark):
    df = spark.createDataFrame([("Winter",), ("Summer",), ("nope",)], "s string")
    out = encode.sine_cosine(df, "s", {"Winter": 0, "Spring": 1, "Summer": 2, "Fall": 3}, 4).collect()
    assert out[0]["s_Sin"] == pytest.approx(0.0) and out[0]["s_Cos"] == pytest.approx(1.0)
    assert out[1]["s_Cos"] == pytest.approx(-1.0)
    assert out[2]["s_Sin"] is None


def test_polynomial_order_and_interactions(spark):
    terms = features.polynomial_terms(["a", "b"], 2)
    assert terms == [("a",), ("b",), ("a", "a"), ("a", "b"), ("b", "b")]
    df = spark.createDataFrame([(2.0, 3.0, 1.0, 1.0, 1.0, 1.0, 7.0)], "a double, b double, c double, d double, "
                                                                    "e double, f double, g double")
    r = features.polynomial(df, ["a", "b"]).first()
    assert [r[f"poly_{i}"] for i in range(5)] == [2.0, 3.0, 4.0, 6.0, 9.0]
    inter = features.interactions(df, df.columns)
    assert len(inter.columns) - len(df.columns) == 15 and "a_x_f" in inter.columns and "f_x_g" not in inter.columns


def test_row_statistics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 10.0), (None, 4.0, None, None), (None, None, None, None)],
                               "a double, b double, c double, d double")
    rows = features.row_statistics(df, ["a", "b", "c", "d"]).collect()
    assert rows[0]["row_median"] == 2.5 and rows[0]["row_mean"] == 4.0 and rows[0]["row_range"] == 9.0
    assert rows[0]["row_std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert rows[1]["row_median"] == 4.0 and rows[1]["row_std"] is None
    assert rows[2]["row_mean"] is None


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (5.0,)], "x double")
    p = features.standard_params(features.fit_standard(df, ["x"]))
    assert p["x"][1] == pytest.approx(np.std([1, 2, 3, 5]))
    z = [r[0] for r in features.standardize(df, p).collect()]
    assert np.mean(z) == pytest.approx(0) and np.std(z) == pytest.approx(1)


def test_fold_scaler_complement(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"fold": rng.integers(0, 4, 500), "x": rng.normal(100, 20, 500)})
    out = features.fit_fold_standard(spark.createDataFrame(pdf), ["x"]).toPandas().set_index("fold")
    for k in range(4):
        rest = pdf[pdf.fold != k].x
        assert out.loc[k, "mean"] == pytest.approx(rest.mean(), rel=1e-12)
        assert out.loc[k, "std"] == pytest.approx(rest.std(ddof=0), rel=1e-9)


def test_stratified_split_sizes_disjoint_complete(spark):
    pdf = pd.DataFrame({"k": range(1000), "y": ["a"] * 700 + ["b"] * 250 + ["c"] * 50})
    out = split.stratified_split(spark.createDataFrame(pdf), "k", "y", 0.1, 0.2, 42).toPandas()
    assert len(out) == 1000 and out["k"].is_unique
    for y, n in [("a", 700), ("b", 250), ("c", 50)]:
        part = out[out.y == y]["split"].value_counts()
        n_test = round(0.1 * n)
        n_val = round(0.2 * (n - n_test))
        assert part.get("test", 0) == n_test and part.get("val", 0) == n_val
    again = split.stratified_split(spark.createDataFrame(pdf), "k", "y", 0.1, 0.2, 42).toPandas()
    assert (out.sort_values("k")["split"].values == again.sort_values("k")["split"].values).all()


def test_kfold_balanced(spark):
    pdf = pd.DataFrame({"k": range(103), "y": ["a"] * 80 + ["b"] * 23})
    out = split.kfold(spark.createDataFrame(pdf), "k", "y", 5, 69).toPandas()
    for _, g in out.groupby("y"):
        counts = g["fold"].value_counts()
        assert counts.max() - counts.min() <= 1 and set(counts.index) == set(range(5))


def test_polynomial_matches_itertools():
    cols = ["a", "b", "c"]
    got = features.polynomial_terms(cols, 3)
    want = [t for d in (1, 2, 3) for t in itertools.combinations_with_replacement(cols, d)]
    assert got == want
