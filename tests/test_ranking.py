"""Skew-safe ranking, running totals and exact quantiles against brute force."""
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabsmith.operators.ranking import cumulative, exact_quantiles, hashed_rank, null_safe_join


def test_hashed_rank_matches_md5_order(spark):
    pdf = pd.DataFrame({"k": range(300), "g": ["a"] * 200 + ["b"] * 90 + [None] * 10})
    df = spark.createDataFrame(pdf)
    out = hashed_rank(df, ["g"], "k", seed=7, bucket_hex_digits=1).toPandas()
    for g, part in pdf.groupby(pdf["g"].fillna("<null>")):
        keys = sorted(part["k"], key=lambda k: (hashlib.md5(f"7{k}".encode()).hexdigest(), k))
        want = {k: i for i, k in enumerate(keys)}
        got = out[out["g"].fillna("<null>") == g].set_index("k")["_rank"].to_dict()
        assert got == want
        assert set(out[out["g"].fillna("<null>") == g]["_group_n"]) == {len(part)}


def test_cumulative_brute_force_with_hot_group(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.integers(0, 50, 3000), rng.integers(0, 500, 300)]).astype(float)
    grp = ["hot"] * 3000 + ["cold"] * 300
    w = rng.integers(0, 2, 3300)
    pdf = pd.DataFrame({"g": grp, "v": vals, "w": w})
    df = spark.createDataFrame(pdf)
    out = cumulative(df, ["g"], "v", {"n": F.count(F.lit(1)), "s": F.sum("w")}, buckets=8).toPandas()
    for g, part in pdf.groupby("g"):
        agg = part.groupby("v").agg(n=("w", "size"), s=("w", "sum")).sort_index()
        o = out[out["g"] == g].set_index("v").sort_index()
        assert list(o.index) == list(agg.index)
        assert (o["n_cum"].values == agg["n"].cumsum().values).all()
        assert (o["s_cum"].values == agg["s"].cumsum().values).all()
        assert set(o["n_total"]) == {len(part)}
        nxt = list(agg.index[1:]) + [None]
        assert [None if pd.isna(x) else x for x in o["next_value"]] == nxt


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y", "z"], 2000, p=[0.8, 0.15, 0.05]),
                        "v": np.round(rng.normal(10, 3, 2000), 1)})
    pdf.loc[::37, "v"] = None
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    out = exact_quantiles(df, ["g"], "v", probs, buckets=16).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        want = np.percentile(part["v"].dropna(), [p * 100 for p in probs])
        got = out.loc[g, ["q0", "q25", "q50", "q75", "q100"]].values.astype(float)
        assert np.allclose(got, want, atol=1e-9)


def test_exact_median_even_count_and_no_group(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert exact_quantiles(df, [], "v", [0.5], ["m"]).first()["m"] == 2.5


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = sorted((r["a"], r["b"]) for r in null_safe_join(a, b, ["k"]).collect())
    assert got == [(1, 10), (2, 20)]


def test_quantiles_with_null_group_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 10.0), ("a", 20.0), ("a", 40.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in exact_quantiles(df, ["g"], "v", [0.5], ["m"]).collect()}
    assert got == {None: 2.0, "a": 20.0}
