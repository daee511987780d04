import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import blocks, profile, quantiles
from tests.conftest import SF01


def frame_with_gaps(n=4000, k=9, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-3, 7, k) + 10.0 ** rng.integers(0, 7, k)
    x[:, 1] = x[:, 0] * -2 + rng.normal(size=n)
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 4] = 7.0
    x[:, 5] = np.nan
    x[np.isnan(x[:, 7]), 6] = np.nan
    x[~np.isnan(x[:, 7]), 6] = 0.1    # constant
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])


def test_blocks_merge_like_whole(spark):
    pdf = frame_with_gaps()
    whole = blocks.block_of(pdf.to_numpy())
    total = blocks.empty_block(pdf.shape[1])
    for part in np.array_split(pdf.to_numpy(), 13):
        total = blocks.merge(total, blocks.block_of(part, ~total["constant"]))
    for f in ("n", "constant"):
        assert (whole[f] == total[f]).all()
    there = pdf.notna().to_numpy()
    for i in range(pdf.shape[1]):
        for j in range(pdf.shape[1]):
            both = pdf[there[:, i] & there[:, j]].iloc[:, i]
            assert whole["n"][i, j] == len(both) and total["constant"][i, j] == (both.nunique() < 2)
            if len(both):
                assert total["mean"][i, j] == pytest.approx(both.mean())
                assert total["square"][i, j] == pytest.approx(((both - both.mean()) ** 2).sum(), rel=1e-9, abs=1e-9 * len(both))


@pytest.mark.parametrize("parts", [1, 7, 90])
def test_correlation_equals_pandas(spark, parts):
    pdf = frame_with_gaps()
    df = spark.createDataFrame(pdf).repartition(parts)
    want = pdf.corr()
    got = profile.correlation(df, list(pdf.columns)).collect()
    assert len(got) == pdf.shape[1] * (pdf.shape[1] - 1)
    for r in got:
        w = want.loc[r["feature_a"], r["feature_b"]]
        if {"c4", "c5", "c6"} & {r["feature_a"], r["feature_b"]}:
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(w, abs=1e-7)


def test_constant_on_common_rows_only(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (5.0, None), (float("nan"), 3.0)], "a double, b double")
    assert [r["corr"] for r in profile.correlation(df, ["a", "b"], lower_only=True).collect()] == [None]
    endless = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, float("inf"), 4.5), (3.0, 3.0, 6.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in profile.correlation(endless, ["a", "b", "c"], lower_only=True).collect()}
    assert got["a", "b"] is None and got["a", "c"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 6])[0, 1])


def test_correlation_scans_once(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = profile.correlation(df, ["l_quantity", "l_tax", "l_discount"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_nullity_of_many_columns(spark):
    pdf = frame_with_gaps(500)
    df = spark.createDataFrame(pdf)
    nulls = pdf.isna().astype(float)
    want = nulls.corr()
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in profile.nullity_correlation(df, list(pdf.columns)).collect()}
    assert {c for pair in got for c in pair} == {c for c in pdf.columns if 0 < nulls[c].sum() < 500}
    assert all(got[k] == pytest.approx(want.loc[k]) for k in got)
    for r in profile.nullity_distance(df, list(pdf.columns)).collect():
        assert r["distance"] ** 2 == pytest.approx((nulls[r["feature_a"]] != nulls[r["feature_b"]]).sum())


# -- quantiles ------------------------------------------------------------------------

PROBS = [0.75, 0.0, 0.25, 0.5, 0.999, 1.0]


def values(seed=1):
    rng = np.random.default_rng(seed)
    return {"normal": rng.normal(size=6000), "ties": rng.integers(0, 4, 5000).astype(float), "hot": np.where(rng.random(4000) < 0.6, 3.0, rng.random(4000) * 9),
            "wide": rng.lognormal(20, 5, 3000), "two": np.array([1.0, 2.0]), "one": np.array([-0.5])}


@pytest.mark.parametrize(("accuracy", "most", "grid"), [(2_000, 1 << 19, 1000), (100, 1 << 19, 10), (50, 60, 10), (200, 30, 20)])
def test_quantiles_equal_numpy(spark, accuracy, most, grid):
    """With coarse sketches and little room: brackets, narrowing scans and the fallback."""
    vs = values()
    rows = [(g, float(v)) for g, x in vs.items() for v in x] + [(None, 5.0), (None, None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    names = [f"p{i}" for i in range(len(PROBS))]
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], "v", PROBS, names, accuracy, most, grid).collect()}
    assert set(got) == {*vs, None}
    for g, x in vs.items():
        assert [got[g][n] for n in names] == pytest.approx(np.quantile(x, PROBS).tolist(), rel=1e-12)
    assert got[None]["p3"] == 5.0


def test_quantiles_without_groups(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert tuple(quantiles.exact_quantiles(df, [], "v", [0.5, 0.1]).first()) == (4.5, 0.9)
    assert quantiles.exact_quantiles(df.where("v < 0"), [], "v", [0.5]).first()["q50"] is None


def test_quantiles_sort_little(spark):
    """The rows that the counting scan shuffles do not grow with the column."""
    def kept(n):
        df = spark.range(n).select(F.lit("a").alias("g"), (F.hash("id") / 7.0).alias("v"))
        sides = df.agg(F.percentile_approx("v", [0.5 - 1e-3, 0.5 + 1e-3], quantiles.ACCURACY)).first()[0]
        return df.where(F.col("v").between(*sides)).count()
    assert kept(400_000) < 400_000 * 6 / quantiles.ACCURACY


def test_numbers_that_a_double_cannot_hold(spark):
    big = 2**60
    df = spark.createDataFrame([(big + i,) for i in range(30_001)], "v long").repartition(3)
    assert quantiles.exact_quantiles(df, [], "v", [0.5], accuracy=100).first()["q50"] == float(big + 15_000)
