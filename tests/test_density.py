import numpy as np
import pandas as pd
import pytest

from tabsmith.operators import profile


def test_density_equals_all_kernels(spark):
    rng = np.random.default_rng(4)
    groups = {"bell": rng.normal(50, 5, 4000), "tail": rng.lognormal(1, 1.5, 3000), "ties": rng.integers(0, 3, 900) * 1.0, "two": np.array([1.0, 5.0])}
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()] + [pd.DataFrame({"g": ["flat"] * 5 + ["one"], "v": [2.0] * 5 + [1.0]})])
    df = spark.createDataFrame(pdf).repartition(4)
    got = profile.density_curve(df, "v", ["g"], 40).toPandas()
    assert len(got) == 40 * 6
    for g, v in groups.items():
        mine = got[got.g == g].sort_values("i")
        h = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min(), v.max(), 40)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert mine["grid_x"].to_numpy() == pytest.approx(x)
        assert np.abs(mine["density"].to_numpy() - want).max() < 1e-9 / h
    assert got[got.g.isin(["flat", "one"])]["density"].isna().all()


def test_density_aggregates_bins(spark):
    """Values meet in bins, whose number follows the range and not the rows."""
    df = spark.range(50_000).selectExpr("CAST(hash(id) % 1000 AS DOUBLE) AS v")
    whole = profile.density_curve(df, "v", grid_size=20).toPandas()
    assert whole["density"].notna().all() and len(whole) == 20
    area = np.trapezoid(whole.sort_values("i")["density"], whole.sort_values("i")["grid_x"])
    assert 0.9 < area < 1.01
