import numpy as np
import pandas as pd
import pytest

from tabsmith.operators import drift, ecdf


def plain(ref, cur):
    """KS statistic and Wasserstein distance over all distinct values."""
    ref, cur = np.sort(ref[~np.isnan(ref)]), np.sort(cur[~np.isnan(cur)])
    at = np.unique(np.concatenate([ref, cur]))
    gap = np.abs(np.searchsorted(ref, at, "right") / len(ref) - np.searchsorted(cur, at, "right") / len(cur))
    return gap.max(), (gap[:-1] * np.diff(at)).sum()


def samples(seed):
    rng = np.random.default_rng(seed)
    n, m = 3000, 2200
    pairs = {
        "same": (rng.normal(size=n), rng.normal(size=m)), "shifted": (rng.normal(size=n), rng.normal(size=m) + 0.5),
        "ages": (rng.integers(0, 90, n) * 1.0, rng.integers(3, 95, m) * 1.0), "hot": (np.where(rng.random(n) < 0.7, 0, rng.normal(size=n)), rng.normal(size=m)),
        "apart": (rng.random(n), rng.random(m) + 7), "inside": (rng.random(n), np.full(m, 0.4)), "flat": (np.full(n, 2.0), np.full(m, 2.0)),
        "gaps": (np.where(rng.random(n) < 0.5, np.nan, rng.lognormal(3, 2, n)), rng.lognormal(3, 2, m)), "few": (np.r_[1.0, 2.0, np.full(n - 2, np.nan)], rng.random(m) * 3)}
    return pairs


@pytest.mark.parametrize("buckets", [None, 2, 9, 60])
def test_equals_all_values(spark, buckets):
    pairs = samples(buckets or 0)
    ref = spark.createDataFrame(pd.DataFrame({k: v[0] for k, v in pairs.items()})).repartition(3)
    cur = spark.createDataFrame(pd.DataFrame({k: v[1] for k, v in pairs.items()})).repartition(2)
    got = {r["feature"]: r for r in ecdf.ks_wasserstein(ref, cur, list(pairs), buckets).collect()}
    assert set(got) == set(pairs)
    for name, (a, b) in pairs.items():
        ks, w = plain(a, b)
        assert got[name]["ks_statistic"] == pytest.approx(ks, abs=1e-14), name
        assert got[name]["wasserstein"] == pytest.approx(w, rel=1e-9, abs=1e-12), name
        assert (got[name]["n_ref"], got[name]["n_cur"]) == (np.isfinite(a).sum(), np.isfinite(b).sum())


def test_empty_sides(spark):
    one = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    none = one.limit(0)
    assert [tuple(r) for r in ecdf.ks_wasserstein(one, none, ["a", "b"]).collect()] == [("a", 2, 0, None, 0.0)]
    assert ecdf.ks_wasserstein(none, none, ["a"]).count() == 0 and ecdf.ks_wasserstein(one, one, []).count() == 0


def test_infinite_values(spark):
    a = spark.createDataFrame([(1.0,), (float("inf"),), (3.0,)], "v double")
    b = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "v double")
    got = ecdf.ks_wasserstein(a, b, ["v"]).first()
    assert got["ks_statistic"] == pytest.approx(1 / 3) and got["wasserstein"] == float("inf")


def test_totals_leave_few_buckets_open(spark):
    """Where the samples differ, the totals alone decide almost everything; the rest is exact too."""
    rng = np.random.default_rng(0)
    ref, cur = rng.normal(size=50_000), rng.normal(size=50_000) + 0.3
    a, b = (spark.createDataFrame(pd.DataFrame({"v": x})) for x in (ref, cur))
    totals = ecdf.Totals(a, b, ["v"])
    got = ecdf.resolve(totals.cuts[0], totals.top[0], totals.of[0])
    assert len(got["open"]) < 0.05 * len(totals.of[0]["b"]) and got["n"] == got["m"] == 50_000
    row = ecdf.ks_wasserstein(a, b, ["v"], totals=totals).first()
    assert (row["ks_statistic"], row["wasserstein"]) == pytest.approx(plain(ref, cur), rel=1e-10)


def test_psi_of_totals_equals_psi(spark):
    pairs = samples(4)
    ref = spark.createDataFrame(pd.DataFrame({k: v[0] for k, v in pairs.items()}))
    cur = spark.createDataFrame(pd.DataFrame({k: v[1] for k, v in pairs.items()}))
    stats = drift.side_stats(ref, cur, list(pairs), sketched=True).cache()
    totals = drift.sample_totals(ref, cur, list(pairs), stats)
    got = {r["feature"]: r for r in drift.psi_of_totals(totals, stats).collect()}
    want = {r["feature"]: r for r in drift.psi(ref, cur, list(pairs)).collect()}
    assert set(got) == set(want) == set(pairs)
    for k, r in want.items():
        assert got[k]["interpretation"] == r["interpretation"]
        assert (got[k]["psi"] is None) == (r["psi"] is None) and (r["psi"] is None or got[k]["psi"] == pytest.approx(r["psi"], rel=1e-12))
