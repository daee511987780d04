import numpy as np
import pandas as pd
import pytest

from tabsmith.streaming import state_drift


def events(start, n, shift, seed):
    rng = np.random.default_rng(seed)
    at = pd.Timestamp(start) + pd.to_timedelta(rng.integers(0, 86_000, n), unit="s")
    v = rng.normal(shift, 1, n)
    v[::11] = np.nan
    return pd.DataFrame({"at": at, "v": v, "w": rng.integers(0, 5, n) * 1.0})


SCHEMA = "at timestamp, v double, w double"


def put(spark, pdf, folder):
    spark.createDataFrame(pdf, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, reference):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    state_drift.drift_window_stream(stream, reference, ["v", "w"], "at", f"{out}/rows", f"{out}/ck", "1 day", "1 hour", bins=8).awaitTermination(240)
    rows = spark.read.parquet(f"{out}/rows").toPandas()
    return rows.sort_values("batch_id").groupby(["feature", "window_start"]).last()


def plain(ref, cur, edges):
    p, q = (np.bincount(np.searchsorted(edges, x, "right"), minlength=len(edges) + 1) / len(x) for x in (ref, cur))
    ks = np.abs(np.cumsum(p) - np.cumsum(q))[:-1].max()
    seen = (p > 0) | (q > 0)
    a, b = p[seen] + 1e-8, q[seen] + 1e-8
    return ks, ((b - a) * np.log(b / a)).sum()


def test_state_over_batches_and_restart(spark, tmp_path):
    ref = events("2023-12-01", 2000, 0.0, 0)
    folder, out = f"{tmp_path}/in", str(tmp_path)
    days = {"2024-01-01": [events("2024-01-01", 400, 0.0, 1), events("2024-01-01", 300, 0.0, 2)], "2024-01-02": [events("2024-01-02", 500, 2.0, 3)]}
    for part in [*days["2024-01-01"], *days["2024-01-02"]]:
        put(spark, part, folder)
    run(spark, folder, out, spark.createDataFrame(ref, SCHEMA))
    # a restart adds to the state of an open window, and needs no reference any more
    more = events("2024-01-02", 200, 2.0, 4)
    days["2024-01-02"].append(more)
    put(spark, more, folder)
    got = run(spark, folder, out, None)
    profile = {r["feature"]: r for r in state_drift.stored_profile(spark, None, ["v", "w"], f"{out}/ck-reference")}
    for day, parts in days.items():
        whole = pd.concat(parts)
        for f in ("v", "w"):
            cur, row = whole[f].dropna().to_numpy(), got.loc[(f, pd.Timestamp(day))]
            ks, psi = plain(ref[f].dropna().to_numpy(), cur, np.array(profile[f]["edges"]))
            assert row["n"] == len(cur) and (row["mean"], row["sd"]) == pytest.approx((cur.mean(), cur.std(ddof=1)))
            assert (row["ks"], row["psi"]) == pytest.approx((ks, psi))
    assert got.loc[("v", pd.Timestamp("2024-01-01"))]["ks"] < 0.15 < 0.5 < got.loc[("v", pd.Timestamp("2024-01-02"))]["ks"]
    assert got.loc[("v", pd.Timestamp("2024-01-01"))]["final"]   # the watermark has passed it


def test_profile_is_written_once(spark, tmp_path):
    df = spark.createDataFrame(events("2024-01-01", 300, 0, 7), SCHEMA)
    one = state_drift.stored_profile(spark, df, ["v"], f"{tmp_path}/p")
    assert state_drift.stored_profile(spark, df.where("false"), ["v"], f"{tmp_path}/p") == one and one[0]["n"] == sum(one[0]["counts"])
    with pytest.raises(ValueError):
        state_drift.stored_profile(spark, None, ["v"], f"{tmp_path}/none")
