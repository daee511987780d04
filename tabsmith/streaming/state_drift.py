"""Drift of event-time windows against a reference, from keyed state.

The reference is read once: its bins (quantiles of a rank sketch), the rows in
each, count, mean and deviation are written beside the checkpoint and read from
there by every later start.  Arriving rows are reduced inside their
partitions to partial counts by (feature, window, bin), so a feature or window of
very many rows sends a few rows from each partition; the state of a (feature, window)
holds the window's bin counts and moments, to which each micro-batch adds.

Every update gives the window's row so far: Kolmogorov-Smirnov statistic over the bins'
edges, population stability index, mean and deviation.  Once the watermark has passed
a window its last row has ``final`` true and its state is dropped; rows that
come later are left out, as by every watermark.  The module is pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, EPS = 20, 1e-8
REFERENCE = "feature string, edges array<double>, counts array<long>, n long, mean double, sd double"
RESULT = ("feature string, window_start timestamp, window_end timestamp, n long, mean double, sd double, "
          "ks double, psi double, mean_shift double, final boolean")
STATE = "counts array<long>, n long, mean double, m2 double, start long, stop long"
PARTIAL = "feature string, start timestamp, stop timestamp, counts array<long>, n long, mean double, m2 double"


def bin_of(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """0 below the first edge, then the number of edges that are not above the value."""
    return np.searchsorted(edges, values, "right")


def reference_profile(reference: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """``REFERENCE`` rows: one aggregate for the edges and moments, one for the counts."""
    x = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"x{i}") for i, c in enumerate(features)]
    rows = reference.select(*x)
    probs = [i / bins for i in range(1, bins)]
    head = rows.agg(*[e for i in range(len(features)) for e in (
        F.count(f"x{i}").alias(f"n{i}"), F.avg(f"x{i}").alias(f"m{i}"), F.stddev_samp(f"x{i}").alias(f"s{i}"),
        F.percentile_approx(f"x{i}", probs, 100 * bins).alias(f"q{i}"))]).first()
    edges = [sorted(set(head[f"q{i}"] or [])) for i in range(len(features))]
    cells = []
    for i, e in enumerate(edges):
        place = sum((F.when(F.col(f"x{i}") >= v, 1).otherwise(0) for v in e), F.lit(0))
        cells.append(F.when(F.col(f"x{i}").isNotNull(), F.struct(F.lit(i).alias("f"), place.alias("b"))))
    counted = rows.select(F.explode(F.array(*cells)).alias("c")).where("c IS NOT NULL").groupBy("c.f", "c.b").count().collect()   # bins of each feature
    counts = [[0] * (len(e) + 1) for e in edges]
    for r in counted:
        counts[r["f"]][r["b"]] = r["count"]
    data = [(c, [float(v) for v in edges[i]], counts[i], head[f"n{i}"], head[f"m{i}"], head[f"s{i}"]) for i, c in enumerate(features)]
    return reference.sparkSession.createDataFrame(data, REFERENCE)


def stored_profile(spark: SparkSession, reference: DataFrame | None, features: list[str], path: str, bins: int = BINS) -> list[dict]:
    """The profile at ``path``; written there first where nothing is.  ``reference`` may be None once it is written."""
    from tabsmith.operators.tables import table_exists
    if not table_exists(spark, path):
        if reference is None:
            raise ValueError(f"no profile of a reference at {path}")
        reference_profile(reference, features, bins).write.parquet(path)
    return [r.asDict() for r in spark.read.schema(REFERENCE).parquet(path).where(F.col("feature").isin(features)).collect()]   # a row for each feature


def compare(profile: dict, counts: np.ndarray, n: int, mean: float, m2: float) -> dict:
    """Statistics of a window against the reference's profile."""
    ref, total = np.array(profile["counts"], float), profile["n"]
    ks = psi = shift = None
    if n and total:
        p, q = ref / total, counts / n
        ks = float(np.abs(np.cumsum(p) - np.cumsum(q))[:-1].max(initial=0.0))
        seen = (p > 0) | (q > 0)
        a, b = p[seen] + EPS, q[seen] + EPS
        psi = float(((b - a) * np.log(b / a)).sum())
        shift = abs(mean - profile["mean"]) / ((profile["sd"] or 0.0) + EPS)
    sd = float(np.sqrt(m2 / (n - 1))) if n > 1 else None
    return {"n": int(n), "mean": float(mean) if n else None, "sd": sd, "ks": ks, "psi": psi, "mean_shift": shift}


def window_drift(stream: DataFrame, profiles: list[dict], time_col: str, window: str, lateness: str) -> DataFrame:
    """``RESULT`` rows of a streaming frame, in update mode."""
    features = [p["feature"] for p in profiles]
    known = {p["feature"]: p for p in profiles}
    edges = {p["feature"]: np.array(p["edges"], float) for p in profiles}
    timed = stream.where(F.col(time_col).isNotNull())
    at = F.window(F.col(time_col), window)
    rows = timed.select(F.col(time_col), at.alias("w"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    rows = rows.select(time_col, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), *[f"x{i}" for i in range(len(features))])

    def reduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for (start, stop), mine in part.groupby(["start", "stop"], sort=False):
                for i, f in enumerate(features):
                    v = mine[f"x{i}"].to_numpy(float, na_value=np.nan)
                    v = v[~np.isnan(v)]
                    if len(v):
                        c = np.bincount(bin_of(edges[f], v), minlength=len(edges[f]) + 1)
                        out.append((mine[time_col].max(), f, start, stop, c.tolist(), len(v), v.mean(), ((v - v.mean()) ** 2).sum()))
            yield pd.DataFrame(out, columns=[time_col, "feature", "start", "stop", "counts", "n", "mean", "m2"])
    partial = rows.mapInPandas(reduce, f"`{time_col}` timestamp, " + PARTIAL).withWatermark(time_col, lateness)

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        feature, start, stop = key
        profile = known[feature]
        if state.exists:
            counts, n, mean, m2 = np.array(state.get[0], np.int64), *state.get[1:4]
        else:
            counts, n, mean, m2 = np.zeros(len(edges[feature]) + 1, np.int64), 0, 0.0, 0.0
        final = state.hasTimedOut
        if not final:
            for part in parts:
                for c, k, m, s in zip(part["counts"], part["n"], part["mean"], part["m2"], strict=True):
                    counts = counts + np.asarray(c)
                    delta = m - mean
                    m2 += s + delta * delta * n * k / (n + k)
                    mean += delta * k / (n + k)
                    n += int(k)
        row = compare(profile, counts, n, mean, m2)
        yield pd.DataFrame([{"feature": feature, "window_start": start, "window_end": stop, **row, "final": bool(final)}])
        if final:
            state.remove()
        else:
            state.update((counts.tolist(), int(n), float(mean), float(m2), int(pd.Timestamp(start).value), int(pd.Timestamp(stop).value)))
            state.setTimeoutTimestamp(max(int(pd.Timestamp(stop).value // 1_000_000), state.getCurrentWatermarkMs() + 1))
    return partial.groupBy("feature", "start", "stop").applyInPandasWithState(
        update, RESULT, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def drift_window_stream(stream: DataFrame, reference: DataFrame | None, numerical: list[str], time_col: str, results_path: str,
                        checkpoint: str, window: str = "1 day", lateness: str = "1 hour", bins: int = BINS, available_now: bool = True):
    """Start the monitor: each micro-batch's rows go to ``<results_path>/batch_id=<n>``.

    ``reference`` is scanned by the first start alone; its profile is kept in ``<checkpoint>-reference``.
    """
    from tabsmith.streaming.monitor import start
    profiles = stored_profile(stream.sparkSession, reference, numerical, f"{checkpoint.rstrip('/')}-reference", bins)
    out = window_drift(stream, profiles, time_col, window, lateness)

    def handle(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{results_path}/batch_id={batch_id}")
    return start(out, handle, checkpoint, available_now, mode="update")
