"""Two-sample distances between empirical distribution functions: KS and Wasserstein.

Both are exact, and neither sorts the samples:

1. Rank sketches of both samples give each feature shared splitters, some
   ``4 sqrt(n)`` of them, between its quantiles.
2. One scan counts the rows of both samples in every bucket between two
   splitters, with the least and greatest value and the sum of the distances to
   the bucket's end.  Prefix sums of these totals give D = F_ref - F_cur at every splitter.
3. Inside a bucket D stays within its value at either end plus or minus the
   samples' shares there.  A bucket that cannot hold a gap above the largest one at a
   splitter, and where D keeps its sign or that has one value only, is done: its
   part of the Wasserstein integral follows from its totals.
4. The values of the other buckets alone are counted and put in order, bucket by bucket.

Splitters and totals are bounded by ``MOST_BUCKETS`` for each feature and go
through the driver.  The module is pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.operators.blocks import numbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_BUCKETS, MOST_BUCKETS = 256, 50_000
#: Quantiles that a sketch is asked for, and its accuracy.
CUTS, ACCURACY = 400, 2_000
PROBS = [i / CUTS for i in range(CUTS + 1)]

TOTALS = "f int, b int, r long, c long, rs double, cs double, lo double, hi double"
VALUES = "f int, b int, v double, r long, c long"


def _samples(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """``(is_ref, x0, x1, ...)`` of both samples; NaN is null."""
    def side(df, is_ref):
        xs = [F.col(f"`{c}`").cast("double") for c in cols]
        return df.select(F.lit(float(is_ref)).alias("is_ref"), *[F.when(~F.isnan(x), x).alias(f"x{i}") for i, x in enumerate(xs)])
    return side(ref, 1).unionByName(side(cur, 0))


def sketch_columns(x: str) -> list:
    """Aggregates of column ``x`` that ``splitters`` needs: its count, greatest value and quantiles."""
    return [F.count(x).alias("n"), F.max(x).alias("mx"), F.percentile_approx(x, PROBS, ACCURACY).alias("q")]


def sketches(both: DataFrame, k: int) -> list[list[dict]]:
    """For each feature the sketches of the samples that have a value."""
    aggs = [F.struct(*sketch_columns(f"x{i}")).alias(f"s{i}") for i in range(k)]
    sides = both.groupBy("is_ref").agg(*aggs).collect()
    return [[r[f"s{i}"].asDict() for r in sides if r[f"s{i}"]["q"]] for i in range(k)]


def splitters(found: list[list[dict]], buckets: int | None = None, edges: list[list[float]] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Splitters of each feature, ``edges`` among them, and the greatest value of each."""
    cuts, top = [], np.full(len(found), np.nan)
    for i, sides in enumerate(found):
        made = [np.array(edges[i], float)] if edges else []
        most = max((s["n"] for s in sides), default=0)
        want = buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, int(4 * most ** 0.5)))
        for s in sides:
            quantiles = np.array(s["q"], float)
            with np.errstate(invalid="ignore"):
                made.append(np.interp(np.linspace(0, 1, max(2, want // 2 + 1)), PROBS, quantiles))
            made.append(quantiles)   # repeated values get a bucket of their own
            top[i] = np.fmax(top[i], s["mx"])
        cut = np.unique(np.concatenate(made)) if made else np.zeros(0)
        cuts.append(cut[~np.isnan(cut)])
    return cuts, top


def bucket_totals(both: DataFrame, cuts: list[np.ndarray], top: np.ndarray) -> DataFrame:
    """``TOTALS`` rows: counts of both samples, sums of distances to the bucket's end, least and greatest value."""
    ends = [np.append(c, t) for c, t in zip(cuts, top, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [len(e) for e in ends]
        n = [np.zeros((2, s), np.int64) for s in sizes]
        far = [np.zeros((2, s)) for s in sizes]
        low, high = [np.full(s, np.inf) for s in sizes], [np.full(s, -np.inf) for s in sizes]
        with np.errstate(invalid="ignore"):
            for batch in batches:
                x = numbers(batch)
                side = x[:, 0].astype(np.int64)
                for f, cut in enumerate(cuts):
                    there = ~np.isnan(x[:, f + 1])
                    v, s = x[there, f + 1], side[there]
                    b = np.searchsorted(cut, v, "right")
                    for k in (0, 1):
                        mine = s == k
                        n[f][k] += np.bincount(b[mine], minlength=sizes[f])
                        far[f][k] += np.bincount(b[mine], ends[f][b[mine]] - v[mine], minlength=sizes[f])
                    np.minimum.at(low[f], b, v)
                    np.maximum.at(high[f], b, v)
        for f, size in enumerate(sizes):
            b = np.flatnonzero(n[f].any(axis=0))
            yield pa.RecordBatch.from_pydict({
                "f": pa.array(np.full(len(b), f, np.int32)), "b": pa.array(b.astype(np.int32)), "r": pa.array(n[f][1, b]), "c": pa.array(n[f][0, b]),
                "rs": pa.array(far[f][1, b]), "cs": pa.array(far[f][0, b]), "lo": pa.array(low[f][b]), "hi": pa.array(high[f][b])})
    return both.mapInArrow(run, TOTALS).groupBy("f", "b").agg(
        *[F.sum(c).alias(c) for c in ("r", "c", "rs", "cs")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def resolve(cut: np.ndarray, top: float, totals: dict[str, np.ndarray]) -> dict:
    """Largest gap and Wasserstein part known from the totals of one feature, and the buckets that are open.

    ``totals``: arrays over the buckets that hold a value, in order.
    """
    r, c = totals["r"], totals["c"]
    n, m = int(r.sum()), int(c.sum())
    if not n or not m:
        return {"n": n, "m": m, "ks": None, "w": 0.0, "open": np.zeros(0, np.int64)}
    after_r, after_c = np.cumsum(r), np.cumsum(c)
    before_r, before_c = after_r - r, after_c - c
    start, stop = before_r / n - before_c / m, after_r / n - after_c / m
    most = np.minimum(start + r / n, stop + c / m)
    least = np.maximum(start - c / m, stop - r / n)
    ks = float(np.abs(stop).max())
    # from one bucket to the next that holds a value: empty ones between keep the gap
    end = np.append(cut, top)[totals["b"]]
    begin = np.where(totals["b"] > 0, cut[np.maximum(totals["b"] - 1, 0)], totals["lo"]) if len(cut) else totals["lo"]
    nexts = np.append(begin[1:], end[-1])
    with np.errstate(invalid="ignore"):
        between = np.where(nexts > end, np.abs(stop) * (nexts - end), 0.0)
        whole = np.abs(start * (end - begin) + totals["rs"] / n - totals["cs"] / m)
        single = totals["lo"] == totals["hi"]
        whole = np.where(single, np.abs(start) * (totals["lo"] - begin) + np.abs(stop) * (end - totals["lo"]), whole)
    finite = np.isfinite(begin) & np.isfinite(end) & np.isfinite(totals["lo"]) & np.isfinite(totals["hi"])
    one_sign = (least >= 0) | (most <= 0)
    quiet = np.maximum(most, -least) <= ks
    done = finite & (single | one_sign & quiet)
    return {"n": n, "m": m, "ks": ks, "w": float(whole[done].sum() + between[np.isfinite(between)].sum()), "open": np.flatnonzero(~done),
            "before_r": before_r, "before_c": before_c, "begin": begin, "end": end}


def open_values(both: DataFrame, cuts: list[np.ndarray], opened: list[np.ndarray]) -> DataFrame:
    """``VALUES`` rows: values of the open buckets with their counts in both samples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = numbers(batch)
            side = x[:, 0]
            for f, cut in enumerate(cuts):
                if not opened[f].any():
                    continue
                there = ~np.isnan(x[:, f + 1])
                v, s = x[there, f + 1], side[there]
                b = np.searchsorted(cut, v, "right")
                keep = opened[f][b]
                if not keep.any():
                    continue
                v, at = np.unique(v[keep], return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "f": pa.array(np.full(len(v), f, np.int32)), "b": pa.array(np.searchsorted(cut, v, "right").astype(np.int32)), "v": pa.array(v),
                    "r": pa.array(np.bincount(at, s[keep] == 1, len(v)).astype(np.int64)),
                    "c": pa.array(np.bincount(at, s[keep] == 0, len(v)).astype(np.int64))})
    return both.mapInArrow(run, VALUES).groupBy("f", "b", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


RESULT = "feature string, n_ref long, n_cur long, ks_statistic double, wasserstein double"


class Totals:
    """Bucket totals of two samples, collected: at most ``MOST_BUCKETS`` and the edges for each feature."""

    def __init__(self, ref: DataFrame, cur: DataFrame, cols: list[str], found: list[list[dict]] | None = None,
                 buckets: int | None = None, edges: list[list[float]] | None = None):
        self.spark, self.cols = ref.sparkSession, cols
        self.both = _samples(ref, cur, cols)
        self.cuts, self.top = splitters(sketches(self.both, len(cols)) if found is None else found, buckets, edges)
        rows = bucket_totals(self.both, self.cuts, self.top).toPandas().sort_values(["f", "b"])
        self.of = [{k: v.to_numpy() for k, v in rows[rows["f"] == f].items()} for f in range(len(cols))]

    def between(self, f: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the reference and of the current sample from each edge, which is a splitter, to below the next."""
        at = np.searchsorted(self.of[f]["b"], np.searchsorted(self.cuts[f], edges, "right"))
        sums = [np.concatenate([[0], np.cumsum(self.of[f][k])]) for k in "rc"]
        return np.diff(sums[0][at]), np.diff(sums[1][at])


def ks_wasserstein(ref: DataFrame, cur: DataFrame, cols: list[str], buckets: int | None = None, totals: Totals | None = None) -> DataFrame:
    """``RESULT`` rows of the features with a value; an empty side gives a null statistic and distance 0."""
    spark = ref.sparkSession
    if not cols:
        return spark.createDataFrame([], RESULT)
    totals = totals or Totals(ref, cur, cols, buckets=buckets)
    both, cuts, top = totals.both, totals.cuts, totals.top
    known, opened, edges = [], [np.zeros(len(c) + 1, bool) for c in cuts], []
    for f, name in enumerate(cols):
        mine = totals.of[f]
        if not len(mine["b"]):
            continue
        got = resolve(cuts[f], top[f], mine)
        known.append((name, got["n"], got["m"], got["ks"], got["w"]))
        at = mine["b"][got["open"]]
        opened[f][at] = True
        last = mine["b"][-1]
        edges += [(f, int(b), int(got["before_r"][i]), int(got["before_c"][i]), got["n"], got["m"],
                   None if b == mine["b"][0] else float(got["begin"][i]), None if b == last else float(got["end"][i]))
                  for i, b in zip(got["open"], at, strict=True)]
    done = spark.createDataFrame(known, RESULT)
    if not edges:
        return done
    rows = open_values(both, cuts, opened).join(
        F.broadcast(spark.createDataFrame(edges, "f int, b int, r0 long, c0 long, n long, m long, begin double, stop double")), ["f", "b"])
    w = Window.partitionBy("f", "b").orderBy("v")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.abs((F.col("r0") + F.sum("r").over(run)) / F.col("n") - (F.col("c0") + F.sum("c").over(run)) / F.col("m"))
    start = F.abs(F.col("r0") / F.col("n") - F.col("c0") / F.col("m"))
    after = F.coalesce(F.lead("v").over(w), F.col("stop"))

    def area(height, low, high):   # nothing without a height or a width, whatever the other is
        return F.when((height > 0) & (high > low), height * (high - low)).otherwise(0.0)
    head = F.when(F.lag("v").over(w).isNull(), area(start, F.col("begin"), F.col("v"))).otherwise(0.0)
    tail = area(gap, F.col("v"), after)
    exact = rows.select("f", gap.alias("gap"), (head + tail).alias("part")).groupBy("f").agg(F.max("gap").alias("gap"), F.sum("part").alias("part"))
    names = F.array(*[F.lit(c) for c in cols])
    exact = exact.select(F.element_at(names, F.col("f") + 1).alias("feature"), "gap", "part")
    return done.join(F.broadcast(exact), "feature", "left").select(   # a row for each feature
        "feature", "n_ref", "n_cur", F.greatest("ks_statistic", "gap").alias("ks_statistic"),
        (F.col("wasserstein") + F.coalesce("part", F.lit(0.0))).alias("wasserstein"))
