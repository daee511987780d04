"""Profiling, aggregation, top-k, correlation, histograms (A1-A24), joins and
set operations (J1-J5, U1, U2, W1, W2).

Per-column statistics use one fused aggregate or the long form
``(feature, value)`` so that a single job covers every column.  Top-n per
group is two-stage (per hash bucket, then per group over at most
``buckets * n`` candidates) so a hot group never sits in one task.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col
from tabsmith.operators.blocks import correlations, pair_rows
from tabsmith.operators.quantiles import exact_quantiles
from tabsmith.operators.ranking import null_safe_join, unpivot_values

# -- A1-A4 counts -------------------------------------------------------------------

def value_counts(df: DataFrame, column: str, ascending_by_value: bool = False) -> DataFrame:
    """A1: (value, count) without nulls, count descending (ties by value) or by value."""
    g = (df.where(col(column).isNotNull()).groupBy(col(column).alias(column))
           .agg(F.count(F.lit(1)).alias("count")))
    return g.orderBy(column) if ascending_by_value else g.orderBy(F.desc("count"), column)


def top_n_per_group(df: DataFrame, group_cols: list[str], order: list[Column], n: int,
                    spread_col: str, buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n inside each group by ``order`` (first wins ties as ordered).

    Stage 1 ranks inside (group, hash(spread_col) % buckets); only each
    bucket's top n survive, so stage 2 ranks at most ``buckets * n`` rows
    per group.  Exact: a group's top n are among its buckets' top n.
    """
    b = F.pmod(F.xxhash64(col(spread_col)), F.lit(buckets))
    s1 = df.withColumn("_tb", b).withColumn(
        "_r1", F.row_number().over(Window.partitionBy(*group_cols, "_tb").orderBy(*order)))
    s1 = s1.where(F.col("_r1") <= n).drop("_r1", "_tb")
    w2 = Window.partitionBy(*group_cols).orderBy(*order)
    return s1.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= n)


def value_counts_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, count) for several columns in one aggregation, nulls excluded."""
    long = unpivot_values(df, cols, cast="string")
    return (long.where(F.col("value").isNotNull()).groupBy("feature", "value")
                .agg(F.count(F.lit(1)).alias("count")))


def top_values(df: DataFrame, cols: list[str], n: int = 10) -> DataFrame:
    """A2: the n most frequent values of each column: (feature, rank, value, count)."""
    vc = value_counts_long(df, cols)
    return top_n_per_group(vc, ["feature"], [F.desc("count"), F.asc("value")], n, "value")


def top_with_others(df: DataFrame, column: str, n: int = 10, other: str = "Others") -> DataFrame:
    """A3: top-n values kept, the rest summed as ``Others``."""
    vc = value_counts_long(df, [column])
    top = top_n_per_group(vc, ["feature"], [F.desc("count"), F.asc("value")], n, "value") \
        .select("feature", "value", F.lit(1).alias("_top"))
    j = vc.join(top, ["feature", "value"], "left")
    lab = F.when(F.col("_top") == 1, F.col("value")).otherwise(F.lit(other))
    return j.groupBy(lab.alias(column)).agg(F.sum("count").alias("count"))


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """A4: distinct non-null values per column (exact by default; HLL when ``approx``)."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(col(c), rsd).alias(f"d{i}") for i, c in enumerate(cols)])
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"d{i}").alias("n_unique"))
                                              for i, c in enumerate(cols)])).alias("s")).select("s.*")
    vc = value_counts_long(df, cols)
    return vc.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))


# -- A5-A11 describe / missing / shape -------------------------------------------------

def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """A5: count, mean, std, min, 25%, 50%, 75%, max (exact, linear interpolation)."""
    long = unpivot_values(df, cols)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return basic.join(q, "feature", "left").select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, unique, top (most frequent; ties -> smallest value), freq."""
    vc = value_counts_long(df, cols)
    per = vc.groupBy("feature").agg(F.sum("count").alias("count"), F.count(F.lit(1)).alias("unique"))
    top = top_n_per_group(vc, ["feature"], [F.desc("count"), F.asc("value")], 1, "value") \
        .select("feature", F.col("value").alias("top"), F.col("count").alias("freq"))
    return per.join(top, "feature")


def missing_by_column(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column, missing, missing_pct) sorted by missing desc, one aggregate pass."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    long = row.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.column", "s.missing", "_n")
    out = long.select("column", "missing", (F.col("missing") * 100.0 / F.col("_n")).alias("missing_pct"))
    if only_missing:
        out = out.where(F.col("missing") > 0)
    return out.orderBy(F.desc("missing"), "column")


def missing_by_row(df: DataFrame, key: str) -> DataFrame:
    """Percent of null cells per row (key excluded from the count)."""
    cols = [c for c in df.columns if c != key]
    n_null = sum((col(c).isNull().cast("int") for c in cols), F.lit(0))
    return df.select(col(key), (n_null * 100.0 / len(cols)).alias("missing_pct"))


def shape(df: DataFrame) -> DataFrame:
    """Rows, columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def non_null_counts(df: DataFrame) -> DataFrame:
    """A9 (``info``): non-null count and type per column."""
    row = df.agg(*[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"c{i}").alias("non_null")) for i, f in enumerate(df.schema.fields)])).alias("s")).select("s.*")


def profile(df: DataFrame, key: str, numeric_cols: list[str], n_head: int = 100) -> dict[str, DataFrame]:
    """A10: describe, missing, shape and head sample as four tables."""
    from tabsmith.operators.split import head_sample
    return {"describe": describe_numeric(df, numeric_cols), "missing": missing_by_column(df),
            "shape": shape(df), "head": head_sample(df, key, n_head)}


def variance_rank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample variance per column, ascending."""
    long = unpivot_values(df, cols)
    return long.groupBy("feature").agg(F.var_samp("value").alias("variance")).orderBy("variance", "feature")


# -- A12-A15 correlations ------------------------------------------------------------------

def correlation(df: DataFrame, cols: list[str], lower_only: bool = False) -> DataFrame:
    """Pearson r for every pair, pairwise-complete (pandas ``corr``), long form
    (feature_a, feature_b, corr); any number of columns from one scan (``operators.blocks``).

    A column that is constant (or has fewer than two common values with the
    other, or an infinite one) gives a null.  NaN counts as null.
    """
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    x = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return pair_rows(x, cols, lower_only, "corr", lambda block: (correlations(block), [True] * len(block["n"])))


def high_correlation(corr_long: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of the lower triangle with |r| above the threshold."""
    return corr_long.where(F.abs("corr") > threshold)


def _indicators(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[col(c).isNull().cast("double").alias(f"x{i}") for i, c in enumerate(cols)])


def nullity_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of null indicators; columns that are never or always null are left out.  One scan."""
    return pair_rows(_indicators(df, cols), cols, True, "corr",
                     lambda block: (correlations(block), ~np.diagonal(block["constant"])))


def nullity_distance(df: DataFrame, cols: list[str]) -> DataFrame:
    """Euclidean distance between null-indicator columns, all pairs from one scan."""
    def distance(block):
        # of 0/1 columns the mean times n counts the ones, and product plus n times both means the common ones
        n, mean = block["n"], block["mean"]
        common = block["product"] + n * mean * mean.T
        return np.sqrt(np.round(n * mean + n * mean.T - 2 * common)), [True] * len(n)
    return pair_rows(_indicators(df, cols), cols, True, "distance", distance)


# -- A16-A18 histograms, box plots, medians ---------------------------------------------

def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per column over its [min, max]:
    (feature, bin, lower, upper, count), empty bins included."""
    long = unpivot_values(df, cols).where(F.col("value").isNotNull())
    rng = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx")).select(
        "feature", F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    from tabsmith.operators.drift import with_bin, with_edges
    binned = with_bin(long.join(F.broadcast(with_edges(rng, bins)), "feature"),   # one row per feature
                      F.col("value"), bins).select("feature", "bin")
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counts, ["feature", "bin"], "left")
                .select("feature", "bin", (F.col("bin") * step + F.col("lo")).alias("lower"),
                        F.when(F.col("bin") == bins - 1, F.col("hi"))
                         .otherwise((F.col("bin") + 1) * step + F.col("lo")).alias("upper"),
                        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def box_stats(df: DataFrame, cols: list[str], whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the 1.5 IQR fences), outlier count."""
    long = unpivot_values(df, cols).where(F.col("value").isNotNull())
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - whis * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + whis * F.col("iqr"))
    v = F.col("value")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    agg = long.join(F.broadcast(q.select("feature", "lo_fence", "hi_fence")), "feature").groupBy("feature").agg(
        F.min(F.when(inside, v)).alias("lower_whisker"), F.max(F.when(inside, v)).alias("upper_whisker"),
        F.count_if(~inside).alias("n_outliers"))
    return q.join(agg, "feature").select("feature", "q1", "median", "q3", "iqr", "lower_whisker",
                                         "upper_whisker", "n_outliers")


def median_of(df: DataFrame, cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """Exact medians per column (and group)."""
    long = unpivot_values(df, cols, group_cols)
    # with user groups the number of (group, feature) pairs is data-dependent: no forced broadcast
    return exact_quantiles(long, list(group_cols or []) + ["feature"], "value", [0.5], ["median"])


# -- A19-A24 prediction / importance stats, ordering, sampling, density ----------------

def prediction_stats(pred: DataFrame, confidence: str = "prediction_confidence",
                     predicted: str = "predicted_label") -> DataFrame:
    """Mean, std, min, max of the confidence; number of distinct predicted labels."""
    return pred.agg(F.avg(confidence).alias("mean_confidence"), F.stddev_samp(confidence).alias("std_confidence"),
                    F.min(confidence).alias("min_confidence"), F.max(confidence).alias("max_confidence"),
                    F.count_distinct(predicted).alias("n_predicted_classes"))


def importance_stats(imp: DataFrame, value: str = "importance") -> DataFrame:
    """Count, max, min, mean, std of an importance table."""
    return imp.agg(F.count(value).alias("n_features"), F.max(value).alias("max_importance"),
                   F.min(value).alias("min_importance"), F.avg(value).alias("mean_importance"),
                   F.stddev_samp(value).alias("std_importance"))


def order_by_value(df: DataFrame, value: str, name: str, ascending: bool = False) -> DataFrame:
    """Sort by a value with a name tie-break (deterministic)."""
    return df.orderBy(F.col(value).asc() if ascending else F.col(value).desc(), F.col(name).asc())


def top_k(df: DataFrame, value: str, name: str, k: int = 15, largest: bool = True) -> DataFrame:
    """K largest (or smallest) rows; planned as a TakeOrderedAndProject."""
    return order_by_value(df, value, name, ascending=not largest).limit(k)


def class_pairs(df: DataFrame, target: str, a: str, b: str) -> DataFrame:
    """Per class: rows, Pearson r of (a, b), means of a and b."""
    return df.groupBy(col(target).alias(target)).agg(
        F.count(F.lit(1)).alias("n"), F.corr(col(a).cast("double"), col(b).cast("double")).alias("corr"),
        F.avg(col(a)).alias(f"mean_{a}"), F.avg(col(b)).alias(f"mean_{b}"))


def stratified_sample(df: DataFrame, key: str, fraction: float, seed: int = 42, class_col: str | None = None) -> DataFrame:
    """A23 sample: keep a row when its seeded hash falls under ``fraction`` (every class
    keeps about that share; deterministic, no shuffle).

    With ``class_col`` every class keeps exactly its rounded share, by rank in the
    seeded order (see ``ranking.hashed_rank``)."""
    if class_col is not None:
        from tabsmith.operators.ranking import hashed_rank
        ranked = hashed_rank(df, [class_col], key, seed)
        return ranked.where(F.col("_rank") < F.round(F.col("_group_n") * F.lit(fraction))).select(*[col(c) for c in df.columns])
    h = F.conv(F.substring(F.md5(F.concat_ws("", F.lit(str(seed)), col(key).cast("string"))), 1, 8), 16, 10)
    return df.where(h.cast("double") / F.lit(float(16 ** 8)) < F.lit(fraction))


#: Half the width of a density bin in units of sqrt(2) bandwidths, and the terms of its expansion.  By Cramer's bound on
#: Hermite functions what is left out is below 1.09 * sum over m >= TERMS of (sqrt(2) * HALF)^m / sqrt(m!) of a kernel: 3e-10.
HALF, TERMS = 0.25, 12
#: Beyond so many sqrt(2) bandwidths from a bin's centre its kernels are below exp(-45).
FAR = 7.0


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients of the first Hermite polynomials, by power."""
    h = [[1], [0, 2]]
    for m in range(1, terms - 1):
        nxt = [0] + [2 * c for c in h[m]]
        for j, c in enumerate(h[m - 1]):
            nxt[j] -= 2 * m * c
        h.append(nxt)
    return h[:terms]


def density_curve(df: DataFrame, column: str, group_cols: list[str] | None = None,
                  grid_size: int = 50) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth ``std * n^(-1/5)``) on ``grid_size``
    equally spaced points from min to max, per group.

    A fast Gauss transform: values fall into bins of ``2 * HALF * sqrt(2)`` bandwidths and
    only add to the bin's first ``TERMS`` moments, a partial aggregate without an
    exponential; a bin gives a grid point its kernels' sum by their Hermite
    expansion about its centre, within 3e-10 of a kernel for each value.
    """
    if not group_cols:
        out = density_curve(df.withColumn("_g", F.lit(0)), column, ["_g"], grid_size)
        return out.drop("_g")
    g = list(group_cols)
    d = df.where(col(column).isNotNull()).select(*[col(c) for c in g], col(column).cast("double").alias("x"))
    stats = d.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                              F.min("x").alias("mn"), F.max("x").alias("mx"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("unit", F.when(F.col("h") > 0, F.col("h") * math.sqrt(2)))   # a constant group has no bandwidth: null density
    near = null_safe_join(d, stats.select(*g, F.col("mn").alias("lo"), "unit"), g)        # one row per group: AQE picks broadcast when small
    at = (F.col("x") - F.col("lo")) / F.col("unit")
    near = near.select(*g, at.alias("at"), F.floor(at / (2 * HALF)).alias("bin"))
    u = F.col("at") - (F.col("bin") + 0.5) * (2 * HALF)
    power = [F.lit(1.0), u]
    for m in range(2, TERMS):
        power.append(power[m // 2] * power[m - m // 2])
    bins = near.groupBy(*g, "bin").agg(*[F.sum(p).alias(f"m{m}") for m, p in enumerate(power)])
    # the expansion as exp(-s^2) times a polynomial of s, the distance from the centre
    h = _hermite(TERMS)
    coefs = [sum((F.col(f"m{m}") * (h[m][j] / math.factorial(m)) for m in range(j, TERMS) if h[m][j]), F.lit(0.0)).alias(f"c{j}") for j in range(TERMS)]
    shapes = null_safe_join(bins.select(*g, "bin", *coefs), stats.select(*g, "mn", "mx", "unit"), g)
    point = F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("i")
    step = (F.col("mx") - F.col("mn")) / (grid_size - 1)
    away = (F.col("i") * step) / F.col("unit") - (F.col("bin") + 0.5) * (2 * HALF)
    terms = shapes.select(*g, *[f"c{j}" for j in range(TERMS)], "mn", "mx", "unit", "bin", point).select(
        *g, "i", away.alias("s"), *[f"c{j}" for j in range(TERMS)]).where(F.abs("s") <= FAR)
    poly = F.col(f"c{TERMS - 1}")
    for j in range(TERMS - 2, -1, -1):
        poly = poly * F.col("s") + F.col(f"c{j}")
    sums = terms.groupBy(*g, "i").agg(F.sum(F.exp(-F.col("s") * F.col("s")) * poly).alias("k"))
    grid = stats.select(*g, "n", "h", "mn", "mx", point)
    norm = F.col("n") * F.when(F.col("h") > 0, F.col("h")) * F.lit(math.sqrt(2 * math.pi))
    full = null_safe_join(grid, sums, [*g, "i"], "left")
    return full.select(*g, "i", (F.col("mn") + F.col("i") * step).alias("grid_x"), (F.coalesce("k", F.lit(0.0)) / norm).alias("density"))


# -- joins, set operations, cross tabs ----------------------------------------------------

def join_dimension(dim: DataFrame, counts: DataFrame, on: str, how: str = "right") -> DataFrame:
    """Attach dimension attributes to a count table (all count rows kept)."""
    return dim.join(counts, on, how)


def lookup_importance(features: DataFrame, *tables: tuple[str, DataFrame]) -> DataFrame:
    """One column per importance table, 0.0 where a method did not keep the feature."""
    out = features
    for name, t in tables:
        out = out.join(t.select("feature", F.col("importance").alias(name)), "feature", "left") \
                 .withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))
    return out


def membership(df: DataFrame, column: str, values: DataFrame, value_col: str, out: str = "is_member") -> DataFrame:
    """0/1 flag for membership of ``column`` in ``values`` (distinct values joined)."""
    v = values.select(F.col(value_col).alias("__m")).distinct().withColumn("__hit", F.lit(1))
    return df.join(v, col(column) == F.col("__m"), "left") \
             .withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__m", "__hit")


def combine_features(a: DataFrame, b: DataFrame, how: str = "union", column: str = "feature") -> DataFrame:
    """Union or intersection of two feature-name tables; anything else raises."""
    x, y = a.select(column), b.select(column)
    if how == "union":
        return x.union(y).distinct()
    if how == "intersection":
        return x.intersect(y)
    raise ValueError(f"selection method must be 'union' or 'intersection', got {how!r}")


def feature_difference(a: DataFrame, b: DataFrame, column: str = "feature") -> DataFrame:
    """Names in ``a`` and not in ``b``."""
    return a.select(column).distinct().join(b.select(column), column, "left_anti")


def crosstab(df: DataFrame, x: str, y: str) -> DataFrame:
    """Long-form cross tabulation (x, y, count)."""
    return df.groupBy(col(x).alias(x), col(y).alias(y)).agg(F.count(F.lit(1)).alias("count"))


def pivot_counts(df: DataFrame, row: str, column: str, values: list | None = None) -> DataFrame:
    """Counts pivoted wide, missing cells 0."""
    p = df.groupBy(col(row).alias(row)).pivot(column, values).count()
    return p.na.fill(0)

