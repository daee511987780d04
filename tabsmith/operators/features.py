"""Feature engineering.

Row-wise work is expressions over the columns of one row, so it runs inside
whole-stage codegen with no shuffle.  Only the scaler fit aggregates.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.scalars import above, bin_code, col, impact_category, per_dependent
from tabsmith.operators.columns import numeric_columns


def interactions(df: DataFrame, cols: list[str], first: int = 5, among: int = 6) -> DataFrame:
    """G1: products ``a_x_b`` of each of the first ``first`` columns with every later
    column among the first ``among`` (5 x later-of-6 -> 15 pairs); nulls propagate."""
    base = cols[:among]
    exprs = {}
    for i, a in enumerate(base[:first]):
        for b in base[i + 1:]:
            exprs[f"{a}_x_{b}"] = col(a) * col(b)
    return df.withColumns(exprs)


def polynomial_terms(cols: list[str], degree: int = 2) -> list[tuple[str, ...]]:
    """Monomials in sklearn's order: degree by degree, lexicographic inside a degree
    ([a, b, a^2, ab, b^2] for two columns and degree 2); no bias term."""
    terms = []
    for d in range(1, degree + 1):
        terms.extend(combinations_with_replacement(cols, d))
    return terms


def polynomial(df: DataFrame, cols: list[str], degree: int = 2, limit: int = 10,
               prefix: str = "poly_") -> DataFrame:
    """Polynomial expansion of the first ``limit`` columns, named ``poly_<i>``."""
    use = cols[:limit]
    exprs = {}
    for i, t in enumerate(polynomial_terms(use, degree)):
        e = col(t[0])
        for c in t[1:]:
            e = e * col(c)
        exprs[f"{prefix}{i}"] = e.cast("double")
    return df.withColumns(exprs)


def row_statistics(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample std, median and range of the non-null values.

    Sums go column by column, without lambdas; the squares about the mean are a
    second projection, so the mean is computed once.
    """
    x = [col(c).cast("double") for c in cols]
    n = sum((v.isNotNull().cast("int") for v in x), F.lit(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in x), F.lit(0.0))
    ordered = F.array_sort(F.array_compact(F.array(*x)))
    half = F.floor(n / 2).cast("int")
    odd_mid = F.element_at(ordered, half + 1)
    even_mid = (F.element_at(ordered, F.greatest(half, F.lit(1))) + F.element_at(ordered, half + 1)) / 2
    new = ("row_mean", "row_std", "row_median", "row_range")
    keep = [c for c in df.columns if c not in new or c in cols]
    d = df.select(*[col(c) for c in keep], n.alias("__n"), F.when(n > 0, total / n).alias("__mean"),
                  F.when(n > 0, F.when(n % 2 == 1, odd_mid).otherwise(even_mid)).alias("__median"),
                  (F.array_max(ordered) - F.array_min(ordered)).alias("__range"))
    squares = sum((F.when(v.isNotNull(), (v - F.col("__mean")) * (v - F.col("__mean"))).otherwise(F.lit(0.0)) for v in x), F.lit(0.0))
    std = F.when(F.col("__n") > 1, F.sqrt(squares / (F.col("__n") - 1)))
    return d.select(*[col(c) for c in keep if c not in new], F.col("__mean").alias("row_mean"), std.alias("row_std"),
                    F.col("__median").alias("row_median"), F.col("__range").alias("row_range"))


def engineer(df: DataFrame, target: str | None = None, polynomial_features: bool = False,
             polynomial_degree: int = 2, exclude: tuple | list = ()) -> DataFrame:
    """Numeric list fixed first (target and keys excluded), then G1, optional G2, then G3."""
    nums = numeric_columns(df, exclude=list(exclude) + ([target] if target else []))
    out = interactions(df, nums)
    if polynomial_features:
        out = polynomial(out, nums, polynomial_degree)
    return row_statistics(out, nums)


def fit_standard(df: DataFrame, cols: list[str]) -> DataFrame:
    """G5 fit: (feature, mean, std) with the *population* std (sklearn's scaler)."""
    row = df.agg(*[F.struct(F.lit(c).alias("feature"), F.avg(col(c)).alias("mean"),
                            F.stddev_pop(col(c)).alias("std")).alias(f"s{i}")
                   for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[f"s{i}" for i in range(len(cols))])).alias("s")).select("s.*")


def standardize(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """G5 transform: (x - mean) / std; a zero std scales by 1 (sklearn)."""
    exprs = {}
    for c, (m, s) in params.items():
        scale = 1.0 if not s else s
        exprs[c] = (col(c) - F.lit(m)) / F.lit(scale)
    return df.withColumns(exprs)


def standard_params(params_df: DataFrame) -> dict[str, tuple[float, float]]:
    """Collect the (bounded: one row per feature) scaler table."""
    return {r["feature"]: (r["mean"], r["std"]) for r in params_df.collect()}


def claim_features(df: DataFrame, wage: str, wage_median: float | None, age: str,
                   dependents: str | None = None) -> DataFrame:
    """M9: relative wage vs the train median, financial impact category, age group."""
    exprs = {"Relative_Wage": above(wage, wage_median) if wage_median is not None else F.lit(0),
             "Age_Group": bin_code(age)}
    if dependents is not None:
        exprs["Financial Impact Category"] = impact_category(per_dependent(wage, dependents))
    return df.withColumns(exprs)


def fit_fold_standard(df: DataFrame, cols: list[str], fold_col: str = "fold") -> DataFrame:
    """S7/G5 per fold: (fold, feature, mean, std) of the rows *outside* each fold (the
    training part of that fold), population std.

    One aggregate gives (n, mean, M2) per (fold, feature); the complement of a
    fold is the total minus that fold (exact parallel-variance algebra), so no
    row is read more than once and no fold's data is copied.
    """
    from pyspark.sql import Window
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("x"))
                                  for c in cols]))
    long = df.select(col(fold_col).alias("fold"), stacked.alias("kv")).select("fold", "kv.feature", "kv.x") \
             .where(F.col("x").isNotNull())
    per = long.groupBy("fold", "feature").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"),
                                              (F.var_pop("x") * F.count(F.lit(1))).alias("m2"))
    w = Window.partitionBy("feature")            # one row per fold: k rows per feature
    n_t = F.sum("n").over(w)
    m_t = F.sum(F.col("n") * F.col("m")).over(w) / n_t
    # total M2 = sum of within-fold M2 + between-fold part
    tot = per.withColumn("n_t", n_t).withColumn("m_t", m_t)
    tot = tot.withColumn("m2_t", F.sum(F.col("m2") + F.col("n") * F.pow(F.col("m") - F.col("m_t"), 2)).over(w))
    n_c = F.col("n_t") - F.col("n")
    m_c = (F.col("n_t") * F.col("m_t") - F.col("n") * F.col("m")) / n_c
    out = tot.withColumn("n_c", n_c).withColumn("m_c", m_c)
    m2_c = (F.col("m2_t") - F.col("m2") - F.pow(F.col("m") - F.col("m_c"), 2) * F.col("n") * F.col("n_c")
            / F.col("n_t"))
    return out.select("fold", "feature", F.col("m_c").alias("mean"),
                      F.sqrt(F.greatest(m2_c, F.lit(0.0)) / F.col("n_c")).alias("std"))
