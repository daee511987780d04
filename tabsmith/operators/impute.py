"""Imputation and conditional fill.

``fit_*`` returns parameters (one value per column: bounded, so they are
collected as a dict); ``fill_*`` applies them lazily to any split.
Medians are exact (pandas semantics) and computed distributed, see
``quantiles.exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.functions.scalars import col
from tabsmith.operators.quantiles import exact_quantiles
from tabsmith.operators.ranking import unpivot_values


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """I1 fit: exact median per column (nulls ignored); all columns in one job."""
    long = unpivot_values(df, columns)
    rows = exact_quantiles(long, ["feature"], "value", [0.5], ["median"]).collect()
    got = {r["feature"]: r["median"] for r in rows}
    return {c: got.get(c) for c in columns}


def medians_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact medians as a (feature, median) table, without collecting."""
    return exact_quantiles(unpivot_values(df, columns), ["feature"], "value", [0.5], ["median"])


def fill_from(df: DataFrame, params: dict) -> DataFrame:
    """I1 transform / I2: fill nulls with fitted or constant values.

    A fraction (a median of 2.5) makes an integer column a double column, as in pandas.
    """
    vals = {k: v for k, v in params.items() if v is not None and k in df.columns}
    out = df
    for k, v in vals.items():
        t = df.schema[k].dataType
        if isinstance(t, T.IntegralType) and isinstance(v, float) and not v.is_integer():
            t = T.DoubleType()
        out = out.withColumn(k, F.coalesce(col(k).cast(t), F.lit(v).cast(t)))
    return out


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Constant fill (0, -1, "Unknown" ...)."""
    return fill_from(df, values)


def fill_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Fill nulls of ``target`` from ``source``."""
    return df.withColumn(target, F.coalesce(col(target), col(source)))


def derive_age(df: DataFrame, age: str, date: str, birth_year: str, out: str | None = None) -> DataFrame:
    """I4: age = year(date) - birth_year where age is null."""
    return df.withColumn(out or age, F.coalesce(
        col(age), (F.year(col(date)) - col(birth_year)).cast(df.schema[age].dataType)))


def derive_birth_year(df: DataFrame, birth_year: str, date: str, age: str,
                      out: str | None = None) -> DataFrame:
    """birth_year = year(date) - age where birth year is null."""
    return df.withColumn(out or birth_year, F.coalesce(
        col(birth_year), (F.year(col(date)) - col(age)).cast(df.schema[birth_year].dataType)))


def drop_after_use(df: DataFrame, column: str) -> DataFrame:
    """I6."""
    return df.drop(column)


def process_splits(df: DataFrame, split_col: str, median_cols: list[str], birth_year: str,
                   date: str, age: str, wage: str | None = None, train_value: str = "train",
                   dependents: str | None = None):
    """Fit medians on the train split only, then the same transform for all splits:
    median fill -> birth-year derivation -> drop the date -> claim features."""
    from tabsmith.operators.features import claim_features
    train = df.where(col(split_col) == train_value)
    meds = fit_medians(train, median_cols)
    out = fill_from(df, meds)
    out = derive_birth_year(out, birth_year, date, age)
    out = drop_after_use(out, date)
    wage_median = None
    if wage is not None:
        wage_median = meds.get(wage) if wage in meds else fit_medians(train, [wage])[wage]
        out = claim_features(out, wage=wage, wage_median=wage_median, age=age, dependents=dependents)
    return out, {"medians": meds, "wage_median": wage_median}
