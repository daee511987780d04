"""Filters, cleaning, deduplication (C1-C14) and type coercion.

Duplicate handling never uses a per-key window: a key held by a third of
the rows would land in one task.  Counts per key come from ``groupBy``
(partial aggregation map-side), and "keep only unique keys" reads the single
row straight out of the aggregate (``any_value``), so no join is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.dates import parse_number_lenient, parse_timestamp_lenient
from tabsmith.functions.scalars import col
from tabsmith.operators.columns import all_null_columns, columns_like
from tabsmith.operators.ranking import null_safe_join


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """C1."""
    return df.na.drop(how="all")


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """P3 (re-exported for pipelines)."""
    return df.drop(*all_null_columns(df))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one row per distinct row (nulls compare equal)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def drop_all_copies(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop *every* row whose key (or whole row) occurs more than once."""
    keys = list(subset or df.columns)
    others = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias("__n")]
    if others:
        aggs.append(F.any_value(F.struct(*[col(c) for c in others])).alias("__row"))
    g = df.groupBy(*[col(k) for k in keys]).agg(*aggs).where(F.col("__n") == 1)
    sel = [col(k) if k in keys else F.col(f"__row.`{k}`").alias(k) for k in df.columns]
    return g.select(*sel)


def duplicate_summary(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows, distinct keys, duplicated rows (beyond the first copy), percent."""
    keys = list(subset or df.columns)
    g = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").cast("bigint").alias("rows"),
                 F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
                 F.sum(F.col("n") - 1).cast("bigint").alias("duplicated_rows"),
                 F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("bigint")
                  .alias("rows_in_duplicated_keys")) \
            .withColumn("duplicated_pct", F.round(F.col("duplicated_rows") * 100.0 / F.col("rows"), 6))


def duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Every copy of every duplicated key (pandas ``duplicated(keep=False)``)."""
    keys = list(subset or df.columns)
    dup = (df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") > 1).drop("__n"))
    return null_safe_join(df, dup, keys, "left_semi")


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    """C7."""
    return df.where(condition)


def limit_range(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Values outside [lo, hi] become null."""
    x = col(column)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= lo)
    if hi is not None:
        cond = cond & (x <= hi)
    return df.withColumn(column, F.when(cond, x))


def range_counts(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """C8 report: rows equal to 0, below ``lo``, above ``hi``."""
    x = col(column)
    aggs = [F.count_if(x == 0).alias("n_zero")]
    aggs.append(F.count_if(x < lo).alias("n_below") if lo is not None else F.lit(None).cast("bigint").alias("n_below"))
    aggs.append(F.count_if(x > hi).alias("n_above") if hi is not None else F.lit(None).cast("bigint").alias("n_above"))
    return df.agg(*aggs)


OPS = {"<": lambda x, v: x < v, "<=": lambda x, v: x <= v, ">": lambda x, v: x > v,
       ">=": lambda x, v: x >= v, "==": lambda x, v: x == v, "!=": lambda x, v: x != v}

# Fixed rule set of the claims outlier filter: (column, op, value, keep_null).
CLAIM_OUTLIER_RULES = [("age_at_injury", "<=", 90, True),
                       ("average_weekly_wage", "<", 100000, True),
                       ("birth_year", ">", 1938, True),
                       ("ime_4_count", "<", 40, False)]


def outlier_condition(rules=CLAIM_OUTLIER_RULES) -> Column:
    """C9 predicate: true when a row passes every rule; ``keep_null`` says whether null passes."""
    conds = []
    for c, op, v, keep_null in rules:
        test = OPS[op](col(c), F.lit(v))
        conds.append(test | col(c).isNull() if keep_null else F.coalesce(test, F.lit(False)))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def remove_outliers(df: DataFrame, rules=CLAIM_OUTLIER_RULES) -> DataFrame:
    """Keep rows passing every rule."""
    return df.where(outlier_condition(rules))


def reduction_report(df: DataFrame, keep: Column) -> DataFrame:
    """C10 in one pass: rows before, rows kept by ``keep``, percent removed."""
    return (df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after"))
              .withColumn("reduction_pct", F.coalesce(F.round(F.try_divide(
                  (F.col("rows_before") - F.col("rows_after")) * 100.0, F.col("rows_before")), 6), F.lit(0.0))))


def reduction_pct(before: int, after: int) -> float:
    """C10."""
    return 0.0 if before == 0 else (before - after) * 100.0 / before


def replace_values(df: DataFrame, columns: list[str], mapping: dict) -> DataFrame:
    """C11: value replacement map on the given columns."""
    return df.na.replace(mapping, subset=columns)


def incoherent_rows(df: DataFrame, left: Column, right: Column, tolerance: float = 1) -> DataFrame:
    """Rows where two derivations of a value differ by more than ``tolerance``."""
    return df.where(F.abs(left - right) > tolerance)


def dependency_violations(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """Determinant values mapped to more than one dependent value."""
    return (df.groupBy(col(determinant).alias(determinant))
              .agg(F.count_distinct(col(dependent)).alias("n_values"))
              .where(F.col("n_values") > 1))


def class_balance(df: DataFrame, target: str, split: str | None = None) -> DataFrame:
    """C14: class counts (per split) with share and min/max ratio within the split."""
    keys = [split] if split else []
    g = df.groupBy(*[col(k) for k in keys], col(target).alias(target)).agg(F.count(F.lit(1)).alias("n"))
    totals = g.groupBy(*[col(k).alias(f"__{k}") for k in keys], F.lit(0).alias("__all")).agg(
        F.sum("n").alias("__sum"), F.min("n").alias("__min"), F.max("n").alias("__max"))   # one row per split
    same = F.col("__all") == F.lit(0)
    for k in keys:
        same = same & col(k).eqNullSafe(F.col(f"__{k}"))
    j = g.withColumn("__one", F.lit(0)).join(totals, same & (F.col("__one") == F.col("__all")))
    return j.select(*keys, target, "n", (F.col("n") / F.col("__sum")).alias("share"),
                    (F.col("__min") / F.col("__max")).alias("min_max_ratio"))


# -- type coercion --------------------------------------------------------------

def to_timestamp_lenient(df: DataFrame, columns: list[str]) -> DataFrame:
    """T1."""
    return df.withColumns({c: parse_timestamp_lenient(c) for c in columns})


def to_timestamp_strict(df: DataFrame, columns: list[str]) -> DataFrame:
    """T2."""
    return df.withColumns({c: col(c).cast("timestamp_ntz") for c in columns})


def to_number_lenient(df: DataFrame, columns: list[str]) -> DataFrame:
    """T3."""
    return df.withColumns({c: parse_number_lenient(c) for c in columns})


def to_text(df: DataFrame, columns: list[str], null_text: str | None = None) -> DataFrame:
    """T4: codes to text; ``null_text='nan'`` reproduces pandas' ``astype(str)``."""
    def conv(c):
        s = col(c).cast("string")
        if str(df.schema[c].dataType) in ("DoubleType()", "FloatType()"):
            # a whole double like 3.0 prints as "3.0" in both engines; keep it
            s = col(c).cast("string")
        return s if null_text is None else F.coalesce(s, F.lit(null_text))
    return df.withColumns({c: conv(c) for c in columns})


def to_bigint(df: DataFrame, columns: list[str]) -> DataFrame:
    """T5: float -> nullable bigint; fractional values raise (ANSI) instead of truncating."""
    def conv(c):
        x = col(c)
        return F.when(x.isNull(), F.lit(None).cast("bigint")) \
                .when(x == F.floor(x), x.cast("bigint")) \
                .otherwise(F.raise_error(F.lit(f"non-integral value in {c}")).cast("bigint"))
    return df.withColumns({c: conv(c) for c in columns})


def cast_types(df: DataFrame, date_columns: list[str], code_columns: list[str],
               int_columns: list[str]) -> DataFrame:
    """One projection for strict dates, codes as text and floats as bigint."""
    return to_bigint(to_text(to_timestamp_strict(df, date_columns), code_columns), int_columns)


NUMERIC_WORDS = ["age", "wage", "count", "number", "days", "year"]


def preprocess(df: DataFrame, match: str = "word") -> DataFrame:
    """All-null rows and columns out, lenient date parse for '*date*' columns,
    lenient numeric parse for names with age/wage/count/number/days/year."""
    d = drop_all_null_columns(drop_all_null_rows(df))
    dates = columns_like(d, ["date"], match)
    nums = [c for c in columns_like(d, NUMERIC_WORDS, match) if c not in dates]
    return to_number_lenient(to_timestamp_lenient(d, dates), nums)
