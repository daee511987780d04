"""Encoders (E1-E8, K27): fit on one frame, transform any frame.

Fitted parameters are DataFrames of any size.  Only wide one-hot columns need
their categories on the driver, since they are columns of the plan; the long
form does not.  Frequency maps are never collected: they are joined, and
AQE picks a broadcast join when the runtime size of the map is under the
broadcast threshold (a sort-merge join with skew splitting otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col, cyclic_pair
from tabsmith.operators.ranking import rank_distinct
from tabsmith.session import stored

# -- E1 / K27 label encoder --------------------------------------------------

def fit_labels(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Sorted distinct values -> 0..k-1; null (if present) -> k.

    Returns the mapping (value, label), of any size: see ``ranking.rank_distinct``.
    """
    ranked = rank_distinct(df, column, "__rank", ranges)
    return ranked.select(col(column).alias("value"), F.col("__rank").cast("int").alias("label"))


#: A label map of at most this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


def _label_map(mapping: DataFrame) -> DataFrame:
    """The map under join names, broadcast behind a check of its size."""
    m = mapping.select(F.col("value").alias("__v"), F.col("label").alias("__label"))
    return F.broadcast(m) if mapping.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else m


def encode_labels(df: DataFrame, mapping: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Replace ``column`` (or add ``out``) with its label; unseen values -> null."""
    out = out or column
    m = _label_map(mapping)
    j = df.join(m, col(column).eqNullSafe(F.col("__v")), "left")
    cols = [F.col("__label").alias(out) if c == out else col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("__label").alias(out))
    return j.select(*cols)


def decode_labels(df: DataFrame, mapping: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Label -> original value."""
    out = out or column
    m = _label_map(mapping)
    j = df.join(m, col(column) == F.col("__label"), "left")
    cols = [F.col("__v").alias(out) if c == out else col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("__v").alias(out))
    return j.select(*cols)


# -- E2 one-hot, drop first ----------------------------------------------------

def one_hot_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """E2 fit as a table ``(feature, value, position)``: sorted categories per column as
    strings, null last.  Any number of categories; ``one_hot_long`` applies it and S3/S5
    writers keep it."""
    out = None
    for c in columns:
        one = rank_distinct(df.select(col(c).cast("string").alias("value")), "value", "position")
        one = one.select(F.lit(c).alias("feature"), "value", F.col("position").cast("int").alias("position"))
        out = one if out is None else out.unionByName(one)
    return out


def one_hot_long(df: DataFrame, key: str, categories: DataFrame, drop_first: bool = True) -> DataFrame:
    """E2 transform in long form: ``(key, feature, position)`` of every flag that is 1.

    The form for many categories: it has a row per row and feature, not a column per value.
    """
    features = [r[0] for r in categories.select("feature").distinct().collect()]   # column names
    long = df.select(col(key), F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("string").alias("value"))
                                                   for c in sorted(features)])).alias("x")).select(key, "x.*")
    c = categories.select(F.col("feature").alias("__f"), F.col("value").alias("__v"), "position")
    hit = long.join(c, (F.col("feature") == F.col("__f")) & F.col("value").eqNullSafe(F.col("__v")))
    return hit.where(F.col("position") > 0 if drop_first else F.lit(True)).select(key, "feature", "position")


def fit_one_hot(df: DataFrame, columns: list[str]) -> dict:
    """E2 fit for wide columns: sorted categories per column (null is its own, last, category).

    Wide columns are the caller's choice: their number is the number of
    categories, which the plan must hold.  For many categories take
    ``one_hot_categories`` and ``one_hot_long``.
    """
    row = df.agg(*[F.array_sort(F.collect_set(col(c))).alias(f"s{i}") for i, c in enumerate(columns)],
                 *[F.max(col(c).isNull()).alias(f"z{i}") for i, c in enumerate(columns)]).first()
    return {c: list(row[f"s{i}"]) + [None] * bool(row[f"z{i}"]) for i, c in enumerate(columns)}


def one_hot(df: DataFrame, categories: dict, drop_first: bool = True,
            on_unseen: str = "zero", keep_source: bool = False) -> DataFrame:
    """E2 transform: ``<feature>_<value>`` 0/1 columns, the first category dropped.

    ``on_unseen='zero'`` leaves all flags 0 for a value not seen in fit;
    ``'error'`` fails the job when such a value is met.
    """
    out = [(c, col(c)) for c in df.columns if keep_source or c not in categories]
    bad, msgs = None, []
    for c, cats in categories.items():
        use = cats[1:] if drop_first else cats
        for v in use:
            cond = col(c).isNull() if v is None else col(c).eqNullSafe(F.lit(v))
            out.append((f"{c}_{'nan' if v is None else v}", cond.cast("int")))
        if on_unseen == "error":
            seen = F.lit(False)
            for v in cats:
                seen = seen | (col(c).isNull() if v is None else col(c).eqNullSafe(F.lit(v)))
            bad = ~seen if bad is None else bad | ~seen
            msgs.append(f"unseen category in {c}")
    if bad is not None and out:
        # the check rides on a kept output column so the optimizer cannot prune it away
        name, expr = out[0]
        out[0] = (name, F.when(bad, F.raise_error(F.lit("; ".join(msgs)))).otherwise(expr))
    return df.select(*[e.alias(n) for n, e in out])


# -- E3 / E4 frequency encoding -------------------------------------------------

def fit_frequency(df: DataFrame, columns: list[str], unknown: str = "Unknown") -> DataFrame:
    """E3/E4 fit: (feature, value, freq) for all columns in one aggregation.

    Nulls count as ``unknown``; freq = count / rows of the fit frame.
    """
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(col(c).cast("string"), F.lit(unknown)).alias("value"))
        for c in columns]))
    long = df.select(stacked.alias("kv")).select("kv.feature", "kv.value")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    # the fitted map is a parameter table: checkpoint it so every transform (one join per
    # column) reads it instead of re-running the fit over the training data
    from tabsmith.session import materialize
    counts = materialize(counts)
    totals = counts.groupBy(F.col("feature").alias("__f")).agg(F.sum("n").alias("__total"))   # one row per feature
    return counts.join(totals, F.col("feature") == F.col("__f")).select("feature", "value", (F.col("n") / F.col("__total")).alias("freq"))


def frequency(df: DataFrame, mapping: DataFrame, columns: list[str], prefix: str = "Enc ",
              unknown: str = "Unknown", drop_source: bool = False) -> DataFrame:
    """E3/E4 transform: ``Enc <col>`` = fitted frequency; values unseen in fit -> 0."""
    out = df
    for c in columns:
        m = (mapping.where(F.col("feature") == c)
                    .select(F.col("value").alias(f"__v_{c}"), F.col("freq").alias(f"__f_{c}")))
        key = F.coalesce(col(c).cast("string"), F.lit(unknown))
        out = out.join(m, key == F.col(f"__v_{c}"), "left") \
                 .withColumn(f"{prefix}{c}", F.coalesce(F.col(f"__f_{c}"), F.lit(0.0))) \
                 .drop(f"__v_{c}", f"__f_{c}")
    return out.drop(*columns) if drop_source else out


# -- E5 / M3 sine-cosine ------------------------------------------------------------

def sine_cosine(df: DataFrame, column: str, mapping: dict, period: float | None = None,
                drop_source: bool = True) -> DataFrame:
    """E5: map categories to ordinals, then (sin, cos) on a circle of ``period``."""
    from tabsmith.functions.scalars import lookup
    period = period or len(mapping)
    s, c = cyclic_pair(lookup(column, mapping), period)
    out = df.withColumn(f"{column}_Sin", s).withColumn(f"{column}_Cos", c)
    return out.drop(column) if drop_source else out


# -- E6 hash buckets, E7 registry ---------------------------------------------------

def hash_buckets(df: DataFrame, column: str, n: int, out: str | None = None) -> DataFrame:
    """Stable bucket id in [0, n) from xxhash64."""
    return df.withColumn(out or f"{column}_hash", F.pmod(F.xxhash64(col(column)), F.lit(n)).cast("int"))


def frequency_ties(mapping: DataFrame) -> DataFrame:
    """Features whose frequency encoding maps two values to the same number (E6 trigger)."""
    return (mapping.groupBy("feature", "freq").agg(F.count(F.lit(1)).alias("n_values"))
                   .where(F.col("n_values") > 1)
                   .groupBy("feature").agg(F.sum("n_values").alias("tied_values")))


def encoder_registry(spark, encoders: dict[str, list[str]]) -> DataFrame:
    """Encoder name -> encoded columns, as a table."""
    rows = [(e, c) for e, cols in encoders.items() for c in cols]
    return spark.createDataFrame(rows, "encoder string, column string")


def encoder_summary(df: DataFrame, encoders: dict[str, list[str]]) -> DataFrame:
    """E7 with the fitted sizes: (encoder, column, n_categories, has_null) from one
    long-form aggregation over every encoded column."""
    cols = sorted({c for cs in encoders.values() for c in cs})
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value"))
                                  for c in cols]))
    per = (df.select(stacked.alias("kv")).select("kv.column", "kv.value")
             .groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
             .groupBy("column").agg(F.count("value").alias("n_categories"),
                                    F.max(F.col("value").isNull()).alias("has_null")))
    reg = F.explode(F.array(*[F.struct(F.lit(e).alias("encoder"), F.lit(c).alias("column"))
                              for e, cs in encoders.items() for c in cs]))
    names = per.select("column", "n_categories", "has_null")
    return names.select(reg.alias("r"), "*").where(F.col("r.column") == F.col("column")) \
                .select("r.encoder", "column", "n_categories", "has_null")


# -- E8 full pre-split encoding ---------------------------------------------------

def encode_frame(df: DataFrame, target: str, date_columns: list[str] | None = None,
                 one_hot_columns: list[str] | None = None,
                 ordinal_maps: dict[str, tuple[dict, float]] | None = None) -> tuple[DataFrame, dict]:
    """All-null rows/cols out, duplicates out, label-encode target, date parts,
    one-hot, sine-cosine.  Returns (frame, fitted parameters).

    The frame without duplicates is written once to the shared folder: every fit and the result read it."""
    from tabsmith.functions.dates import components
    from tabsmith.operators.clean import drop_all_null_columns, drop_all_null_rows
    d = stored(drop_all_null_columns(drop_all_null_rows(df)).dropDuplicates(), "encode-frame")
    params = {}
    if target in d.columns:
        m = fit_labels(d, target)
        params["target_labels"] = m
        d = encode_labels(d, m, target)
    for dc in date_columns or []:
        if dc in d.columns:
            for k, e in components(dc).items():
                d = d.withColumn(f"{dc}_{k}", e)
    ohc = [c for c in (one_hot_columns or []) if c in d.columns]
    if ohc:
        cats = fit_one_hot(d, ohc)
        params["one_hot"] = cats
        d = one_hot(d, cats)
    for c, (mapping, period) in (ordinal_maps or {}).items():
        if c in d.columns:
            d = sine_cosine(d, c, mapping, period)
    return d, params


# -- M11 category codes -------------------------------------------------------------

def category_codes(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Pandas ``cat.codes``: sorted distinct non-null values -> 0..k-1, null -> -1."""
    m = fit_labels(df.where(col(column).isNotNull()), column)
    coded = encode_labels(df, m, column, out or column)
    o = out or column
    return coded.withColumn(o, F.coalesce(F.col(o), F.lit(-1)))
