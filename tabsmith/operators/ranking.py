"""Skew-safe ranking, running totals and exact quantiles.

Several operators need "the position of a row inside its group in some
order": exact stratified splits and folds (rank by a seeded hash), the
empirical CDFs behind Kolmogorov-Smirnov and Wasserstein, and exact
medians/quartiles.  A plain ``Window.partitionBy(group).orderBy(x)`` sends a
whole group to one task; with one class or one feature holding a third of
the rows that task becomes the job.  Everything here splits each group into
ordered sub-ranges first:

1. pre-aggregate equal values (a hot value becomes one row),
2. cut the order of (group, value) into ranges (a hash prefix for seeded
   random orders, Spark's range partitions otherwise),
3. run the window per (group, range) - balanced tasks,
4. add the total of the earlier ranges, taken from a table of one row per
   (group, range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def null_safe_join(left: DataFrame, right: DataFrame, on: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where null keys match each other (as in groupBy)."""
    if not on:
        raise ValueError("null_safe_join needs at least one key")
    r = right
    renamed = {}
    for k in on:
        nk = f"__r_{k}"
        r = r.withColumnRenamed(k, nk)
        renamed[k] = nk
    cond = None
    for k in on:
        c = left[k].eqNullSafe(r[renamed[k]])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("right", "right_outer", "full", "full_outer", "outer"):
        for k in on:
            out = out.withColumn(k, F.coalesce(left[k], r[renamed[k]]))
    return out.drop(*renamed.values())


def non_null_keys(df: DataFrame, group_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Add non-null stand-ins ``(_gv<i>, _gn<i>)`` for each nullable group column.

    Windows and joins keyed on these plain columns share one hash
    partitioning; a null-safe join (``<=>``) would be keyed on rewritten
    expressions and force another full shuffle of the big side.
    """
    from pyspark.sql import types as T
    keys, out = [], df
    for i, g in enumerate(group_cols):
        f = df.schema[g]
        if not f.nullable:
            keys.append(g)
            continue
        t = f.dataType
        if isinstance(t, T.StringType):
            default = F.lit("")
        elif isinstance(t, T.NumericType):
            default = F.lit(0).cast(t)
        elif isinstance(t, T.BooleanType):
            default = F.lit(False)
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            default = F.lit(0).cast("timestamp").cast(t)
        else:
            out = out.withColumn(f"_gv{i}", F.coalesce(F.to_json(F.struct(F.col(g))), F.lit("")))
            out = out.withColumn(f"_gn{i}", F.col(g).isNull())
            keys += [f"_gv{i}", f"_gn{i}"]
            continue
        out = out.withColumn(f"_gv{i}", F.coalesce(F.col(g), default)).withColumn(f"_gn{i}", F.col(g).isNull())
        keys += [f"_gv{i}", f"_gn{i}"]
    return out, keys


def with_sorted_position(df: DataFrame, arr_col: str, length: int, value: Column, out: str,
                         strict: bool = True) -> DataFrame:
    """``out`` = number of elements of the ascending array ``arr_col`` (``length``
    elements) that are ``< value`` (``<= value`` when not ``strict``).

    A binary search of ``ceil(log2(length + 1))`` steps, one projection per step,
    all built-in codegen expressions (a ``filter`` lambda over the array is
    interpreted per element and costs ``length`` evaluations per row).
    """
    steps, p = [], 1
    while p <= length:
        steps.append(p)
        p *= 2
    d = df.withColumn(out, F.lit(0))
    for step in reversed(steps):
        nxt = F.col(out) + step
        probe = F.element_at(F.col(arr_col), F.least(nxt, F.lit(length)).cast("int"))
        hit = (probe < value) if strict else (probe <= value)
        d = d.withColumn(out, F.when((nxt <= length) & hit, nxt).otherwise(F.col(out)))
    return d


def hash_order(key: Column, seed: int | str) -> Column:
    """Deterministic pseudo-random order: md5 hex of ``seed || key``."""
    return F.md5(F.concat_ws("", F.lit(str(seed)), key.cast("string")))


def hashed_rank(df: DataFrame, group_cols: list[str], key_col: str, seed: int | str = 42,
                rank_col: str = "_rank", size_col: str = "_group_n",
                bucket_hex_digits: int = 4) -> DataFrame:
    """0-based rank of each row within ``group_cols`` ordered by md5(seed||key).

    The md5 prefix gives ``16**bucket_hex_digits`` equally likely buckets, so a
    hot group is spread over that many window partitions.  ``key_col`` must be
    unique for the ranking to be deterministic.
    """
    h = hash_order(F.col(key_col), seed)
    base, gk = non_null_keys(df, list(group_cols))
    d = (base.withColumn("_h", h)
             .withColumn("_b", F.conv(F.substring("_h", 1, bucket_hex_digits), 16, 10).cast("int")))
    part = Window.partitionBy(*gk, "_b")
    w = part.orderBy("_h", key_col)
    local = d.withColumn("_local", F.row_number().over(w) - 1)
    # bucket sizes are a partial aggregate of the key columns: a second, narrow read
    counts = d.groupBy(*gk, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    gw = Window.partitionBy(*gk).orderBy("_b")
    offsets = (counts
               .withColumn("_off", F.coalesce(F.sum("_cnt").over(
                   gw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*gk)))
               .drop("_cnt"))
    joined = local.join(offsets, gk + ["_b"])   # plain keys: reuses the window's partitioning
    extra = [k for k in gk if k not in group_cols]
    return (joined.withColumn(rank_col, (F.col("_off") + F.col("_local")).cast("long"))
                  .drop("_h", "_b", "_local", "_off", *extra))


def rank_distinct(df: DataFrame, column: str, rank_col: str = "rank", ranges: int | None = None) -> DataFrame:
    """``(column, rank)``: the distinct values, nulls last, with their 0-based rank.

    Ranks are counted inside Spark's range partitions and offset by the sizes
    of the earlier ones (one row for each range), so no task sorts all values.
    """
    from tabsmith.session import materialize
    values = df.select(F.col(f"`{column}`").alias("_v")).distinct()
    order = [F.col("_v").asc_nulls_last()]
    dealt = values.repartitionByRange(ranges, *order) if ranges else values.repartitionByRange(*order)
    rows = materialize(dealt.withColumn("_p", F.spark_partition_id()))
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_here"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_here").over(   # as many rows as ranges
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    here = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return rows.withColumn("_here", here).join(offsets, "_p").select(
        F.col("_v").alias(column), (F.col("_off") + F.col("_here")).alias(rank_col))


def _ranged(long_df: DataFrame, group_cols: list[str], value_col: str, weights: dict[str, Column],
            ranges: int | None, preaggregated: bool) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Distinct (group, value) rows with the number ``_p`` of their range in the
    order of (group, value), and the running totals before each (group, range).

    The ranges are Spark's range partitions: as many as the session has
    shuffle partitions (AQE merges small ones), so each task sorts about
    ``rows / partitions`` values at any size.  The rows are checkpointed
    because the ranges are sampled: two readers must see the same ones.
    """
    from tabsmith.session import materialize
    base, gk = non_null_keys(long_df, list(group_cols))
    carried = [g for g in group_cols if g not in gk]
    if preaggregated:
        agg = base.select(*gk, *carried, value_col, *[e.alias(n) for n, e in weights.items()])
    else:
        agg = base.groupBy(*gk, *carried, value_col).agg(*[e.alias(n) for n, e in weights.items()])
    order = [*gk, value_col]
    dealt = agg.repartitionByRange(ranges, *order) if ranges else agg.repartitionByRange(*order)
    rows = materialize(dealt.withColumn("_p", F.spark_partition_id()))
    totals = rows.groupBy(*gk, "_p").agg(*[F.sum(n).alias(f"_{n}_here") for n in weights], F.min(value_col).alias("_first"))
    # one row for each range and each group beginning inside one: bounded by ranges + groups
    gw = Window.partitionBy(*gk).orderBy("_p")
    before = gw.rowsBetween(Window.unboundedPreceding, -1)
    for n in weights:
        totals = (totals.withColumn(f"_{n}_off", F.coalesce(F.sum(f"_{n}_here").over(before), F.lit(0)))
                  .withColumn(f"{n}_total", F.sum(f"_{n}_here").over(Window.partitionBy(*gk))))
    return rows, totals.withColumn("_next_first", F.lead("_first").over(gw)).drop("_first"), gk, carried


def _run(rows: DataFrame, totals: DataFrame, gk: list[str], value_col: str, names: list[str]) -> DataFrame:
    """Running totals inside each (group, range), plus those before it."""
    w = Window.partitionBy(*gk, "_p").orderBy(value_col)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("_next_here", F.lead(value_col).over(w))
    for n in names:
        out = out.withColumn(f"_{n}_run", F.sum(n).over(run))
    out = out.join(totals.drop(*[f"_{n}_here" for n in names]), gk + ["_p"])
    for n in names:
        out = out.withColumn(f"{n}_cum", F.col(f"_{n}_off") + F.col(f"_{n}_run"))
    return out.withColumn("next_value", F.coalesce("_next_here", "_next_first")).drop(
        "_p", "_next_here", "_next_first", *[f"_{n}_run" for n in names], *[f"_{n}_off" for n in names])


def cumulative(long_df: DataFrame, group_cols: list[str], value_col: str, weights: dict[str, Column],
               buckets: int | None = None, preaggregated: bool = False) -> DataFrame:
    """Running totals of ``weights`` over ``value_col`` inside each group.

    With ``preaggregated`` the input already has one row per (group, value) and
    ``weights`` are row expressions (e.g. ``F.col("r")``), so no grouping is redone.

    Returns one row per distinct (group, value) with, for every weight ``w``:
    ``w`` (total at this value), ``w_cum`` (total up to and including this
    value), ``w_total`` (group total); plus ``next_value`` (the next larger
    distinct value of the group, null for the largest).  ``buckets`` asks for
    that many ranges instead of the session's number of shuffle partitions.
    """
    if not group_cols:
        out = cumulative(long_df.withColumn("_g", F.lit(0)), ["_g"], value_col, weights, buckets, preaggregated)
        return out.drop("_g")
    rows, totals, gk, _ = _ranged(long_df, group_cols, value_col, weights, buckets, preaggregated)
    return _run(rows, totals, gk, value_col, list(weights)).drop(*[k for k in gk if k not in group_cols])


def exact_quantiles(long_df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], names: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas/numpy default).

    Nulls are ignored; a group without values has no row (without groups: one
    row of nulls).  Position ``p*(n-1)`` is located in the totals of the ranges
    first; only the at most two ranges per quantile that hold the neighbouring
    ranks are sorted, and at most two rows per quantile reach the last aggregate.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    if not group_cols:
        one = exact_quantiles(long_df.withColumn("_g", F.lit(0)), ["_g"], value_col, probs, names, buckets)
        return one.agg(*[F.max(n).alias(n) for n in names])
    d = long_df.where(F.col(value_col).isNotNull())
    rows, totals, gk, carried = _ranged(d, group_cols, value_col, {"_n": F.count(F.lit(1))}, buckets, False)
    last = F.col("_n_total") - 1
    ranks = [(F.floor(F.lit(float(p)) * last), F.ceil(F.lit(float(p)) * last), F.lit(float(p)) * last) for p in probs]

    def holds(first, size, r):
        return (first <= r) & (r < first + size)
    wanted = None
    for lo, hi, _ in ranks:
        here = holds(F.col("__n_off"), F.col("__n_here"), lo) | holds(F.col("__n_off"), F.col("__n_here"), hi)
        wanted = here if wanted is None else wanted | here
    cum = _run(rows.join(totals.where(wanted).select(*gk, "_p"), gk + ["_p"], "left_semi"), totals, gk, value_col, ["_n"])
    first = F.col("_n_cum") - F.col("_n")   # first 0-based rank held by this value
    aggs, keep = [], None
    for (lo, hi, pos), nm in zip(ranks, names):
        cond = holds(first, F.col("_n"), lo) | holds(first, F.col("_n"), hi)
        keep = cond if keep is None else keep | cond
        lo_v = F.max(F.when(holds(first, F.col("_n"), lo), F.col(value_col)))
        hi_v = F.max(F.when(holds(first, F.col("_n"), hi), F.col(value_col)))
        aggs.append((lo_v + (hi_v - lo_v) * F.max(pos - lo)).alias(nm))
    return cum.where(keep).groupBy(*group_cols).agg(*aggs)


def unpivot_values(df: DataFrame, cols: list[str], group_cols: list[str] | None = None,
                   feature_col: str = "feature", value_col: str = "value",
                   cast: str = "double") -> DataFrame:
    """Long form (group..., feature, value) of ``cols``; one job then serves all columns."""
    group_cols = list(group_cols or [])
    if not cols:
        raise ValueError("no columns to unpivot")

    def as_value(c):
        v = F.col(f"`{c}`").cast(cast)
        return F.when(~F.isnan(v), v) if cast in ("double", "float") else v   # NaN is a missing number
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias(feature_col), as_value(c).alias(value_col))
        for c in cols]))
    return df.select(*[F.col(f"`{g}`") for g in group_cols], stacked.alias("_kv")) \
             .select(*group_cols, f"_kv.{feature_col}", f"_kv.{value_col}")
