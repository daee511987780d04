"""Date operators (D1-D8) and the public-holiday calendar.

The holiday calendar is generated in Spark from rules (fixed dates with
weekend-observed shifts, n-th weekday, last weekday) for the years found in
the data: at most ~15 rows per year, so broadcasting it is size-safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions import dates as dx
from tabsmith.functions.scalars import col

# ---------------------------------------------------------------------------
# US federal plus New York State public-holiday rules.
# ("fixed", month, day, first_year)            observed Fri/Mon when on Sat/Sun
# ("nth", month, weekday Mon=0, n, first_year)
# ("last", month, weekday Mon=0, first_year)
# ("after_nth", month, weekday, n, days_after, first_year)
HOLIDAY_RULES = {
    "US": [
        ("New Year's Day", "fixed", 1, 1, 0, 0, 1871),
        ("Martin Luther King Jr. Day", "nth", 1, 0, 3, 0, 1986),
        ("Washington's Birthday", "nth", 2, 0, 3, 0, 1971),
        ("Memorial Day", "last", 5, 0, 0, 0, 1971),
        ("Juneteenth National Independence Day", "fixed", 6, 19, 0, 0, 2021),
        ("Independence Day", "fixed", 7, 4, 0, 0, 1871),
        ("Labor Day", "nth", 9, 0, 1, 0, 1894),
        ("Columbus Day", "nth", 10, 0, 2, 0, 1971),
        ("Veterans Day", "fixed", 11, 11, 0, 0, 1954),
        ("Thanksgiving", "nth", 11, 3, 4, 0, 1871),
        ("Christmas Day", "fixed", 12, 25, 0, 0, 1871),
    ],
    "NY": [
        ("Lincoln's Birthday", "fixed", 2, 12, 0, 0, 1900),
        ("Susan B. Anthony Day", "fixed", 2, 15, 0, 0, 2004),
        ("Election Day", "after_nth", 11, 0, 1, 1, 2015),
    ],
}
# ---------------------------------------------------------------------------


def date_components(df: DataFrame, columns: list[str], missing: int = -1) -> DataFrame:
    """``<col>_Year/_Month/_Day/_DayOfWeek`` (Monday = 0), null -> ``missing``."""
    exprs = {}
    for c in columns:
        if c in df.columns:
            for k, e in dx.components(c, missing).items():
                exprs[f"{c}_{k}"] = e
    return df.withColumns(exprs)


def elapsed_days(df: DataFrame, start: str, ends: dict[str, str], missing: int = -1) -> DataFrame:
    """``{name: end_col}`` whole days from ``start``; null -> ``missing``."""
    return df.withColumns({n: F.coalesce(dx.elapsed_days(start, e), F.lit(missing).cast("bigint"))
                           for n, e in ends.items()})


def flag_weekend(df: DataFrame, column: str, out: str = "Weekend_Accident") -> DataFrame:
    """D5."""
    return df.withColumn(out, dx.weekend(column))


def known_flags(df: DataFrame, columns: list[str], prefix: str = "Known ") -> DataFrame:
    """D6."""
    return df.withColumns({f"{prefix}{c}": dx.known(c) for c in columns})


def _rule_rows(state: str):
    rows = []
    for scope in ("US", state):
        for name, kind, m, a, b, after, first in HOLIDAY_RULES.get(scope, []):
            rows.append((name, kind, m, a, b, after, first))
    return rows


def holiday_dimension(spark: SparkSession, first_year: int, last_year: int,
                      state: str = "NY") -> DataFrame:
    """D4 dimension: (holiday_date, holiday) for every year in [first_year, last_year].

    Fixed-date holidays falling on Saturday are also observed the Friday
    before, on Sunday the Monday after; so 31 December may belong to the next
    year's first holiday, and a year more is generated on each side and clipped.
    """
    rules = _rule_rows(state)
    rule_arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.lit(m).alias("m"),
                                  F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(af).alias("after"),
                                  F.lit(fy).alias("first"))
                         for n, k, m, a, b, af, fy in rules])
    years = spark.range(first_year - 1, last_year + 2).select(F.col("id").cast("int").alias("y"))
    r = years.select("y", F.explode(rule_arr).alias("r")).where(F.col("y") >= F.col("r.first"))
    first_of = F.make_date("y", "r.m", F.lit(1))
    # n-th weekday: first day of month + offset to the weekday + 7*(n-1)
    nth = F.date_add(first_of, ((F.col("r.a") - F.weekday(first_of) + 7) % 7 + 7 * (F.col("r.b") - 1)).cast("int"))
    last_dom = F.last_day(first_of)
    last = F.date_sub(last_dom, ((F.weekday(last_dom) - F.col("r.a") + 7) % 7).cast("int"))
    fixed = F.make_date("y", "r.m", "r.a")
    kind = F.col("r.kind")
    d = (F.when(kind == "fixed", fixed)
          .when(kind == "nth", nth)
          .when(kind == "last", last)
          .when(kind == "after_nth", F.date_add(nth, F.col("r.after").cast("int"))))
    base = r.select(d.alias("holiday_date"), F.col("r.name").alias("holiday"), kind.alias("kind"))
    wd = F.weekday("holiday_date")
    observed = (base.where((F.col("kind") == "fixed") & (wd >= 5))
                    .select(F.when(wd == 5, F.date_sub("holiday_date", 1))
                             .otherwise(F.date_add("holiday_date", 1)).alias("holiday_date"),
                            F.concat(F.col("holiday"), F.lit(" (observed)")).alias("holiday")))
    return base.drop("kind").unionByName(observed).where(F.year("holiday_date").between(first_year, last_year))


def year_bounds(df: DataFrame, column: str) -> tuple[int | None, int | None]:
    r = df.agg(F.min(F.year(col(column))).alias("a"), F.max(F.year(col(column))).alias("b")).first()
    return r["a"], r["b"]


def flag_holiday(df: DataFrame, column: str, dimension: DataFrame | None = None,
                 state: str = "NY", out: str = "Holiday_Accident") -> DataFrame:
    """1 when the date (compared as a calendar day) is a public holiday.

    Without a dimension the calendar covers min..max year of the data.  The
    dimension is bounded (~15 rows per year) and broadcast; the big side is
    never shuffled.
    """
    if dimension is None:
        y0, y1 = year_bounds(df, column)
        if y0 is None:
            return df.withColumn(out, F.lit(0))
        dimension = holiday_dimension(df.sparkSession, y0, y1, state)
    days = dimension.select(F.col("holiday_date").alias("__hd")).distinct().withColumn("__hit", F.lit(1))
    j = df.join(F.broadcast(days), F.to_date(col(column)) == F.col("__hd"), "left")
    return j.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__hd", "__hit")


def year_month_matrix(df: DataFrame, column: str) -> DataFrame:
    """rows = year, columns "1".."12" = row counts, missing cells 0."""
    d = df.where(col(column).isNotNull()).select(F.year(col(column)).alias("year"),
                                                 F.month(col(column)).alias("month"))
    return d.groupBy("year").pivot("month", list(range(1, 13))).count().na.fill(0)


def date_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min, max, non-null count) for date columns, in one aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(col(c)).alias(f"mn{i}"), F.max(col(c)).alias(f"mx{i}"), F.count(col(c)).alias(f"n{i}")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"mn{i}").alias("min_date"),
                 F.col(f"mx{i}").alias("max_date"), F.col(f"n{i}").alias("non_null"))
        for i, c in enumerate(columns)])).alias("s")).select("s.*")
