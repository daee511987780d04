"""Catalogue: date operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions.scalars import season
from tabsmith.operators import dates
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.registry import query


def _parts_sql(c: str) -> str:
    return (f"coalesce(CAST(year({c}) AS INTEGER), -1) AS {c}_Year, "
            f"coalesce(CAST(month({c}) AS INTEGER), -1) AS {c}_Month, "
            f"coalesce(CAST(day({c}) AS INTEGER), -1) AS {c}_Day, "
            f"coalesce(CAST(isodow({c}) - 1 AS INTEGER), -1) AS {c}_DayOfWeek")


@query("date_components", with_claims(f"""
SELECT claim_identifier, {_parts_sql('accident_date')}, {_parts_sql('c_2_date')} FROM claims
"""))
def date_components(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "accident_date", "c_2_date")
    return dates.date_components(c, ["accident_date", "c_2_date"]).drop("accident_date", "c_2_date")


def _days_sql(a: str, b: str) -> str:
    return f"coalesce(CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000.0) AS BIGINT), -1)"


@query("elapsed_days", with_claims(f"""
SELECT claim_identifier, {_days_sql('accident_date', 'c_2_date')} AS Days_to_C2,
       {_days_sql('accident_date', 'c_3_date')} AS Days_to_C3,
       {_days_sql('c_3_date', 'assembly_date')} AS Days_to_Assembly
FROM claims
"""))
def elapsed_days(spark, sf):
    c = claims(spark, sf)
    out = dates.elapsed_days(c, "accident_date", {"Days_to_C2": "c_2_date", "Days_to_C3": "c_3_date"})
    out = dates.elapsed_days(out, "c_3_date", {"Days_to_Assembly": "assembly_date"})
    return out.select("claim_identifier", "Days_to_C2", "Days_to_C3", "Days_to_Assembly")


@query("season", with_claims("""
SELECT claim_identifier,
  CASE WHEN month(accident_date) * 100 + day(accident_date) >= 1221
         OR month(accident_date) * 100 + day(accident_date) < 320 THEN 'Winter'
       WHEN month(accident_date) * 100 + day(accident_date) >= 320
         AND month(accident_date) * 100 + day(accident_date) < 621 THEN 'Spring'
       WHEN month(accident_date) * 100 + day(accident_date) >= 621
         AND month(accident_date) * 100 + day(accident_date) < 923 THEN 'Summer'
       ELSE 'Fall' END AS accident_season
FROM claims
"""))
def season_q(spark, sf):
    c = claims(spark, sf)
    return c.select("claim_identifier", season("accident_date").alias("accident_season"))


@query("weekend_flag", with_claims("""
SELECT claim_identifier, coalesce(CAST(isodow(accident_date) >= 6 AS INTEGER), 0) AS Weekend_Accident FROM claims
"""))
def weekend_flag(spark, sf):
    return dates.flag_weekend(claims(spark, sf), "accident_date").select("claim_identifier", "Weekend_Accident")


@query("known_flags", with_claims("""
SELECT claim_identifier, CAST(c_2_date IS NOT NULL AS INTEGER) AS "Known c_2_date",
       CAST(c_3_date IS NOT NULL AS INTEGER) AS "Known c_3_date",
       CAST(age_at_injury IS NOT NULL AS INTEGER) AS "Known age_at_injury",
       CAST(birth_year IS NOT NULL AS INTEGER) AS "Known birth_year"
FROM claims
"""))
def known_flags(spark, sf):
    cols = ["c_2_date", "c_3_date", "age_at_injury", "birth_year"]
    c = claims(spark, sf).select("claim_identifier", *cols)
    return dates.known_flags(c, cols).drop(*cols)


def _holiday_days_sql(table: str, column: str) -> str:
    """Public holidays of the state of New York, each as its own rule on the days of the years of ``column``."""
    return f"""
b AS (SELECT min(year({column})) AS y0, max(year({column})) AS y1 FROM {table}),
days AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM b),
p AS (SELECT d, year(d) AS y, month(d) AS m, day(d) AS dd, isodow(d) AS wd, (day(d) - 1) // 7 + 1 AS nth FROM days),
named AS (
  SELECT d, y, 'New Year''s Day' AS name, true AS moves FROM p WHERE m = 1 AND dd = 1
  UNION ALL SELECT d, y, 'Lincoln''s Birthday', true FROM p WHERE m = 2 AND dd = 12
  UNION ALL SELECT d, y, 'Susan B. Anthony Day', true FROM p WHERE m = 2 AND dd = 15 AND y >= 2004
  UNION ALL SELECT d, y, 'Juneteenth National Independence Day', true FROM p WHERE m = 6 AND dd = 19 AND y >= 2021
  UNION ALL SELECT d, y, 'Independence Day', true FROM p WHERE m = 7 AND dd = 4
  UNION ALL SELECT d, y, 'Veterans Day', true FROM p WHERE m = 11 AND dd = 11
  UNION ALL SELECT d, y, 'Christmas Day', true FROM p WHERE m = 12 AND dd = 25
  UNION ALL SELECT d, y, 'Martin Luther King Jr. Day', false FROM p WHERE m = 1 AND wd = 1 AND nth = 3 AND y >= 1986
  UNION ALL SELECT d, y, 'Washington''s Birthday', false FROM p WHERE m = 2 AND wd = 1 AND nth = 3
  UNION ALL SELECT d, y, 'Memorial Day', false FROM p WHERE m = 5 AND wd = 1 AND dd > 24
  UNION ALL SELECT d, y, 'Labor Day', false FROM p WHERE m = 9 AND wd = 1 AND nth = 1
  UNION ALL SELECT d, y, 'Columbus Day', false FROM p WHERE m = 10 AND wd = 1 AND nth = 2
  UNION ALL SELECT d, y, 'Election Day', false FROM p WHERE m = 11 AND wd = 2 AND dd BETWEEN 2 AND 8 AND y >= 2015
  UNION ALL SELECT d, y, 'Thanksgiving', false FROM p WHERE m = 11 AND wd = 4 AND nth = 4),
obs AS (SELECT CASE isodow(d) WHEN 6 THEN d - 1 ELSE d + 1 END AS d, name || ' (observed)' AS name FROM named WHERE moves AND isodow(d) >= 6),
cal AS (SELECT d AS holiday_date, name AS holiday FROM named UNION ALL SELECT CAST(d AS DATE), name FROM obs)"""


@query("holiday_calendar", f"""
WITH {_holiday_days_sql('orders', 'o_orderdate')}
SELECT holiday_date, holiday FROM cal
""")
def holiday_calendar(spark, sf):
    o = load(spark, sf, "orders")
    y0, y1 = dates.year_bounds(o, "o_orderdate")
    return dates.holiday_dimension(spark, y0, y1, "NY")


@query("holiday_flag", f"""
WITH {_holiday_days_sql('orders', 'o_orderdate')}
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (SELECT holiday_date FROM cal) THEN 1 ELSE 0 END
       AS Holiday_Accident
FROM orders
""")
def holiday_flag(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dates.flag_holiday(o, "o_orderdate").select("o_orderkey", "Holiday_Accident")


@query("year_month_matrix", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  """ + ",\n  ".join(f'count(*) FILTER (WHERE month(o_orderdate) = {m}) AS "{m}"' for m in range(1, 13)) + """
FROM orders GROUP BY 1
""")
def year_month_matrix(spark, sf):
    return dates.year_month_matrix(load(spark, sf, "orders"), "o_orderdate")


@query("date_range", with_claims("""
SELECT 'accident_date' AS "column", min(accident_date) AS min_date, max(accident_date) AS max_date,
       count(accident_date) AS non_null FROM claims
UNION ALL SELECT 'c_2_date', min(c_2_date), max(c_2_date), count(c_2_date) FROM claims
UNION ALL SELECT 'c_3_date', min(c_3_date), max(c_3_date), count(c_3_date) FROM claims
"""))
def date_range(spark, sf):
    return dates.date_range(claims(spark, sf), ["accident_date", "c_2_date", "c_3_date"])
