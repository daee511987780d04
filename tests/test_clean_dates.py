"""Cleaning, coercion, imputation and date rules on tiny hand-made frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabsmith.functions import dates as dx
from tabsmith.functions import scalars as sx
from tabsmith.operators import clean, columns, dates, impute
from tabsmith.sources.io import nan_to_null


def test_nan_becomes_null_and_all_null_rows_cols(spark):
    df = spark.createDataFrame([(1.0, None, None), (float("nan"), None, None), (None, None, None)],
                               "a double, b string, c double")
    d = nan_to_null(df)
    assert d.where(F.col("a").isNull()).count() == 2
    out = columns.drop_all_null_columns(clean.drop_all_null_rows(d))
    assert out.columns == ["a"] and out.count() == 1


def test_duplicates_keep_none_and_summary(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "z"), (None, None), (None, None)],
                               "k int, v string")
    assert clean.drop_all_copies(df).count() == 2          # (2,y), (2,z)
    assert clean.drop_all_copies(df, ["k"]).count() == 0   # every key repeats (null equals null)
    s = clean.duplicate_summary(df).first()
    assert (s["rows"], s["distinct_keys"], s["duplicated_rows"]) == (6, 4, 2)
    assert clean.duplicate_rows(df, ["k"]).count() == 6
    assert clean.drop_duplicates(df).count() == 4


def test_outlier_rules_null_handling(spark):
    df = spark.createDataFrame([(None, None, None, None), (None, None, None, 1.0), (91, 10.0, 1950, 1.0),
                                (90, 10.0, 1939, 39.0)],
                               "age_at_injury int, average_weekly_wage double, birth_year int, ime_4_count double")
    kept = clean.remove_outliers(df)
    assert kept.count() == 2  # null IME-4 fails; age 91 fails
    rep = clean.reduction_report(df, clean.outlier_condition()).first()
    assert rep["reduction_pct"] == 50.0


def test_limit_range_and_counts(spark):
    df = spark.createDataFrame([(0,), (13,), (14,), (90,), (91,), (None,)], "a int")
    out = [r[0] for r in clean.limit_range(df, "a", 14, 90).collect()]
    assert out == [None, None, 14, 90, None, None]
    c = clean.range_counts(df, "a", 14, 90).first()
    assert (c["n_zero"], c["n_below"], c["n_above"]) == (1, 2, 1)


def test_coercion(spark):
    df = spark.createDataFrame([("2024-02-29", "12", 3.0), ("not a date", "x", None)], "d string, n string, f double")
    out = clean.to_bigint(clean.to_number_lenient(clean.to_timestamp_lenient(df, ["d"]), ["n"]), ["f"]).collect()
    assert out[0]["d"] == dt.datetime(2024, 2, 29) and out[1]["d"] is None
    assert out[0]["n"] == 12.0 and out[1]["n"] is None
    assert out[0]["f"] == 3 and out[1]["f"] is None
    txt = clean.to_text(spark.createDataFrame([(None,), (5,)], "c int"), ["c"], null_text="nan").collect()
    assert [r[0] for r in txt] == ["nan", "5"]
    with pytest.raises(Exception):
        clean.to_bigint(spark.createDataFrame([(2.5,)], "f double"), ["f"]).collect()


def test_preprocess_word_matching(spark):
    df = spark.createDataFrame([("2020-01-01", "5", "Albany", None)],
                               "`Accident Date` string, `Age at Injury` string, `County of Injury` string, e string")
    out = clean.preprocess(df)
    assert out.columns == ["Accident Date", "Age at Injury", "County of Injury"]
    r = out.first()
    assert r[0] == dt.datetime(2020, 1, 1) and r[1] == 5.0 and r[2] == "Albany"


def test_medians_and_fills(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (3.0, 30.0), (None, 40.0)], "a double, b double")
    meds = impute.fit_medians(df, ["a", "b"])
    assert meds == {"a": 2.0, "b": 30.0}
    out = impute.fill_from(df, meds).collect()
    assert out[3]["a"] == 2.0 and out[1]["b"] == 30.0


def test_season_boundaries_and_weekday(spark):
    days = ["2023-12-20", "2023-12-21", "2023-03-19", "2023-03-20", "2023-06-21", "2023-09-22", "2023-09-23", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = [r[0] for r in df.select(sx.season("d")).collect()]
    assert got == ["Fall", "Winter", "Winter", "Spring", "Summer", "Summer", "Fall", "Fall"]
    wd = spark.createDataFrame([("2024-06-02",), ("2024-06-03",), (None,)], "d string") \
              .select(F.to_date("d").alias("d"))
    comps = wd.select(*[e.alias(k) for k, e in dx.components("d").items()]).collect()
    assert [r["DayOfWeek"] for r in comps] == [6, 0, -1]
    assert [r[0] for r in wd.select(dx.weekend("d")).collect()] == [1, 0, 0]


def test_elapsed_days_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 1)),
                                (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(dx.elapsed_days("a", "b")).collect()] == [-2, 2]


def test_holiday_calendar_2023(spark):
    cal = {r["holiday_date"] for r in dates.holiday_dimension(spark, 2023, 2023).collect()}
    for d in ["2023-01-02", "2023-01-16", "2023-02-13", "2023-02-15", "2023-02-20", "2023-05-29", "2023-06-19",
              "2023-07-04", "2023-09-04", "2023-10-09", "2023-11-07", "2023-11-10", "2023-11-23", "2023-12-25"]:
        assert dt.date.fromisoformat(d) in cal, d
    df = spark.createDataFrame([(dt.datetime(2023, 7, 4, 15),), (dt.datetime(2023, 7, 5),), (None,)],
                               "d timestamp_ntz")
    assert [r[0] for r in dates.flag_holiday(df, "d").select("Holiday_Accident").collect()] == [1, 0, 0]


def test_scalar_rules(spark):
    df = spark.createDataFrame([(50000.0, 1), (50000.01, 1), (1000.0, 1), (999.0, 1), (1000.0, 0), (None, 2),
                                (5000.0, None)], "w double, d int")
    got = [r[0] for r in df.select(sx.impact_category(sx.per_dependent("w", "d"))).collect()]
    assert got == [1, 0, 1, 2, 1, 2, 2]
    ages = spark.createDataFrame([(a,) for a in [-1, 0, 24, 25, 39, 40, 55, 69, 70, 99, 100, None]], "a int")
    assert [r[0] for r in ages.select(sx.bin_code("a")).collect()] == [-1, 0, 0, 1, 1, 2, 3, 3, 4, 4, -1, -1]
    caps = spark.createDataFrame([("NEW YORK",)], "c string").select(sx.capitalize("c")).first()[0]
    assert caps == "New york"
    assert spark.createDataFrame([(None,)], "c string").select(sx.risk_level("c")).first()[0] == 1
