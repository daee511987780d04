"""Cases that once gave wrong results, crashed or lost data."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.functions.stats import _gammaincc
from tabsmith.operators import clean, dates, encode, impute, models, profile, quality, select, tables
from tabsmith.operators.ranking import cumulative, exact_quantiles, rank_distinct


def test_more_labels_than_any_cap(spark):
    df = spark.range(25_000).select(F.format_string("v%05d", "id").alias("y"), "id")
    m = {r["value"]: r["label"] for r in encode.fit_labels(df, "y", ranges=7).collect()}
    assert m == {f"v{i:05d}": i for i in range(25_000)}
    codes = encode.category_codes(df, "y", out="c").where("c <> id").count()
    assert codes == 0
    cats = encode.one_hot_categories(df, ["y"])
    assert cats.count() == 25_000
    assert encode.one_hot_long(df, "id", cats).where("position = id").count() == 24_999


def test_rank_distinct_puts_null_last(spark):
    df = spark.createDataFrame([(x,) for x in ["b", None, "a", "b", "c", None]], "v string")
    for n in (1, 3):
        assert {r["v"]: r["rank"] for r in rank_distinct(df, "v", ranges=n).collect()} == {"a": 0, "b": 1, "c": 2, None: 3}
    assert rank_distinct(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("dof", [3, 50, 9_999, 19_999, 20_001, 1e6, 1e8, 1e10])
def test_chi_square_tail_against_the_normal_limit(dof):
    # Wilson-Hilferty is good to about 1e-4 from 50 degrees on and better with more
    for z in (-3.0, -1.0, 0.0, 1.0, 3.0):
        x = dof * (1 - 2 / (9 * dof) + z * math.sqrt(2 / (9 * dof))) ** 3
        assert abs(_gammaincc(dof / 2, x / 2) - 0.5 * math.erfc(z / math.sqrt(2))) < (2e-2 if dof < 50 else 1e-3)
    assert _gammaincc(dof / 2, 0) == 1.0 and _gammaincc(dof / 2, dof * 10.0) < 0.01


def test_large_shape_expansion_joins_the_series():
    from tabsmith.functions import stats
    for x in (9_600.0, 9_990.0, 10_000.0, 10_000.3, 10_050.0, 10_400.0):
        a = stats.LARGE_SHAPE
        series = stats._gammaincc(np.nextafter(a, 0), x)
        assert series == pytest.approx(stats._gammaincc(a, x), rel=1e-8, abs=1e-12)


def test_integer_column_takes_a_fractional_median(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "v int")
    out = impute.fill_from(df, impute.fit_medians(df, ["v"]))
    assert dict(out.dtypes)["v"] == "double" and sorted(r.v for r in out.collect()) == [1, 2, 2.5, 3, 4]
    assert dict(impute.fill_from(df, {"v": 0}).dtypes)["v"] == "int"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (4.0,)], "v double")
    r = profile.describe_numeric(df, ["v"]).first()
    assert (r["count"], round(r["mean"], 4), r["max"]) == (3, 2.6667, 4.0)


def test_constants_and_empties_do_not_crash(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 1.0), (4.0, 5.0, None)], "a double, b double, c double")
    corr = {(r.feature_a, r.feature_b): r["corr"] for r in profile.correlation(df, ["a", "b", "c"], lower_only=True).collect()}
    assert corr[("a", "b")] is None and corr[("b", "c")] is None and corr[("a", "c")] == pytest.approx(-1)
    assert all(r.density is None for r in profile.density_curve(df, "b", grid_size=3).collect())
    none = df.limit(0)
    assert profile.describe_numeric(none, ["a"]).count() == 0 and profile.box_stats(none, ["a"]).count() == 0
    assert exact_quantiles(none, [], "a", [0.5], ["m"]).first()["m"] is None
    assert impute.fit_medians(df.select(F.lit(None).cast("double").alias("x")), ["x"]) == {"x": None}
    assert clean.reduction_report(none, F.lit(True)).first()["reduction_pct"] == 0.0
    assert cumulative(none, ["b"], "a", {"n": F.count(F.lit(1))}).count() == 0


@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_quantiles_of_a_hot_group(spark, ranges):
    rng = np.random.default_rng(0)
    values = {"hot": rng.normal(size=3000).round(2), "small": rng.normal(size=7), "one": np.array([3.5])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, buckets=ranges).collect()}
    for g, vs in values.items():
        assert [got[g][f"q{int(round(p * 100))}"] for p in probs] == pytest.approx(np.quantile(vs, probs).tolist())


def test_new_year_observed_in_the_year_before(spark):
    got = {r.holiday_date for r in dates.holiday_dimension(spark, 2020, 2021).collect()}
    assert datetime.date(2021, 12, 31) in got and all(d.year in (2020, 2021) for d in got)


def test_unreadable_version_is_not_overwritten(spark, tmp_path):
    bad = tmp_path / "group" / "version=1"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_text("not parquet")
    assert not tables.table_exists(spark, str(tmp_path / "nowhere"))
    df = spark.createDataFrame([(1, 2.0)], "k long, a double")
    with pytest.raises(Exception):  # noqa: B017 - any read error will do
        tables.create_feature_group(df, "k", {"name": "group", "columns": ["a"]}, str(tmp_path), 1)
    assert (bad / "part-0.parquet").read_text() == "not parquet"


def test_streams_need_a_checkpoint(spark):
    from tabsmith.streaming.monitor import validate_stream
    with pytest.raises(ValueError):
        validate_stream(spark.readStream.format("rate").load(), [], "/nowhere", checkpoint="")


def test_checkpoint_folder_is_required_off_local():
    from tabsmith import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_warn_logs(spark, caplog):
    df = spark.createDataFrame([(None,)], "a int")
    with caplog.at_level("WARNING"):
        quality.run_suite(df, [{"type": "expect_column_values_to_not_be_null", "column": "a"}], on_fail="warn")
    assert "expect_column_values_to_not_be_null" in caplog.text


def test_fixed_lists():
    assert len(select.FEATURE_SUBSETS["essential"]) == 8 and len(select.FEATURE_SUBSETS["reduced"]) == 21
    assert len(quality.PROCESSED_CLAIM_COLUMNS) == 66 and len(quality.RAW_CLAIM_COLUMNS) == 33


def test_metrics_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(i % 3, (i * i) % 3) for i in range(30)], "true_label int, predicted_label int").write.parquet(path)
    for report in (models.classification_report, models.macro_metrics):
        plan = report(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1


def test_sample_keeps_the_share_of_every_class(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {r.y: r["count"] for r in profile.stratified_sample(df, "id", 0.25, class_col="y").groupBy("y").count().collect()}
    assert got == {0: 225, 1: 25}


def test_split_counts_of_a_boosted_model(spark):
    df = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("flat"),
                                 (F.col("id") % 7 > 3).cast("double").alias("y"))
    m = models.train_boosted(df, ["a", "flat"], "y", {"n_estimators": 3, "max_depth": 2})
    got = {r.feature: (r.splits, r.keep) for r in select.split_counts(m, ["a", "flat"], keep=2).collect()}
    assert got["a"][0] >= 2 and got["a"][1] and got["flat"] == (0, False)


def test_entry_lists_every_oracle():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
