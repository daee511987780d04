"""Catalogue: statements that must hold whatever a model or a hash gives, and operators on odd input.

The oracles are written from the statement, not from the library's own tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions import scalars as sx
from tabsmith.operators import columns, dates, encode, impute, models, profile, quality, select
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.model_input import KEY, model_frame
from tabsmith.plans.registry import query, rounded
from tabsmith.session import scratch_dir
from tabsmith.sources import io

# -- models ------------------------------------------------------------------------------


def _forest(spark, sf):
    d, feats, label, k = model_frame(spark, sf)
    m = models.train_forest(d.where(F.col("split") == "train"), feats, label, {"n_estimators": 20, "max_depth": 5})
    return m, d.where(F.col("split") == "test"), feats, label, k


@query("model_reload_same", "SELECT true AS same_predictions, true AS probabilities_sum_to_one, true AS confidence_is_top")
def model_reload_same(spark, sf):
    m, test, _, label, k = _forest(spark, sf)
    probs = [F.col(f"prob_class_{i}") for i in range(k)]
    a = models.predictions(m, test, label, k, key=KEY)
    again = io.load_model(io.save_model(m, scratch_dir(spark, "model")))
    b = models.predictions(again, test, label, k, key=KEY).select(F.col(KEY).alias("__k"), F.col("predicted_label").alias("__p"))
    total = sum(probs[1:], probs[0])
    return a.join(b, a[KEY] == F.col("__k")).agg(
        F.bool_and(F.col("predicted_label") == F.col("__p")).alias("same_predictions"),
        F.bool_and(F.abs(total - 1) < 1e-9).alias("probabilities_sum_to_one"),
        F.bool_and(F.abs(F.col("prediction_confidence") - F.greatest(*probs)) < 1e-12).alias("confidence_is_top"))


@query("importances_sum_to_one", "SELECT 14 AS n_features, true AS sums_to_one, true AS none_negative")
def importances_sum_to_one(spark, sf):
    m, _, feats, _, _ = _forest(spark, sf)
    return models.importances(m, feats).agg(
        F.count("*").cast("int").alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and(F.col("importance") >= 0).alias("none_negative"))


@query("constant_feature_importance", "SELECT 'always_one' AS feature, 0.0::DOUBLE AS importance_mean, 0.0::DOUBLE AS importance_std")
def constant_feature_importance(spark, sf):
    d, feats, label, _ = model_frame(spark, sf)
    d = d.withColumn("always_one", F.lit(1.0))
    used = [*feats[:3], "always_one"]
    m = models.train_forest(d.where(F.col("split") == "train"), used, label, {"n_estimators": 10, "max_depth": 5})
    return models.permutation_importance(m, d.where(F.col("split") == "val"), ["always_one"], label, KEY)


@query("report_counts", with_claims("""
SELECT 'weighted avg' AS label, CAST(count(*) AS BIGINT) AS support, true AS accuracy_is_weighted_recall FROM (
  SELECT claim_identifier FROM claims WHERE claim_injury_type IS NOT NULL)
"""))
def report_counts(spark, sf):
    d, feats, label, k = model_frame(spark, sf)
    m = models.train_forest(d.where(F.col("split") == "train"), feats, label, {"n_estimators": 10, "max_depth": 4})
    macro, report = models.evaluate(m, d, label, k)
    acc = macro.select("accuracy").first()[0]
    return report.where("label = 'weighted avg'").select(
        "label", "support", (F.abs(F.col("recall") - F.lit(acc)) < 1e-9).alias("accuracy_is_weighted_recall"))


# small models in what follows: the statements hold at any size, on all rows
SMALL_FOREST = {"n_estimators": 8, "max_depth": 4}
SMALL_BOOSTED = {"n_estimators": 4, "max_depth": 3}


@query("two_families", "SELECT 2 AS n_models, true AS best_is_highest, true AS scores_in_range, true AS boosting_loss_falls")
def two_families(spark, sf):
    """Both families are trained; the best one has the highest macro F1 on the validation rows."""
    d, feats, label, k = model_frame(spark, sf)
    fitted, metrics, best = models.train_and_evaluate(d, feats, label, k, boosted=SMALL_BOOSTED, forest=SMALL_FOREST)
    losses = fitted["boosted"].losses
    falls = all(b < a for a, b in zip(losses, losses[1:], strict=False))
    top = metrics.agg(F.count("*").cast("int").alias("n_models"), F.max("f1_macro").alias("top"),
                      F.bool_and((F.col("f1_macro") >= 0) & (F.col("f1_macro") <= 1) & (F.col("f1_train") > 0)).alias("scores_in_range"))
    return top.crossJoin(F.broadcast(best.select("f1_macro"))).select(   # one row each
        "n_models", (F.col("f1_macro") == F.col("top")).alias("best_is_highest"), "scores_in_range", F.lit(falls).alias("boosting_loss_falls"))


@query("selection_above_mean", "SELECT true AS kept_reach_the_mean, true AS others_do_not")
def selection_above_mean(spark, sf):
    """K6: forest importances at or above their mean are kept, and only those."""
    d, feats, label, _ = model_frame(spark, sf)
    imp = models.importances(models.train_forest(d.where(F.col("split") == "train"), feats, label, SMALL_FOREST), feats)
    kept = select.select_by_importance(imp, "mean").select("feature", F.lit(True).alias("kept"))
    mean = 1.0 / len(feats)   # importances sum to one
    j = imp.join(kept, "feature", "left")
    return j.agg(F.bool_and(F.col("kept").isNull() | (F.col("importance") >= mean - 1e-12)).alias("kept_reach_the_mean"),
                 F.bool_and(F.col("kept").isNotNull() | (F.col("importance") < mean)).alias("others_do_not"))


@query("rfe_path", "SELECT 4 AS sizes, true AS nested, 'always_one' AS first_dropped, true AS one_best")
def rfe_path(spark, sf):
    """Every size once, each subset inside the one before, a constant goes first."""
    d, feats, label, _ = model_frame(spark, sf)
    train = d.where(F.col("split") == "train").withColumn("always_one", F.lit(1.0))
    got = select.recursive_elimination(train, ["number_of_dependents", "Weekend_Accident", "Age_Group", "always_one"], label)
    a = F.array_sort(F.collect_list(F.struct((-F.col("n_features")).alias("o"), "features", "best")))
    one = got.agg(a.alias("a"))
    gone = F.array_except(F.col("a")[0]["features"], F.col("a")[1]["features"])
    nested = F.forall(F.sequence(F.lit(1), F.size("a") - 1), lambda i: (
        (F.size(F.array_except(F.col("a")[i]["features"], F.col("a")[i - 1]["features"])) == 0)
        & (F.size(F.col("a")[i]["features"]) == F.size(F.col("a")[i - 1]["features"]) - 1)))
    return one.select(F.size("a").alias("sizes"), nested.alias("nested"), gone[0].alias("first_dropped"),
                      (F.size(F.filter("a", lambda x: x["best"])) == 1).alias("one_best"))


RULE = ["number_of_dependents", "average_weekly_wage", "ime_4_count"]


def _ruled(spark, sf):
    """Claims whose label is a rule on the dependents."""
    return claims(spark, sf).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in RULE],
                                    (F.col("number_of_dependents") > 3).cast("double").alias("y"))


RULE_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, {1.0 if c == RULE[0] else 0.0}::DOUBLE AS importance" for c in RULE)


@query("tree_of_a_rule", RULE_SQL)
def tree_of_a_rule(spark, sf):
    """The tree of a label that is a rule on one feature uses that feature alone."""
    return rounded(select.tree_importance(_ruled(spark, sf), RULE, "y"))


@query("boosting_of_a_rule", RULE_SQL)
def boosting_of_a_rule(spark, sf):
    """So does class-weighted boosting, leaf by leaf."""
    return rounded(select.boosted_importance(_ruled(spark, sf), RULE, "y", {"rounds": 5}).select("feature", "importance"))


TEST_ROWS = "SELECT CAST(sum(n_test) AS BIGINT) AS n FROM (SELECT round(0.1 * count(*)) AS n_test FROM claims GROUP BY claim_injury_type)"


@query("fold_votes", with_claims(f"SELECT n AS rows, true AS probabilities_sum_to_folds, true AS label_is_the_top FROM ({TEST_ROWS})"))
def fold_votes(spark, sf):
    """Every fold's model adds probabilities that sum to one; the label is the class of the largest total."""
    d, feats, label, k = model_frame(spark, sf)
    got = models.fold_ensemble(d.where(F.col("split") == "train"), d.where(F.col("split") == "test"), feats, label, KEY, k, n_folds=3,
                               trainer=lambda x: models.train_forest(x, feats, label, SMALL_FOREST))
    probs = [F.col(f"prob_class_{i}") for i in range(k)]
    return got.agg(F.count("*").alias("rows"), F.bool_and(F.abs(sum(probs[1:], probs[0]) - 3) < 1e-9).alias("probabilities_sum_to_folds"),
                   F.bool_and(F.element_at(F.array(*probs), F.col("predicted_label") + 1) == F.greatest(*probs)).alias("label_is_the_top"))


@query("predictions_roundtrip", with_claims(f"SELECT n AS rows, n AS same_rows FROM ({TEST_ROWS})"))
def predictions_roundtrip(spark, sf):
    """Predictions written and read back."""
    m, test, _, label, k = _forest(spark, sf)
    pred = models.predictions(m, test, label, k, key=KEY)
    again = io.read_table(spark, io.write_table(pred, scratch_dir(spark, "predictions")))
    same = pred.select(F.struct(*pred.columns).alias("r")).intersectAll(again.select(F.struct(*pred.columns).alias("r"))).agg(F.count("*").alias("same_rows"))
    return again.agg(F.count("*").alias("rows")).crossJoin(F.broadcast(same))   # one row each


@query("top_permutation_order", "SELECT 5 AS rows, true AS in_order, true AS none_above_left_out")
def top_permutation_order(spark, sf):
    """V5: the largest mean drops of accuracy, in order."""
    from tabsmith.operators import reports
    d, feats, label, _ = model_frame(spark, sf)
    m = models.train_forest(d.where(F.col("split") == "train"), feats, label, SMALL_FOREST)
    pi = models.permutation_importance(m, d.where(F.col("split") == "val"), feats, label, KEY, 2, 42).cache()
    rows = [r["importance_mean"] for r in reports.top_permutation(pi, 5).collect()]
    top = sorted((r["importance_mean"] for r in pi.collect()), reverse=True)[:5]
    return spark.range(1).select(F.lit(len(rows)).alias("rows"), F.lit(rows == sorted(rows, reverse=True)).alias("in_order"),
                                 F.lit(rows == top).alias("none_above_left_out"))


@query("fold_medians", with_claims("""
SELECT fold, round(median(average_weekly_wage), 6) AS median_wage FROM (
  SELECT f.fold, c.average_weekly_wage FROM claims c, (SELECT unnest(range(5)) AS fold) f
  WHERE c.claim_identifier % 5 <> f.fold AND c.average_weekly_wage > 0) GROUP BY fold
"""))
def fold_medians(spark, sf):
    """Each fold's medians come from the other folds alone, after its outlier rule."""
    c = claims(spark, sf).select("claim_identifier", "average_weekly_wage")
    out = None
    for k in range(5):
        part, = models.fold_preprocessing(c.where(F.col("claim_identifier") % 5 != k), [], outliers=F.col("average_weekly_wage") > 0)
        got = impute.medians_frame(part, ["average_weekly_wage"]).select(F.lit(k).cast("bigint").alias("fold"), F.col("median").alias("median_wage"))
        out = got if out is None else out.unionByName(got)
    return rounded(out)


@query("lasso_drops_noise", "SELECT 'constant' AS feature, false AS selected")
def lasso_drops_noise(spark, sf):
    c = claims(spark, sf).select((F.col("number_of_dependents") * 2.0).alias("label"), F.col("number_of_dependents").cast("double"),
                                 F.lit(3.0).alias("constant"))
    got = select.lasso_coefficients(c, ["number_of_dependents", "constant"], "label", n_folds=3, n_alphas=5)
    return got.where("feature = 'constant'").select("feature", "selected")


# -- hashes, sketches, times ----------------------------------------------------------------

@query("hash_encode_stable", with_claims("""
SELECT county_of_injury, count(*) AS n, true AS one_bucket, true AS in_range FROM claims GROUP BY 1
"""))
def hash_encode_stable(spark, sf):
    d = encode.hash_buckets(claims(spark, sf), "county_of_injury", 16)
    return d.groupBy("county_of_injury").agg(
        F.count("*").alias("n"), (F.count_distinct("county_of_injury_hash") == 1).alias("one_bucket"),
        F.bool_and(F.col("county_of_injury_hash").between(0, 15)).alias("in_range"))


@query("approx_distinct_error", "SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey']) AS feature, true AS within_15_percent")
def approx_distinct_error(spark, sf):
    li, cols = load(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"]
    a, e = profile.distinct_counts(li, cols, approx=True), profile.distinct_counts(li, cols)
    name, value = a.columns
    e = e.select(F.col(name).alias("__f"), F.col(value).alias("__v"))
    return a.join(e, F.col(name) == F.col("__f")).select(
        F.col(name).alias("feature"), (F.abs(F.col(value) - F.col("__v")) <= 0.15 * F.col("__v")).alias("within_15_percent"))


@query("event_time_present", with_claims("SELECT count(*) AS n, count(*) AS with_time, true AS key_kept FROM claims"))
def event_time_present(spark, sf):
    c = claims(spark, sf)
    d = columns.add_event_time(c, "claim_identifier")
    time = next(n for n in d.columns if n not in c.columns)
    return d.agg(F.count("*").alias("n"), F.count(F.col(f"`{time}`")).alias("with_time"),
                 (F.count_distinct("claim_identifier") == F.count("*")).alias("key_kept"))


# -- odd input -------------------------------------------------------------------------------

@query("impute_integer_median", with_claims("""
SELECT claim_identifier, coalesce(CAST(CASE WHEN claim_identifier % 3 = 0 THEN NULL ELSE number_of_dependents END AS DOUBLE), m) AS v
FROM claims, (SELECT median(CASE WHEN claim_identifier % 3 = 0 THEN NULL ELSE number_of_dependents END) + 0.5 AS m FROM claims)
"""))
def impute_integer_median(spark, sf):
    """A fraction makes the integer column a double one."""
    c = claims(spark, sf).select("claim_identifier", F.when(F.col("claim_identifier") % 3 != 0, F.col("number_of_dependents")).alias("v"))
    return impute.fill_from(c, {"v": impute.fit_medians(c, ["v"])["v"] + 0.5})


@query("corr_with_constant", with_claims("""
SELECT 'average_weekly_wage' AS feature_a, 'number_of_dependents' AS feature_b,
       round(corr(average_weekly_wage, number_of_dependents), 6) AS corr FROM claims
UNION ALL SELECT 'average_weekly_wage', 'flat', NULL UNION ALL SELECT 'number_of_dependents', 'flat', NULL
"""))
def corr_with_constant(spark, sf):
    c = claims(spark, sf).withColumn("flat", F.lit(7.0))
    return rounded(profile.correlation(c, ["average_weekly_wage", "number_of_dependents", "flat"], lower_only=True))


@query("describe_with_nan", with_claims("""
SELECT 'v' AS feature, count(v) AS count, round(avg(v), 6) AS mean, round(max(v), 6) AS max FROM (
  SELECT CASE WHEN claim_identifier % 4 = 0 THEN NULL ELSE average_weekly_wage END AS v FROM claims)
"""))
def describe_with_nan(spark, sf):
    c = claims(spark, sf).select(F.when(F.col("claim_identifier") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("average_weekly_wage")).alias("v"))
    return rounded(profile.describe_numeric(c, ["v"]).select("feature", "count", "mean", "max"))


@query("empty_statistics", with_claims("SELECT 'd' AS t, CAST(0 AS BIGINT) AS n, count(*) AS read FROM claims UNION ALL SELECT 'm', 0, count(*) FROM claims"))
def empty_statistics(spark, sf):
    """A column without a value, over all claims: no statistics and no median."""
    c = claims(spark, sf).select("claim_identifier", F.lit(None).cast("double").alias("hollow"))
    read = c.agg(F.count("*").alias("read"))
    d = profile.describe_numeric(c, ["hollow"]).where("count > 0").agg(F.lit("d").alias("t"), F.count("*").alias("n"))
    m = impute.medians_frame(c, ["hollow"]).agg(F.lit("m").alias("t"), F.count("*").alias("n"))
    return d.unionByName(m).crossJoin(F.broadcast(read))   # one row


@query("new_year_observed", """
WITH y AS (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders)
SELECT CAST(d AS DATE) AS holiday_date FROM (
  SELECT unnest(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), INTERVAL 1 DAY)) AS d FROM y)
WHERE (month(d) = 12 AND day(d) = 31 AND isodow(d) = 5) OR (month(d) = 1 AND day(d) = 1)
   OR (month(d) = 1 AND day(d) = 2 AND isodow(d) = 1)
""")
def new_year_observed(spark, sf):
    """New Year's Day and the weekday on which it is observed, also across the year's end, for the years of the orders."""
    first, last = load(spark, sf, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return dates.holiday_dimension(spark, first, last).where("holiday LIKE 'New Year%'").select("holiday_date").distinct()


@query("risk_level_by_industry", with_claims("""
SELECT claim_identifier, CASE claim_identifier % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 2 END AS Risk_Level
FROM claims
"""))
def risk_level_by_industry(spark, sf):
    """M4 on the fixed levels: mining, utilities high; finance low; retail and a missing description medium."""
    names = ["MINING", "FINANCE AND INSURANCE", "RETAIL TRADE", None, "UTILITIES"]
    name = F.lit(None).cast("string")
    for i, n in enumerate(names):
        name = F.when(F.col("claim_identifier") % 5 == i, F.lit(n)).otherwise(name)
    c = claims(spark, sf).withColumn("description", name)
    return c.select("claim_identifier", sx.risk_level("description").alias("Risk_Level"))


@query("suite_fallback", with_claims("""
WITH rules AS (
  SELECT count(*) BETWEEN 100000 AND 593471 AS ok FROM claims
  UNION ALL SELECT false   -- the claims view does not have the model table's columns
  UNION ALL SELECT count(*) FILTER (WHERE claim_identifier % 7 = 0 OR claim_injury_type IS NULL) = 0 FROM claims
  UNION ALL SELECT count(*) FILTER (WHERE age_at_injury < 16 OR age_at_injury > 100) = 0 FROM claims)
SELECT 'missing_suite' AS suite, CAST(0 AS BIGINT) AS rules, CAST(0 AS BIGINT) AS failed, true AS success
UNION ALL SELECT 'processed_data_suite', count(*), count(*) FILTER (NOT ok), bool_and(ok) FROM rules
"""))
def suite_fallback(spark, sf):
    """Q9: a missing suite is empty and passes; all claims against the model table's suite."""
    c = claims(spark, sf)
    c = c.withColumnsRenamed({"claim_injury_type": "Claim Injury Type", "age_at_injury": "Age at Injury"})
    c = c.withColumn("Claim Injury Type", F.when(F.col("claim_identifier") % 7 != 0, F.col("Claim Injury Type")))
    out = None
    for name in ("missing_suite", "processed_data_suite"):
        rules = quality.get_suite(name)
        got = (quality.suite_summary(quality.run_suite(c, rules, on_fail="none")[1]) if rules
               else spark.range(1).select(F.lit(0).cast("bigint").alias("rules"), F.lit(0).cast("bigint").alias("failed"), F.lit(True).alias("success")))
        got = got.select(F.lit(name).alias("suite"), "*")
        out = got if out is None else out.unionByName(got)
    return out


@query("schema_difference", """
SELECT 'c_custkey' AS "column", 'right' AS only_in, (SELECT count(c_custkey) FROM customer) AS non_null
UNION ALL SELECT 'o_custkey', 'left', (SELECT count(o_custkey) FROM orders)
""")
def schema_difference(spark, sf):
    """The columns that only one of two tables has, with their numbers of values."""
    left = load(spark, sf, "orders").select("o_custkey")
    right = load(spark, sf, "customer").select("c_custkey")
    counts = left.agg(F.count("o_custkey").alias("non_null")).select(F.lit("o_custkey").alias("c"), "non_null").unionByName(
        right.agg(F.count("c_custkey").alias("non_null")).select(F.lit("c_custkey").alias("c"), "non_null"))
    diff = columns.schema_difference(spark, left, right)
    return diff.join(counts, diff["column"] == counts["c"]).select("column", "only_in", "non_null")


@query("profile_shape", "SELECT 'missing' AS part, CAST(0 AS BIGINT) AS rows UNION ALL SELECT 'describe', 1 UNION ALL SELECT 'head', 10")
def profile_shape(spark, sf):
    """A10: the parts of the profile bundle; ``missing`` lists only columns with gaps."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    p = profile.profile(o, "o_orderkey", ["o_totalprice"], n_head=10)
    parts = [p[k].agg(F.lit(k).alias("part"), F.count("*").alias("rows")) for k in ("missing", "describe", "head")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("one_hot_long", with_claims("""
WITH v AS (SELECT 'gender' AS feature, gender AS value, claim_identifier FROM claims
           UNION ALL SELECT 'carrier_type', carrier_type, claim_identifier FROM claims),
r AS (SELECT feature, value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY value NULLS LAST) - 1 AS INTEGER) AS position,
      claim_identifier FROM v)
SELECT claim_identifier, feature, position FROM r WHERE position > 0
"""))
def one_hot_long(spark, sf):
    c = claims(spark, sf)
    cats = encode.one_hot_categories(c, ["gender", "carrier_type"])
    path = scratch_dir(spark, "one-hot")   # S5: the fitted categories are a table
    cats.write.parquet(path)
    return encode.one_hot_long(c, "claim_identifier", spark.read.parquet(path))
