"""Catalogue: metrics (K8-K13) on rule-based predictions, selection statistics (K5-K7,
K16, K17, K22, K25-K27, A19, A20, V1-V3) and model training (K1-K4, K14, K15, K18-K21,
K23, K24; rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.operators import dates, encode, models, profile, reports, select
from tabsmith.plans.claims import claims, with_claims
from tabsmith.plans.model_input import KEY, model_frame
from tabsmith.plans.registry import query, rounded

# -- rule-based predictions (an oracle can reproduce them) ------------------------------


def rule_predictions(spark, sf, rule: int = 1):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type", "carrier_type", "number_of_dependents")
    m = encode.fit_labels(c.select("claim_injury_type"), "claim_injury_type")
    d = encode.encode_labels(c, m, "claim_injury_type", out="true_label")
    if rule == 1:
        hit = F.col("carrier_type").isin("AUTOMOBILE", "BUILDING")
        other = (F.col("claim_identifier") + F.col("number_of_dependents")) % 5
    else:
        hit = F.col("carrier_type") == "MACHINERY"
        other = F.col("claim_identifier") % 5
    return d.select("claim_identifier", "true_label",
                    F.when(hit, F.col("true_label")).otherwise(other).cast("int").alias("predicted_label"),
                    (1.0 / (1 + F.col("number_of_dependents"))).alias("prediction_confidence"))


def _pred_sql(rule: int = 1, name: str = "pred") -> str:
    if rule == 1:
        hit, other = "carrier_type IN ('AUTOMOBILE', 'BUILDING')", "(claim_identifier + number_of_dependents) % 5"
    else:
        hit, other = "carrier_type = 'MACHINERY'", "claim_identifier % 5"
    return f"""{name} AS (SELECT claim_identifier, true_label,
    CAST(CASE WHEN {hit} THEN true_label ELSE {other} END AS INTEGER) AS predicted_label,
    1.0 / (1 + number_of_dependents) AS prediction_confidence FROM lab)"""


LAB = """lab AS (SELECT claim_identifier, CAST(dense_rank() OVER (ORDER BY claim_injury_type) - 1 AS INTEGER)
         AS true_label, carrier_type, number_of_dependents FROM claims)"""


def _per_class_sql(src: str, name: str) -> str:
    return f"""{name}_pc AS (SELECT c, CAST(sum(is_true) AS BIGINT) AS support, CAST(sum(is_pred) AS BIGINT) AS predicted,
           CAST(sum(hit) AS BIGINT) AS tp FROM (
    SELECT true_label AS c, CAST(true_label = predicted_label AS INTEGER) AS hit, 1 AS is_true, 0 AS is_pred FROM {src}
    UNION ALL SELECT predicted_label, 0, 0, 1 FROM {src}) GROUP BY c),
{name}_m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
           CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM {name}_pc),
{name} AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END
           AS f1 FROM {name}_m)"""


BASE_SQL = f"WITH {LAB},\n{_pred_sql(1)},\n{_per_class_sql('pred', 'pc')}\n"


@query("confusion", with_claims(BASE_SQL + """
, g AS (SELECT true_label, predicted_label, count(*) AS count FROM pred GROUP BY 1, 2)
SELECT true_label, predicted_label, count, round(count / sum(count) OVER (PARTITION BY true_label), 6) AS row_rate
FROM g
"""))
def confusion(spark, sf):
    return rounded(models.confusion(rule_predictions(spark, sf)))


@query("macro_metrics", with_claims(BASE_SQL + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision_macro,
       round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro FROM pc
"""))
def macro_metrics(spark, sf):
    return rounded(models.macro_metrics(rule_predictions(spark, sf)))


REPORT_SQL = """
SELECT CAST(c AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc
"""


@query("classification_report", with_claims(BASE_SQL + REPORT_SQL))
def classification_report(spark, sf):
    return rounded(models.classification_report(rule_predictions(spark, sf)))


@query("class_table", with_claims(BASE_SQL + """
SELECT CAST(c AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM pc
"""))
def class_table(spark, sf):
    return rounded(reports.class_table(models.classification_report(rule_predictions(spark, sf))))


@query("confusion_rates", with_claims(BASE_SQL + """
, g AS (SELECT true_label, predicted_label, count(*) AS count FROM pred GROUP BY 1, 2)
SELECT true_label, predicted_label, round(count / sum(count) OVER (PARTITION BY true_label), 6) AS row_rate FROM g
"""))
def confusion_rates(spark, sf):
    return rounded(reports.confusion_rates(models.confusion(rule_predictions(spark, sf))))


@query("best_model", with_claims(f"""
WITH {LAB}, {_pred_sql(1, 'p1')}, {_pred_sql(2, 'p2')},
{_per_class_sql('p1', 'm1')}, {_per_class_sql('p2', 'm2')},
mt AS (SELECT 'rule_a' AS model, 0 AS position, avg(f1) AS f1_macro FROM m1
       UNION ALL SELECT 'rule_b', 1, avg(f1) FROM m2)
SELECT model, position, round(f1_macro, 6) AS f1_macro FROM mt ORDER BY f1_macro DESC, position LIMIT 1
"""))
def best_model(spark, sf):
    parts = []
    for i, (name, rule) in enumerate([("rule_a", 1), ("rule_b", 2)]):
        mm = models.macro_metrics(rule_predictions(spark, sf, rule))
        parts.append(mm.select(F.lit(name).alias("model"), F.lit(i).alias("position"), "f1_macro"))
    return rounded(models.pick_best(parts[0].unionByName(parts[1])))


@query("prediction_stats", with_claims(f"""
WITH {LAB}, {_pred_sql(1)}
SELECT round(avg(prediction_confidence), 6) AS mean_confidence, round(stddev_samp(prediction_confidence), 6)
       AS std_confidence, round(min(prediction_confidence), 6) AS min_confidence,
       round(max(prediction_confidence), 6) AS max_confidence, count(DISTINCT predicted_label) AS n_predicted_classes
FROM pred
"""))
def prediction_stats(spark, sf):
    return rounded(profile.prediction_stats(rule_predictions(spark, sf)))


# -- selection statistics -------------------------------------------------------------

SEL_NUM = ["age_at_injury", "birth_year", "average_weekly_wage", "number_of_dependents", "ime_4_count"]
SEL_CAT = ["gender", "carrier_type", "county_of_injury", "industry_code"]
ENC_LAB = "CAST(dense_rank() OVER (ORDER BY claim_injury_type) - 1 AS DOUBLE)"


def _labelled(spark, sf):
    c = claims(spark, sf)
    m = encode.fit_labels(c.select("claim_injury_type"), "claim_injury_type")
    return encode.encode_labels(c, m, "claim_injury_type", out="label")


CORR_IMP_SQL = f"""lc AS (SELECT *, {ENC_LAB} AS label FROM claims),
ci AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), label)) AS importance FROM lc"
                           for f in SEL_NUM)})"""


@query("corr_importance", with_claims(f"WITH {CORR_IMP_SQL} SELECT feature, round(importance, 6) AS importance FROM ci"))
def corr_importance(spark, sf):
    return rounded(select.correlation_importance(_labelled(spark, sf), SEL_NUM, "label"))


@query("importance_stats", with_claims(f"""
WITH {CORR_IMP_SQL}
SELECT count(importance) AS n_features, round(max(importance), 6) AS max_importance,
       round(min(importance), 6) AS min_importance, round(avg(importance), 6) AS mean_importance,
       round(stddev_samp(importance), 6) AS std_importance FROM ci
"""))
def importance_stats(spark, sf):
    imp = select.correlation_importance(_labelled(spark, sf), SEL_NUM, "label")
    return rounded(profile.importance_stats(imp))


@query("importance_selection", with_claims(f"""
WITH {CORR_IMP_SQL}
SELECT feature, round(importance, 6) AS importance FROM ci WHERE importance >= (SELECT median(importance) FROM ci)
"""))
def importance_selection(spark, sf):
    imp = select.correlation_importance(_labelled(spark, sf), SEL_NUM, "label")
    return rounded(select.select_by_importance(imp, "median"))


def _ct_sql(features):
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS x, CAST(claim_injury_type AS VARCHAR) AS y FROM claims "
        f"WHERE {f} IS NOT NULL AND claim_injury_type IS NOT NULL" for f in features)


MI_SQL = f"""ct AS (SELECT feature, x, y, count(*) AS n FROM ({_ct_sql(SEL_CAT)}) GROUP BY 1, 2, 3),
tot AS (SELECT feature, sum(n) AS n_total FROM ct GROUP BY 1),
px AS (SELECT feature, x, sum(n) AS nx FROM ct GROUP BY 1, 2),
py AS (SELECT feature, y, sum(n) AS ny FROM ct GROUP BY 1, 2),
mi AS (SELECT ct.feature, sum((n / n_total) * ln(n * n_total / (nx * ny))) AS mutual_information
       FROM ct JOIN px USING (feature, x) JOIN py USING (feature, y) JOIN tot USING (feature) GROUP BY 1)"""


@query("mutual_info", with_claims(f"""
WITH {MI_SQL}
SELECT feature, round(mutual_information, 6) AS mutual_information, mutual_information >= 0.01 AS keep FROM mi
"""))
def mutual_info(spark, sf):
    return rounded(select.mutual_information(claims(spark, sf), SEL_CAT, "claim_injury_type"))


CHI_SQL = f"""{MI_SQL},
r AS (SELECT feature, count(*) AS r FROM px GROUP BY 1),
cc AS (SELECT feature, count(*) AS c FROM py GROUP BY 1),
cells AS (SELECT px.feature, px.x, py.y, nx, ny FROM px JOIN py USING (feature)),
fullc AS (SELECT cells.*, coalesce(ct.n, 0) AS o, nx * ny / tot.n_total AS e, (r - 1) * (c - 1) AS dof
         FROM cells LEFT JOIN ct USING (feature, x, y) JOIN tot USING (feature) JOIN r USING (feature)
         JOIN cc USING (feature)),
chi0 AS (SELECT feature, CAST(any_value(dof) AS INTEGER) AS dof,
           sum(pow(CASE WHEN dof = 1 THEN greatest(abs(o - e) - 0.5, 0) ELSE abs(o - e) END, 2) / e) AS x2
         FROM fullc GROUP BY 1),
chi AS (SELECT feature, CASE WHEN dof = 0 THEN 0.0 ELSE x2 END AS chi2, dof,
          CASE WHEN dof = 0 OR x2 = 0 THEN 1.0 WHEN x2 / 2 - dof / 2 > 1000 THEN 0.0
               ELSE greatest(0.0, 1.0 - exp(-x2 / 2 + (dof / 2) * ln(x2 / 2) - lgamma(dof / 2 + 1))
                 * list_sum(list_transform(range(0, 4000),
                     lambda n: exp(n * ln(x2 / 2) - (lgamma(dof / 2 + n + 1) - lgamma(dof / 2 + 1)))))) END AS p_value
        FROM chi0)"""


@query("chi2_independence", with_claims(f"""
WITH {CHI_SQL}
SELECT feature, round(chi2, 6) AS chi2, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS important FROM chi
"""))
def chi2_independence(spark, sf):
    return rounded(select.chi2_independence(claims(spark, sf), SEL_CAT, "claim_injury_type"))


@query("class_weights", with_claims("""
WITH g AS (SELECT claim_injury_type, count(*) AS n_c FROM claims GROUP BY 1)
SELECT claim_injury_type, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS class_weight FROM g
"""))
def class_weights(spark, sf):
    return rounded(select.class_weights(claims(spark, sf), "claim_injury_type"))


@query("feature_votes", with_claims(f"""
WITH {CHI_SQL},
v AS (SELECT feature, CAST(p_value < 0.05 AS INTEGER) AS keep FROM chi
      UNION ALL SELECT feature, CAST(mutual_information >= 0.001 AS INTEGER) FROM mi),
g AS (SELECT feature, sum(keep) AS votes, count(*) AS methods FROM v GROUP BY 1)
SELECT feature, CAST(votes AS BIGINT) AS votes, methods,
       CASE WHEN votes <= 3 THEN 'drop' WHEN votes <= 5 THEN 'try' ELSE 'keep' END AS decision FROM g
"""))
def feature_votes(spark, sf):
    c = claims(spark, sf)
    chi = select.chi2_independence(c, SEL_CAT, "claim_injury_type").select("feature", F.col("important").alias("keep"))
    mi = select.mutual_information(c, SEL_CAT, "claim_injury_type", keep=0.001).select("feature", "keep")
    return select.vote_table({"chi2": chi, "mutual_information": mi}, categorical=SEL_CAT)


@query("combine_selection", with_claims(f"""
WITH {CORR_IMP_SQL}, {MI_SQL.replace('ct AS (', 'ct AS (', 1)},
a AS (SELECT feature, importance FROM ci WHERE importance >= (SELECT median(importance) FROM ci)),
b AS (SELECT feature, mutual_information AS importance FROM mi WHERE mutual_information >= 0.0001),
u AS (SELECT feature FROM a UNION SELECT feature FROM b)
SELECT u.feature, round(coalesce(a.importance, 0), 6) AS xgb_importance,
       round(coalesce(b.importance, 0), 6) AS rf_importance,
       round((coalesce(a.importance, 0) + coalesce(b.importance, 0)) / 2, 6) AS avg_importance
FROM u LEFT JOIN a USING (feature) LEFT JOIN b USING (feature)
"""))
def combine_selection(spark, sf):
    lab = _labelled(spark, sf)
    a = select.select_by_importance(select.correlation_importance(lab, SEL_NUM, "label"), "median")
    mi = select.mutual_information(claims(spark, sf), SEL_CAT, "claim_injury_type")
    b = select.select_by_importance(mi.select("feature", F.col("mutual_information").alias("importance")), 0.0001)
    return rounded(select.combine_selection(a, b, "union"))


@query("top_features", with_claims(f"""
WITH {CORR_IMP_SQL}, {MI_SQL},
a AS (SELECT feature, importance FROM ci),
b AS (SELECT feature, mutual_information AS importance FROM mi),
u AS (SELECT feature FROM a UNION SELECT feature FROM b),
s AS (SELECT u.feature, coalesce(a.importance, 0) AS xgb_importance, coalesce(b.importance, 0) AS rf_importance,
             (coalesce(a.importance, 0) + coalesce(b.importance, 0)) / 2 AS avg_importance
      FROM u LEFT JOIN a USING (feature) LEFT JOIN b USING (feature))
SELECT feature, round(xgb_importance, 6) AS xgb_importance, round(rf_importance, 6) AS rf_importance,
       round(avg_importance, 6) AS avg_importance FROM s ORDER BY avg_importance DESC, feature LIMIT 5
"""))
def top_features(spark, sf):
    lab = _labelled(spark, sf)
    a = select.correlation_importance(lab, SEL_NUM, "label")
    mi = select.mutual_information(claims(spark, sf), SEL_CAT, "claim_injury_type")
    b = mi.select("feature", F.col("mutual_information").alias("importance"))
    return rounded(reports.top_features(select.combine_selection(a, b, "union"), 5))


def _named_claims(spark, sf):
    """The claims under the names of the model table, with the date parts of the feature subsets."""
    c = claims(spark, sf)
    names = {"ime_4_count": "IME-4 Count", "age_at_injury": "Age at Injury", "c_2_date": "C-2 Date", "c_3_date": "C-3 Date",
             "accident_date": "Accident Date", "assembly_date": "Assembly Date"}
    c = c.withColumnsRenamed(names)
    c = dates.elapsed_days(c, "Accident Date", {"Days_to_C2": "C-2 Date", "Days_to_C3": "C-3 Date"})
    return dates.date_components(c, ["C-2 Date", "C-3 Date", "Accident Date", "Assembly Date"])


def _part(kind: str, c: str, name: str) -> str:
    e = {"Year": f"year({c})", "Month": f"month({c})", "Day": f"day({c})", "DayOfWeek": f"isodow({c}) - 1"}[kind]
    return f'coalesce(CAST({e} AS INTEGER), -1) AS "{name}_{kind}"'


def _elapsed(c: str, name: str) -> str:
    return f'coalesce(CAST(floor(date_diff(\'microsecond\', accident_date, {c}) / 86400000000.0) AS BIGINT), -1) AS "{name}"'


ESSENTIAL_SQL = f"""ime_4_count AS "IME-4 Count", {_part('Year', 'c_2_date', 'C-2 Date')},
{_part('Year', 'accident_date', 'Accident Date')}, {_part('Year', 'assembly_date', 'Assembly Date')}"""


@query("fixed_subset", with_claims(f"SELECT claim_identifier, {ESSENTIAL_SQL} FROM claims"))
def fixed_subset(spark, sf):
    return select.fixed_subset(_named_claims(spark, sf), "essential", keep=["claim_identifier"])


@query("fixed_subset_reduced", with_claims(f"""
SELECT claim_identifier, {ESSENTIAL_SQL}, age_at_injury AS "Age at Injury", {_elapsed('c_2_date', 'Days_to_C2')},
{_elapsed('c_3_date', 'Days_to_C3')}, {_part('Day', 'c_2_date', 'C-2 Date')}, {_part('DayOfWeek', 'c_2_date', 'C-2 Date')},
{_part('Day', 'c_3_date', 'C-3 Date')}, {_part('Month', 'c_3_date', 'C-3 Date')}, {_part('Year', 'c_3_date', 'C-3 Date')},
{_part('Month', 'accident_date', 'Accident Date')}
FROM claims
"""))
def fixed_subset_reduced(spark, sf):
    return select.fixed_subset(_named_claims(spark, sf), "reduced", keep=["claim_identifier"])


@query("selection_reduction", with_claims(f"""
WITH {CORR_IMP_SQL}, s AS (SELECT feature FROM ci WHERE importance >= (SELECT median(importance) FROM ci))
SELECT CAST({len(SEL_NUM)} AS BIGINT) AS n_before, count(*) AS n_after,
       round(100.0 * ({len(SEL_NUM)} - count(*)) / {len(SEL_NUM)}, 6) AS reduction_pct FROM s
"""))
def selection_reduction(spark, sf):
    imp = select.correlation_importance(_labelled(spark, sf), SEL_NUM, "label")
    return rounded(select.selection_reduction(SEL_NUM, select.select_by_importance(imp, "median")))


# -- model training (rows-only checks) -------------------------------------------------

#: The reference's sizes are the operators' defaults: 100 trees of depth 10, 100 rounds of depth 6.
#: One-vs-rest boosting, which K1 no longer uses, fits every class apart and keeps a small size.
QUERY_OVR = {"n_estimators": 5, "max_depth": 3}


def _train_frame(spark, sf):
    d, feats, label, k = model_frame(spark, sf)
    return d.where(F.col("split") == "train"), d, feats, label, k


@query("rf_predict")
def rf_predict(spark, sf):
    train, d, feats, label, k = _train_frame(spark, sf)
    m = models.train_forest(train, feats, label)
    return models.predictions(m, d.where(F.col("split") == "test"), label, k, key=KEY)


@query("gbt_ovr_predict")
def gbt_ovr_predict(spark, sf):
    train, d, feats, label, k = _train_frame(spark, sf)
    m = models.train_boosted_ovr(train, feats, label, QUERY_OVR)
    return models.predictions(m, d.where(F.col("split") == "test"), label, k, key=KEY)


@query("boosted_predict")
def boosted_predict(spark, sf):
    """Softmax boosting at the reference's size."""
    train, d, feats, label, k = _train_frame(spark, sf)
    m = models.train_boosted(train, feats, label)
    return models.predictions(m, d.where(F.col("split") == "test"), label, k, key=KEY)


#: Features of the one-split model: few values each, one of them with missing ones.
SPLIT_ON = {"number_of_dependents": "number_of_dependents", "ime_4_count": "ime_4_count", "decade": "age_at_injury // 10"}


@query("boosted_first_split", with_claims(f"""
WITH rows AS (SELECT dense_rank() OVER (ORDER BY claim_injury_type) - 1 AS y,
              {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in SPLIT_ON.items())} FROM claims),
k AS (SELECT max(y) + 1 AS k FROM rows),
long AS ({' UNION ALL '.join(f"SELECT y, {i} AS f, '{n}' AS feature, {n} AS v FROM rows" for i, n in enumerate(SPLIT_ON))}),
cells AS (SELECT c.class, f, feature, v, sum(1.0 / k - CAST(y = c.class AS INTEGER)) AS g, sum(1.0 / k * (1 - 1.0 / k)) AS h
          FROM long, k, (SELECT DISTINCT y AS class FROM rows) c GROUP BY ALL),
cuts AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER a AS gt, sum(h) OVER a AS ht FROM cells
         WINDOW w AS (PARTITION BY class, f ORDER BY v NULLS FIRST), a AS (PARTITION BY class, f)),
gains AS (SELECT *, 0.5 * (gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) AS gain FROM cuts
          WHERE hl >= 1 AND ht - hl >= 1 AND gl IS NOT NULL)
SELECT CAST(class AS INTEGER) AS class, feature, v AS cut, round(gain, 6) AS gain,
       round(-0.1 * gl / (hl + 1), 6) AS left_value, round(-0.1 * (gt - gl) / (ht - hl + 1), 6) AS right_value
FROM gains WHERE gain > 1e-10
QUALIFY row_number() OVER (PARTITION BY class ORDER BY round(gain, 9) DESC, f, v NULLS FIRST) = 1
"""))
def boosted_first_split(spark, sf):
    """K1: the first split of every class on all claims is the one of the largest second-order gain."""
    from tabsmith.operators import boosting
    c = claims(spark, sf)
    c = encode.encode_labels(c, encode.fit_labels(c.select("claim_injury_type"), "claim_injury_type"), "claim_injury_type", out="y")
    c = c.select("y", *[F.expr(e.replace(" // ", " div ")).cast("double").alias(n) for n, e in SPLIT_ON.items()])
    m = boosting.train(c, list(SPLIT_ON), "y", rounds=1, max_depth=1)
    return rounded(m.split_table(spark).drop("round", "node"))


@query("rf_importances")
def rf_importances(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    imp = models.importances(models.train_forest(train, feats, label), feats)
    return select.select_by_importance(imp, "mean")


@query("train_and_evaluate")
def train_and_evaluate(spark, sf):
    d, feats, label, k = model_frame(spark, sf)
    _, metrics, best = models.train_and_evaluate(d, feats, label, k)
    return metrics


@query("model_report")
def model_report(spark, sf):
    train, d, feats, label, k = _train_frame(spark, sf)
    m = models.train_forest(train, feats, label)
    _, report = models.evaluate(m, d.where(F.col("split") == "test"), label, k)
    return report


@query("permutation_importance")
def permutation_importance(spark, sf):
    train, d, feats, label, _ = _train_frame(spark, sf)
    m = models.train_forest(train, feats, label)
    return models.permutation_importance(m, d.where(F.col("split") == "val"), feats, label, KEY, 5, 42)


@query("top_permutation")
def top_permutation(spark, sf):
    train, d, feats, label, _ = _train_frame(spark, sf)
    m = models.train_forest(train, feats, label)
    pi = models.permutation_importance(m, d.where(F.col("split") == "val"), feats, label, KEY, 5, 42)
    return reports.top_permutation(pi, 15)


@query("lasso")
def lasso(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    return select.lasso_coefficients(train, feats, label)


LASSO_SQL = "average_weekly_wage IS NOT NULL AND number_of_dependents IS NOT NULL"


@query("lasso_one_feature", with_claims(f"""
WITH m AS (SELECT covar_pop(number_of_dependents, average_weekly_wage) AS c, var_pop(number_of_dependents) AS v FROM claims WHERE {LASSO_SQL})
SELECT 'number_of_dependents' AS feature, round(sign(c) * greatest(abs(c) - 5.0, 0) / v, 6) AS coefficient FROM m
"""))
def lasso_one_feature(spark, sf):
    """With one feature the solution is the soft-thresholded covariance."""
    got = select.lasso_coefficients(claims(spark, sf), ["number_of_dependents"], "average_weekly_wage", reg=5.0)
    return rounded(got.select("feature", "coefficient"))


LASSO_ON = ["age_at_injury", "number_of_dependents", "ime_4_count", "claim_identifier"]


@query("lasso_optimal", " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS optimal" for c in LASSO_ON))
def lasso_optimal(spark, sf):
    """At the solution no coefficient can move: the residual's covariance with a feature is the penalty
    where its coefficient is not 0, and no more elsewhere."""
    reg = 20.0
    c = claims(spark, sf).select(*[F.col(x).cast("double") for x in LASSO_ON], F.col("average_weekly_wage").alias("y")).dropna()
    coef = {r["feature"]: r["coefficient"] for r in select.lasso_coefficients(c, LASSO_ON, "y", reg=reg).collect()}
    rest = F.col("y") - sum((F.col(x) * coef[x] for x in LASSO_ON), F.lit(0.0))
    row = c.select(*LASSO_ON, rest.alias("rest"), "y").agg(*[F.covar_pop(x, "rest").alias(x) for x in LASSO_ON], F.stddev_pop("y").alias("sd"),
                                                          *[F.stddev_pop(x).alias(f"sd_{x}") for x in LASSO_ON])
    lines = []
    for x in LASSO_ON:
        room = 1e-8 * F.col("sd") * F.col(f"sd_{x}")
        ok = (F.abs(F.col(x) - (reg if coef[x] > 0 else -reg)) <= room) if coef[x] else (F.abs(F.col(x)) <= reg + room)
        lines.append(F.struct(F.lit(x).alias("feature"), ok.alias("optimal")))
    return row.select(F.explode(F.array(*lines)).alias("s")).select("s.*")


@query("rfe")
def rfe(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    return select.recursive_elimination(train, feats, label)


@query("tree_importance")
def tree_importance(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    return select.tree_importance(train, feats, label)


@query("boosted_importance")
def boosted_importance(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    return select.boosted_importance(train, feats, label)


@query("cv_scores")
def cv_scores(spark, sf):
    train, _, feats, label, _ = _train_frame(spark, sf)
    return models.cv_performance(train, feats, label, KEY, scale=["average_weekly_wage"])


@query("fold_ensemble")
def fold_ensemble(spark, sf):
    train, d, feats, label, k = _train_frame(spark, sf)
    return models.fold_ensemble(train, d.where(F.col("split") == "test"), feats, label, KEY, k)
