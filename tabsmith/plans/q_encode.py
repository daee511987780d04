"""Catalogue: scalars (M*), encoders (E*), features (G*), splits (L*), joins J1/J2."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions import scalars as sx
from tabsmith.operators import encode, features, split
from tabsmith.operators.impute import fit_medians
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.registry import query, rounded

# -- scalars ----------------------------------------------------------------------


@query("log_sqrt", with_claims("""
SELECT claim_identifier,
       round(CASE WHEN average_weekly_wage > 0 THEN log10(average_weekly_wage) END, 6) AS log_wage,
       round(CASE WHEN ime_4_count > 0 THEN sqrt(ime_4_count) ELSE 0 END, 6) AS sqrt_ime4
FROM claims
"""))
def log_sqrt(spark, sf):
    c = claims(spark, sf)
    return rounded(c.select("claim_identifier", sx.log10_or_null("average_weekly_wage").alias("log_wage"),
                            sx.sqrt_or_zero("ime_4_count").alias("sqrt_ime4")))


@query("impact_category", with_claims("""
SELECT claim_identifier,
  CASE WHEN average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END > 50000 THEN 0
       WHEN average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END >= 1000
        AND average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END <= 50000 THEN 1
       ELSE 2 END AS "Financial Impact Category"
FROM claims
"""))
def impact_category(spark, sf):
    c = claims(spark, sf)
    impact = sx.per_dependent("average_weekly_wage", "number_of_dependents")
    return c.select("claim_identifier", sx.impact_category(impact).alias("Financial Impact Category"))


@query("age_group", with_claims("""
SELECT claim_identifier,
  CASE WHEN age_at_injury >= 0 AND age_at_injury < 25 THEN 0
       WHEN age_at_injury >= 25 AND age_at_injury < 40 THEN 1
       WHEN age_at_injury >= 40 AND age_at_injury < 55 THEN 2
       WHEN age_at_injury >= 55 AND age_at_injury < 70 THEN 3
       WHEN age_at_injury >= 70 AND age_at_injury < 100 THEN 4
       ELSE -1 END AS Age_Group
FROM claims
"""))
def age_group(spark, sf):
    return claims(spark, sf).select("claim_identifier", sx.bin_code("age_at_injury").alias("Age_Group"))


@query("relative_wage", with_claims("""
SELECT claim_identifier,
       CASE WHEN average_weekly_wage > (SELECT median(average_weekly_wage) FROM claims) THEN 1 ELSE 0 END
         AS Relative_Wage
FROM claims
"""))
def relative_wage(spark, sf):
    c = claims(spark, sf)
    med = fit_medians(c, ["average_weekly_wage"])["average_weekly_wage"]
    return c.select("claim_identifier", sx.above("average_weekly_wage", med).alias("Relative_Wage"))


@query("capitalize", with_claims("""
SELECT claim_identifier, upper(substr(county_of_injury, 1, 1)) || lower(substr(county_of_injury, 2)) AS county
FROM claims
"""))
def capitalize(spark, sf):
    return claims(spark, sf).select("claim_identifier", sx.capitalize("county_of_injury").alias("county"))


RISK = {"AUTOMOBILE": 2, "BUILDING": 2, "FURNITURE": 1, "HOUSEHOLD": 0}


@query("risk_map", with_claims("""
SELECT claim_identifier,
  CASE carrier_type WHEN 'AUTOMOBILE' THEN 2 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 1
                    WHEN 'HOUSEHOLD' THEN 0 ELSE 1 END AS Risk_Level
FROM claims
"""))
def risk_map(spark, sf):
    c = claims(spark, sf)
    return c.select("claim_identifier", sx.lookup("carrier_type", RISK, default=1).alias("Risk_Level"))


@query("category_codes", with_claims("""
SELECT claim_identifier,
       CAST(coalesce(dense_rank() OVER (ORDER BY industry_code) - 1, -1) AS INTEGER) AS industry_code
FROM claims
"""))
def category_codes(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "industry_code")
    return encode.category_codes(c, "industry_code")


@query("abs_difference", """
SELECT l_orderkey, l_linenumber, round(abs(l_extendedprice - l_quantity * 1000), 6) AS abs_gap FROM lineitem
""")
def abs_difference(spark, sf):
    li = load(spark, sf, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber",
                             sx.abs_diff("l_extendedprice", F.col("l_quantity") * 1000).alias("abs_gap")))


# -- encoders -------------------------------------------------------------------------


@query("label_encode", with_claims("""
SELECT claim_identifier, CAST(dense_rank() OVER (ORDER BY claim_injury_type) - 1 AS INTEGER) AS claim_injury_type
FROM claims
"""))
def label_encode(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    m = encode.fit_labels(c, "claim_injury_type")
    return encode.encode_labels(c, m, "claim_injury_type")


@query("decode_labels", with_claims("""
SELECT claim_identifier, claim_injury_type AS decoded FROM claims
"""))
def decode_labels(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    m = encode.fit_labels(c, "claim_injury_type")
    coded = encode.encode_labels(c, m, "claim_injury_type", out="label")
    return encode.decode_labels(coded.drop("claim_injury_type"), m, "label", out="decoded").drop("label")


@query("one_hot", with_claims("""
SELECT claim_identifier,
       CAST(gender = 'O' AS INTEGER) AS gender_O, CAST(gender = 'P' AS INTEGER) AS gender_P,
       CAST(carrier_type = 'BUILDING' AS INTEGER) AS carrier_type_BUILDING,
       CAST(carrier_type = 'FURNITURE' AS INTEGER) AS carrier_type_FURNITURE,
       CAST(carrier_type = 'HOUSEHOLD' AS INTEGER) AS carrier_type_HOUSEHOLD,
       CAST(carrier_type = 'MACHINERY' AS INTEGER) AS carrier_type_MACHINERY
FROM claims
"""))
def one_hot(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "gender", "carrier_type")
    cats = encode.fit_one_hot(c, ["gender", "carrier_type"])
    return encode.one_hot(c, cats)


FREQ_COLS = ["county_of_injury", "carrier_type", "industry_code"]


def _freq_sql(c):
    return (f"(SELECT count(*) FROM claims x WHERE coalesce(x.{c}, 'Unknown') = coalesce(claims.{c}, 'Unknown'))"
            f" / (SELECT count(*) FROM claims)")


@query("frequency_encode", with_claims(f"""
SELECT claim_identifier, {', '.join(f'round({_freq_sql(c)}, 6) AS "Enc {c}"' for c in FREQ_COLS)}
FROM claims
"""))
def frequency_encode(spark, sf):
    c = claims(spark, sf).select("claim_identifier", *FREQ_COLS)
    m = encode.fit_frequency(c, FREQ_COLS)
    return rounded(encode.frequency(c, m, FREQ_COLS, drop_source=True))


@query("frequency_ties", with_claims("""
WITH f AS (SELECT 'county_of_injury' AS feature, county_of_injury AS v, count(*) AS n FROM claims GROUP BY 2
           UNION ALL SELECT 'carrier_type', carrier_type, count(*) FROM claims GROUP BY 2
           UNION ALL SELECT 'industry_code', industry_code, count(*) FROM claims GROUP BY 2),
t AS (SELECT feature, n, count(*) AS n_values FROM f GROUP BY 1, 2 HAVING count(*) > 1)
SELECT feature, CAST(sum(n_values) AS BIGINT) AS tied_values FROM t GROUP BY 1
"""))
def frequency_ties(spark, sf):
    c = claims(spark, sf)
    return encode.frequency_ties(encode.fit_frequency(c, FREQ_COLS))


@query("hash_encode")
def hash_encode(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "county_of_injury")
    return encode.hash_buckets(c, "county_of_injury", 16)


SEASON_ORD = {"Winter": 0, "Spring": 1, "Summer": 2, "Fall": 3}


@query("sine_cosine", with_claims("""
WITH s AS (SELECT claim_identifier,
  CASE WHEN month(accident_date) * 100 + day(accident_date) >= 1221
         OR month(accident_date) * 100 + day(accident_date) < 320 THEN 0
       WHEN month(accident_date) * 100 + day(accident_date) < 621 THEN 1
       WHEN month(accident_date) * 100 + day(accident_date) < 923 THEN 2
       ELSE 3 END AS o
FROM claims)
SELECT claim_identifier, round(sin(2 * pi() * o / 4), 6) AS accident_season_Sin,
       round(cos(2 * pi() * o / 4), 6) AS accident_season_Cos FROM s
"""))
def sine_cosine(spark, sf):
    c = claims(spark, sf).select("claim_identifier", sx.season("accident_date").alias("accident_season"))
    return rounded(encode.sine_cosine(c, "accident_season", SEASON_ORD, 4))


@query("encode_claims", with_claims("""
SELECT claim_identifier, accident_date, age_at_injury,
       CAST(dense_rank() OVER (ORDER BY claim_injury_type) - 1 AS INTEGER) AS claim_injury_type,
       coalesce(CAST(year(accident_date) AS INTEGER), -1) AS accident_date_Year,
       coalesce(CAST(month(accident_date) AS INTEGER), -1) AS accident_date_Month,
       coalesce(CAST(day(accident_date) AS INTEGER), -1) AS accident_date_Day,
       coalesce(CAST(isodow(accident_date) - 1 AS INTEGER), -1) AS accident_date_DayOfWeek,
       CAST(gender = 'O' AS INTEGER) AS gender_O, CAST(gender = 'P' AS INTEGER) AS gender_P
FROM (SELECT DISTINCT claim_identifier, accident_date, age_at_injury, claim_injury_type, gender FROM claims)
"""))
def encode_claims(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "accident_date", "age_at_injury",
                                 "claim_injury_type", "gender",
                                 F.lit(None).cast("string").alias("oiics_nature_of_injury_description"))
    out, _ = encode.encode_frame(c, "claim_injury_type", ["accident_date"], ["gender"])
    return out


# -- features ----------------------------------------------------------------------

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


def _inter_sql():
    parts = []
    for i, a in enumerate(LI_NUM[:5]):
        for b in LI_NUM[i + 1:6]:
            parts.append(f"round(CAST({a} AS DOUBLE) * {b}, 6) AS {a}_x_{b}")
    return ",\n       ".join(parts)


@query("interactions", f"""
SELECT l_orderkey, {', '.join(LI_NUM)},
       {_inter_sql()}
FROM lineitem
""")
def interactions(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", *LI_NUM)
    out = features.interactions(li.withColumns({c: F.col(c).cast("double") for c in ["l_linenumber", "l_suppkey"]}),
                                LI_NUM)
    out = out.withColumns({c: F.col(c).cast(t) for c, t in [("l_linenumber", "int"), ("l_suppkey", "bigint")]})
    return rounded(out)


POLY = ["l_quantity", "l_discount", "l_tax"]


def _poly_sql():
    terms = features.polynomial_terms(POLY, 2)
    return ",\n       ".join(f"round({' * '.join(t)}, 6) AS poly_{i}" for i, t in enumerate(terms))


@query("polynomial", f"""
SELECT l_orderkey, l_linenumber, {_poly_sql()} FROM lineitem
""")
def polynomial(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *POLY)
    return rounded(features.polynomial(li, POLY, 2).drop(*POLY))


CLAIM_NUM = ["age_at_injury", "birth_year", "average_weekly_wage", "number_of_dependents", "ime_4_count"]


@query("row_stats", with_claims(f"""
WITH a AS (SELECT claim_identifier,
           list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL) AS l
           FROM claims)
SELECT claim_identifier, round(list_avg(l), 6) AS row_mean,
       round(CASE WHEN len(l) > 1 THEN list_stddev_samp(l) END, 6) AS row_std,
       round(list_aggregate(l, 'median'), 6) AS row_median,
       round(list_max(l) - list_min(l), 6) AS row_range
FROM a
"""))
def row_stats(spark, sf):
    c = claims(spark, sf).select("claim_identifier", *CLAIM_NUM)
    return rounded(features.row_statistics(c, CLAIM_NUM).drop(*CLAIM_NUM))


@query("standard_scale", """
SELECT l_orderkey, l_linenumber,
       round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
       round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6)
         AS l_extendedprice
FROM lineitem
""")
def standard_scale(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    params = features.standard_params(features.fit_standard(li, ["l_quantity", "l_extendedprice"]))
    return rounded(features.standardize(li, params))


@query("scaler_params", """
SELECT 'l_quantity' AS feature, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std
FROM lineitem
UNION ALL SELECT 'l_tax', round(avg(l_tax), 6), round(stddev_pop(l_tax), 6) FROM lineitem
""")
def scaler_params(spark, sf):
    return rounded(features.fit_standard(load(spark, sf, "lineitem"), ["l_quantity", "l_tax"]))


@query("engineer_features", with_claims(f"""
SELECT claim_identifier, {', '.join(CLAIM_NUM)},
  {', '.join(f'round(CAST({a} AS DOUBLE) * {b}, 6) AS {a}_x_{b}' for i, a in enumerate(CLAIM_NUM[:5]) for b in CLAIM_NUM[i + 1:6])},
  round(list_avg(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL)), 6) AS row_mean,
  round(CASE WHEN len(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL)) > 1
        THEN list_stddev_samp(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL)) END, 6) AS row_std,
  round(list_aggregate(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL), 'median'), 6) AS row_median,
  round(list_max(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL))
        - list_min(list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in CLAIM_NUM)}], lambda x: x IS NOT NULL)), 6) AS row_range
FROM claims
"""))
def engineer_features(spark, sf):
    c = claims(spark, sf).select("claim_identifier", *CLAIM_NUM, "claim_injury_type")
    out = features.engineer(c, target="claim_injury_type", exclude=["claim_identifier"])
    return rounded(out.drop("claim_injury_type").withColumns(
        {f"{a}_x_{b}": F.col(f"{a}_x_{b}").cast("double")
         for i, a in enumerate(CLAIM_NUM[:5]) for b in CLAIM_NUM[i + 1:6]}))


G4_NUM = ["number_of_dependents", "ime_4_count", "age_at_injury"]


@query("engineer_polynomial", with_claims(f"""
SELECT claim_identifier, label, {', '.join(G4_NUM)},
  {', '.join(f'round(CAST({a} AS DOUBLE) * {b}, 6) AS {a}_x_{b}' for i, a in enumerate(G4_NUM) for b in G4_NUM[i + 1:])},
  {', '.join(f'round({" * ".join(f"CAST({c} AS DOUBLE)" for c in t)}, 6) AS poly_{i}' for i, t in enumerate(features.polynomial_terms(G4_NUM, 2)))},
  round(list_avg(l), 6) AS row_mean, round(CASE WHEN len(l) > 1 THEN list_stddev_samp(l) END, 6) AS row_std,
  round(list_aggregate(l, 'median'), 6) AS row_median, round(list_max(l) - list_min(l), 6) AS row_range
FROM (SELECT *, length(claim_injury_type) AS label, list_filter([{', '.join(f'CAST({c} AS DOUBLE)' for c in G4_NUM)}], lambda x: x IS NOT NULL) AS l FROM claims)
"""))
def engineer_polynomial(spark, sf):
    """G4 with polynomial features; a numeric target and the key stay out of all derived columns."""
    c = claims(spark, sf).select("claim_identifier", F.length("claim_injury_type").cast("bigint").alias("label"), *G4_NUM)
    out = features.engineer(c, target="label", polynomial_features=True, exclude=["claim_identifier"])
    return rounded(out.withColumns({f"{a}_x_{b}": F.col(f"{a}_x_{b}").cast("double") for i, a in enumerate(G4_NUM) for b in G4_NUM[i + 1:]}))


# -- splits ------------------------------------------------------------------------------

SPLIT_SQL = """
WITH r AS (SELECT claim_identifier, claim_injury_type,
             row_number() OVER (PARTITION BY claim_injury_type
                                ORDER BY md5('42' || CAST(claim_identifier AS VARCHAR)), claim_identifier) - 1 AS rk,
             count(*) OVER (PARTITION BY claim_injury_type) AS n
           FROM claims),
c AS (SELECT *, round(0.1 * n) AS n_test FROM r),
d AS (SELECT *, round(0.2 * (n - n_test)) AS n_val FROM c)
"""


@query("stratified_split", with_claims(SPLIT_SQL + """
SELECT claim_identifier, claim_injury_type,
       CASE WHEN rk < n_test THEN 'test' WHEN rk < n_test + n_val THEN 'val' ELSE 'train' END AS split
FROM d
"""))
def stratified_split(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    return split.stratified_split(c, "claim_identifier", "claim_injury_type", 0.1, 0.2, 42)


@query("split_balance", with_claims(SPLIT_SQL + """,
s AS (SELECT claim_injury_type,
       CASE WHEN rk < n_test THEN 'test' WHEN rk < n_test + n_val THEN 'val' ELSE 'train' END AS split FROM d),
g AS (SELECT split, claim_injury_type, count(*) AS n FROM s GROUP BY 1, 2)
SELECT split, claim_injury_type, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share,
       round(min(n) OVER (PARTITION BY split) / max(n) OVER (PARTITION BY split), 6) AS min_max_ratio
FROM g
"""))
def split_balance(spark, sf):
    from tabsmith.operators.clean import class_balance
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    s = split.stratified_split(c, "claim_identifier", "claim_injury_type", 0.1, 0.2, 42)
    return rounded(class_balance(s, "claim_injury_type", "split"))


@query("kfold_assign", with_claims("""
SELECT claim_identifier, claim_injury_type,
       CAST((row_number() OVER (PARTITION BY claim_injury_type
             ORDER BY md5('69' || CAST(claim_identifier AS VARCHAR)), claim_identifier) - 1) % 5 AS INTEGER) AS fold
FROM claims
"""))
def kfold_assign(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    return split.kfold(c, "claim_identifier", "claim_injury_type", 5, 69)


@query("head_sample", with_claims("""
SELECT claim_identifier, claim_injury_type FROM claims ORDER BY claim_identifier LIMIT 100
"""))
def head_sample(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    return split.head_sample(c, "claim_identifier", 100)



@query("two_way_split", with_claims("""
WITH r AS (SELECT claim_identifier, claim_injury_type,
             row_number() OVER (PARTITION BY claim_injury_type
                                ORDER BY md5('42' || CAST(claim_identifier AS VARCHAR)), claim_identifier) - 1 AS rk,
             count(*) OVER (PARTITION BY claim_injury_type) AS n
           FROM claims)
SELECT claim_identifier, claim_injury_type, CASE WHEN rk < round(0.25 * n) THEN 'test' ELSE 'train' END AS split FROM r
"""))
def two_way_split(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    return split.stratified_split(c, "claim_identifier", "claim_injury_type", 0.25, 0.0, 42)


@query("fold_scaler_params", with_claims("""
WITH f AS (SELECT claim_identifier, age_at_injury, average_weekly_wage,
             CAST((row_number() OVER (PARTITION BY claim_injury_type
                   ORDER BY md5('69' || CAST(claim_identifier AS VARCHAR)), claim_identifier) - 1) % 5 AS INTEGER) AS fold
           FROM claims),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(5))
SELECT k.k AS fold, 'age_at_injury' AS feature, round(avg(age_at_injury), 6) AS mean,
       round(stddev_pop(age_at_injury), 6) AS std FROM f JOIN k ON f.fold <> k.k GROUP BY k.k
UNION ALL
SELECT k.k, 'average_weekly_wage', round(avg(average_weekly_wage), 6), round(stddev_pop(average_weekly_wage), 6)
FROM f JOIN k ON f.fold <> k.k GROUP BY k.k
"""))
def fold_scaler_params(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type", "age_at_injury", "average_weekly_wage")
    folded = split.kfold(c, "claim_identifier", "claim_injury_type", 5, 69)
    return rounded(features.fit_fold_standard(folded, ["age_at_injury", "average_weekly_wage"]))


@query("process_splits", with_claims(SPLIT_SQL + """,
s AS (SELECT claim_identifier,
             CASE WHEN rk < n_test THEN 'test' WHEN rk < n_test + n_val THEN 'val' ELSE 'train' END AS split FROM d),
j AS (SELECT c.*, s.split FROM claims c JOIN s USING (claim_identifier)),
m AS (SELECT median(age_at_injury) AS mage, median(average_weekly_wage) AS mwage FROM j WHERE split = 'train'),
f AS (SELECT j.claim_identifier, j.split, coalesce(CAST(age_at_injury AS DOUBLE), m.mage) AS age_at_injury,
             coalesce(average_weekly_wage, m.mwage) AS average_weekly_wage, number_of_dependents,
             accident_date, birth_year, m.mwage FROM j, m)
SELECT claim_identifier, split, age_at_injury,
       coalesce(CAST(birth_year AS DOUBLE), year(accident_date) - age_at_injury) AS birth_year,
       round(average_weekly_wage, 6) AS average_weekly_wage,
       CASE WHEN average_weekly_wage > mwage THEN 1 ELSE 0 END AS Relative_Wage,
       CASE WHEN age_at_injury >= 0 AND age_at_injury < 25 THEN 0 WHEN age_at_injury >= 25 AND age_at_injury < 40 THEN 1
            WHEN age_at_injury >= 40 AND age_at_injury < 55 THEN 2 WHEN age_at_injury >= 55 AND age_at_injury < 70 THEN 3
            WHEN age_at_injury >= 70 AND age_at_injury < 100 THEN 4 ELSE -1 END AS Age_Group,
       CASE WHEN average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END > 50000
            THEN 0
            WHEN average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END >= 1000
             AND average_weekly_wage / CASE WHEN number_of_dependents = 0 THEN 1 ELSE number_of_dependents END <= 50000
            THEN 1 ELSE 2 END AS "Financial Impact Category"
FROM f
"""))
def process_splits(spark, sf):
    from tabsmith.operators.impute import process_splits as ps
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type", "accident_date",
                                 F.col("age_at_injury").cast("double").alias("age_at_injury"),
                                 F.col("birth_year").cast("double").alias("birth_year"),
                                 "average_weekly_wage", "number_of_dependents")
    s = split.stratified_split(c, "claim_identifier", "claim_injury_type", 0.1, 0.2, 42)
    out, _ = ps(s, "split", ["age_at_injury", "average_weekly_wage"], "birth_year", "accident_date",
                "age_at_injury", wage="average_weekly_wage", dependents="number_of_dependents")
    return rounded(out.select("claim_identifier", "split", "age_at_injury", "birth_year", "average_weekly_wage",
                              "Relative_Wage", "Age_Group", "Financial Impact Category"))


@query("encoder_registry", with_claims("""
WITH r(encoder, "column") AS (VALUES ('one_hot', 'gender'), ('one_hot', 'carrier_type'),
                                      ('frequency', 'county_of_injury'), ('frequency', 'industry_code'),
                                      ('label', 'claim_injury_type')),
v AS (SELECT 'gender' AS "column", gender AS value FROM claims
      UNION ALL SELECT 'carrier_type', carrier_type FROM claims
      UNION ALL SELECT 'county_of_injury', county_of_injury FROM claims
      UNION ALL SELECT 'industry_code', industry_code FROM claims
      UNION ALL SELECT 'claim_injury_type', claim_injury_type FROM claims),
s AS (SELECT "column", count(DISTINCT value) AS n_categories, bool_or(value IS NULL) AS has_null FROM v GROUP BY 1)
SELECT r.encoder, s."column", s.n_categories, s.has_null FROM r JOIN s USING ("column")
"""))
def encoder_registry(spark, sf):
    enc = {"one_hot": ["gender", "carrier_type"], "frequency": ["county_of_injury", "industry_code"],
           "label": ["claim_injury_type"]}
    return encode.encoder_summary(claims(spark, sf), enc)
