"""Catalogue: profiling (A*), joins and set operations (J*, U*, W*), columns (P*), quality (Q*)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabsmith.functions.scalars import capitalize
from tabsmith.operators import columns, profile, quality
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.registry import query, rounded

CLAIM_COLS = ["claim_identifier", "accident_date", "assembly_date", "c_2_date", "c_3_date", "age_at_injury",
              "birth_year", "average_weekly_wage", "number_of_dependents", "ime_4_count", "gender",
              "carrier_type", "county_of_injury", "industry_code", "claim_injury_type"]
CAT3 = ["county_of_injury", "carrier_type", "industry_code"]
LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NULLABLE = ["accident_date", "c_2_date", "c_3_date", "age_at_injury", "birth_year", "ime_4_count"]


def _long_sql(table: str, cols: list[str], cast: str, where_not_null: bool = True) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS value FROM {table}"
        + (f" WHERE {c} IS NOT NULL" if where_not_null else "") for c in cols)


@query("value_counts", """
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
""")
def value_counts(spark, sf):
    return profile.value_counts(load(spark, sf, "orders"), "o_orderpriority")


@query("top_n_values", with_claims(f"""
WITH vc AS (SELECT feature, value, count(*) AS count FROM ({_long_sql('claims', CAT3, 'VARCHAR')}) GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY count DESC, value) AS INTEGER) AS rank FROM vc)
SELECT feature, value, count, rank FROM r WHERE rank <= 3
"""))
def top_n_values(spark, sf):
    return profile.top_values(claims(spark, sf), CAT3, 3)


@query("top_n_others", with_claims("""
WITH vc AS (SELECT county_of_injury AS v, count(*) AS n FROM claims WHERE county_of_injury IS NOT NULL GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS rk FROM vc)
SELECT CASE WHEN rk <= 5 THEN v ELSE 'Others' END AS county_of_injury, CAST(sum(n) AS BIGINT) AS count FROM r GROUP BY 1
"""))
def top_n_others(spark, sf):
    return profile.top_with_others(claims(spark, sf), "county_of_injury", 5)


@query("distinct_counts", with_claims(f"""
SELECT feature, count(DISTINCT value) AS n_unique
FROM ({_long_sql('claims', ['gender', 'carrier_type', 'county_of_injury', 'industry_code', 'age_at_injury'], 'VARCHAR')})
GROUP BY 1
"""))
def distinct_counts(spark, sf):
    return profile.distinct_counts(claims(spark, sf),
                                   ["gender", "carrier_type", "county_of_injury", "industry_code", "age_at_injury"])


@query("approx_distinct_counts")
def approx_distinct_counts(spark, sf):
    return profile.distinct_counts(load(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"],
                                   approx=True)


@query("describe_numeric", f"""
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max
FROM ({_long_sql('lineitem', LI4, 'DOUBLE')}) GROUP BY 1
""")
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(load(spark, sf, "lineitem"), LI4))


@query("describe_categorical", with_claims(f"""
WITH vc AS (SELECT feature, value, count(*) AS n FROM ({_long_sql('claims', ['gender', 'carrier_type', 'county_of_injury'], 'VARCHAR')}) GROUP BY 1, 2),
t AS (SELECT feature, value AS top, n AS freq, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rk FROM vc)
SELECT vc.feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, any_value(top) AS top, any_value(freq) AS freq
FROM vc JOIN t ON t.feature = vc.feature AND t.rk = 1 GROUP BY 1
"""))
def describe_categorical(spark, sf):
    return profile.describe_categorical(claims(spark, sf), ["gender", "carrier_type", "county_of_injury"])


@query("missing_report", with_claims("""
WITH m AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS n FROM claims" for c in CLAIM_COLS) + """)
SELECT "column", missing, round(missing * 100.0 / n, 6) AS missing_pct FROM m WHERE missing > 0
"""))
def missing_report(spark, sf):
    return rounded(profile.missing_by_column(claims(spark, sf)))


@query("row_missing", with_claims(f"""
SELECT claim_identifier, round(({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in CLAIM_COLS[1:])}) * 100.0
       / {len(CLAIM_COLS) - 1}, 6) AS missing_pct FROM claims
"""))
def row_missing(spark, sf):
    return rounded(profile.missing_by_row(claims(spark, sf), "claim_identifier"))


@query("shape", with_claims(f"SELECT count(*) AS rows, {len(CLAIM_COLS)} AS columns FROM claims"))
def shape(spark, sf):
    return profile.shape(claims(spark, sf))


@query("non_null_info", with_claims(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' "
    f"WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type, count({c}) AS non_null "
    f"FROM claims" for c in CLAIM_COLS)))
def non_null_info(spark, sf):
    return profile.non_null_counts(claims(spark, sf))


@query("variance_rank", f"""
SELECT feature, round(var_samp(value), 6) AS variance FROM ({_long_sql('lineitem', LI4, 'DOUBLE')}) GROUP BY 1
""")
def variance_rank(spark, sf):
    return rounded(profile.variance_rank(load(spark, sf, "lineitem"), LI4))


def _corr_sql(table, cols, expr="{c}", both=True):
    parts = []
    for a, b in combinations(cols, 2):
        ea, eb = expr.format(c=a), expr.format(c=b)
        parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({ea}, {eb}), 6) AS corr FROM {table}")
        if both:
            parts.append(f"SELECT '{b}', '{a}', round(corr({ea}, {eb}), 6) FROM {table}")
    return " UNION ALL ".join(parts)


@query("corr_matrix", _corr_sql("lineitem", LI4))
def corr_matrix(spark, sf):
    return rounded(profile.correlation(load(spark, sf, "lineitem"), LI4))


#: 66 columns as wide as the processed claims table: numbers, parts of dates, indicators, with missing values.
WIDE = {**{c: c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")},
        **{f"late_{d}": f"CASE WHEN l_linenumber = {d} THEN NULL ELSE l_extendedprice * {d} - l_quantity * l_quantity END" for d in range(1, 8)},
        **{f"qty_mod_{m}": f"CAST(l_quantity AS INT) % {m}" for m in range(2, 20)},
        **{f"part_mod_{m}": f"CASE WHEN l_suppkey % {m} = 0 THEN NULL ELSE l_partkey % {m} END" for m in range(2, 20)},
        **{f"is_flag_{f}": f"CASE WHEN l_returnflag = '{f}' THEN 1 ELSE 0 END" for f in "ANR"},
        **{f"is_status_{f}": f"CASE WHEN l_linestatus = '{f}' THEN 1 ELSE 0 END" for f in "FO"},
        **{f"price_over_{k}": f"CASE WHEN l_extendedprice > {k}000 THEN l_tax ELSE NULL END" for k in range(10, 60, 10)},
        "rate": "l_extendedprice / l_quantity", "net": "l_extendedprice * (1 - l_discount)", "gross": "l_extendedprice * (1 + l_tax)",
        "fixed": "CAST(7 AS DOUBLE)", "hollow": "CAST(NULL AS DOUBLE)"}
WIDE_SQL = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items())
WIDE_CORR = ", ".join(f"corr({a}, {b})" for a, b in combinations(WIDE, 2))


@query("corr_matrix_wide", f"""
WITH wide AS (SELECT {WIDE_SQL} FROM lineitem),
one AS (SELECT [{WIDE_CORR}] AS rs, [{', '.join(repr(a) for a, _ in combinations(WIDE, 2))}] AS fa,
               [{', '.join(repr(b) for _, b in combinations(WIDE, 2))}] AS fb FROM wide),
pairs AS (SELECT unnest(fa) AS feature_a, unnest(fb) AS feature_b, unnest(rs) AS r FROM one)
SELECT feature_a, feature_b, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS corr FROM pairs
""")
def corr_matrix_wide(spark, sf):
    wide = load(spark, sf, "lineitem").selectExpr(*[f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items()])
    return rounded(profile.correlation(wide, list(WIDE), lower_only=True))


@query("high_correlation", with_claims(
    f"SELECT * FROM ({_corr_sql('claims', NULLABLE, 'CAST({c} IS NULL AS DOUBLE)', both=False)}) WHERE abs(corr) > 0.2"))
def high_correlation(spark, sf):
    c = profile.nullity_correlation(claims(spark, sf), NULLABLE)
    return rounded(profile.high_correlation(c, 0.2))


@query("nullity_corr", with_claims(_corr_sql("claims", NULLABLE, "CAST({c} IS NULL AS DOUBLE)", both=False)))
def nullity_corr(spark, sf):
    return rounded(profile.nullity_correlation(claims(spark, sf), NULLABLE))


@query("nullity_distance", with_claims(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
    f"round(sqrt(sum(CAST(({a} IS NULL) <> ({b} IS NULL) AS INTEGER))), 6) AS distance FROM claims"
    for a, b in combinations(NULLABLE, 2))))
def nullity_distance(spark, sf):
    return rounded(profile.nullity_distance(claims(spark, sf), NULLABLE))


def _bins_sql(src: str, bins: int) -> str:
    return f"""
l AS ({src}),
rng AS (SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
               CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM l GROUP BY 1),
b0 AS (SELECT l.feature, value, lo, hi, (hi - lo) / {bins} AS step,
              CAST(floor((value - lo) * ({float(bins)} / (hi - lo))) AS INTEGER) AS i0 FROM l JOIN rng USING (feature)),
b1 AS (SELECT *, CASE WHEN i0 >= {bins} THEN {bins - 1} ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT *, CASE WHEN value < (CASE WHEN i1 >= {bins} THEN hi ELSE i1 * step + lo END) THEN i1 - 1 ELSE i1 END
              AS i2 FROM b1),
b3 AS (SELECT *, CASE WHEN value >= (CASE WHEN i2 + 1 >= {bins} THEN hi ELSE (i2 + 1) * step + lo END)
                       AND i2 != {bins - 1} THEN i2 + 1 ELSE i2 END AS bin FROM b2)"""


@query("histogram", f"""
WITH {_bins_sql(_long_sql('lineitem', ['l_extendedprice', 'l_quantity'], 'DOUBLE'), 30).strip()},
cnt AS (SELECT feature, bin, count(*) AS n FROM b3 GROUP BY 1, 2),
grid AS (SELECT feature, lo, hi, CAST(unnest(range(30)) AS INTEGER) AS bin FROM rng)
SELECT grid.feature, grid.bin, round(grid.bin * ((hi - lo) / 30) + lo, 6) AS lower,
       round(CASE WHEN grid.bin = 29 THEN hi ELSE (grid.bin + 1) * ((hi - lo) / 30) + lo END, 6) AS upper,
       CAST(coalesce(n, 0) AS BIGINT) AS count
FROM grid LEFT JOIN cnt ON cnt.feature = grid.feature AND cnt.bin = grid.bin
""")
def histogram(spark, sf):
    return rounded(profile.histogram(load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], 30))


@query("box_stats", f"""
WITH l AS ({_long_sql('lineitem', ['l_quantity', 'l_extendedprice'], 'DOUBLE')}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM q)
SELECT f.feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(min(CASE WHEN value >= lf AND value <= hf THEN value END), 6) AS lower_whisker,
       round(max(CASE WHEN value >= lf AND value <= hf THEN value END), 6) AS upper_whisker,
       count(*) FILTER (WHERE NOT (value >= lf AND value <= hf)) AS n_outliers
FROM f JOIN l USING (feature) GROUP BY f.feature, q1, median, q3, iqr
""")
def box_stats(spark, sf):
    return rounded(profile.box_stats(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query("median_by_group", with_claims("""
SELECT claim_injury_type, 'age_at_injury' AS feature, round(median(age_at_injury), 6) AS median
FROM claims WHERE age_at_injury IS NOT NULL GROUP BY 1
UNION ALL
SELECT claim_injury_type, 'average_weekly_wage', round(median(average_weekly_wage), 6)
FROM claims WHERE average_weekly_wage IS NOT NULL GROUP BY 1
"""))
def median_by_group(spark, sf):
    return rounded(profile.median_of(claims(spark, sf), ["age_at_injury", "average_weekly_wage"],
                                     ["claim_injury_type"]))


@query("density_curve", """
WITH s AS (SELECT event_type, count(*) AS n, stddev_samp(value) AS sd, min(value) AS mn, max(value) AS mx
           FROM events WHERE value IS NOT NULL GROUP BY 1),
h AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM s),
p AS (SELECT event_type, value AS x, count(*) AS w FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
g AS (SELECT p.*, n, bw, mn, mx, CAST(unnest(range(50)) AS INTEGER) AS i FROM p JOIN h USING (event_type)),
k AS (SELECT event_type, i, mn + i * ((mx - mn) / 49) AS grid_x,
             w * exp(-0.5 * pow((mn + i * ((mx - mn) / 49) - x) / bw, 2)) AS kk, n, bw FROM g)
SELECT event_type, i, round(any_value(grid_x), 6) AS grid_x,
       round(sum(kk) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 6) AS density
FROM k GROUP BY 1, 2
""")
def density_curve(spark, sf):
    return rounded(profile.density_curve(load(spark, sf, "events"), "value", ["event_type"], 50))


@query("class_pairs", with_claims("""
SELECT claim_injury_type, count(*) AS n, round(corr(age_at_injury, average_weekly_wage), 6) AS corr,
       round(avg(age_at_injury), 6) AS mean_age_at_injury, round(avg(average_weekly_wage), 6) AS mean_average_weekly_wage
FROM claims GROUP BY 1
"""))
def class_pairs(spark, sf):
    return rounded(profile.class_pairs(claims(spark, sf), "claim_injury_type", "age_at_injury",
                                       "average_weekly_wage"))


@query("stratified_sample", with_claims("""
SELECT claim_identifier, claim_injury_type FROM claims
WHERE CAST(('0x' || substr(md5('42' || CAST(claim_identifier AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.2
"""))
def stratified_sample(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "claim_injury_type")
    return profile.stratified_sample(c, "claim_identifier", 0.2, 42)


@query("sorted_topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15
""")
def sorted_topk(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return profile.top_k(o, "o_totalprice", "o_orderkey", 15)


# -- joins / set operations / pivots ----------------------------------------------------


@query("county_join", with_claims("""
WITH cnt AS (SELECT upper(substr(county_of_injury, 1, 1)) || lower(substr(county_of_injury, 2)) AS county,
                    count(*) AS claims FROM claims GROUP BY 1),
dim AS (SELECT upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS county, n_regionkey FROM nation)
SELECT cnt.county, dim.n_regionkey, cnt.claims FROM dim RIGHT JOIN cnt ON dim.county = cnt.county
"""))
def county_join(spark, sf):
    cnt = claims(spark, sf).groupBy(capitalize("county_of_injury").alias("county")).agg(
        F.count(F.lit(1)).alias("claims"))
    dim = load(spark, sf, "nation").select(capitalize("n_name").alias("county"), "n_regionkey")
    return profile.join_dimension(F.broadcast(dim), cnt, "county", "right")  # 25-row dimension


@query("membership_flag", """
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
                        THEN 1 ELSE 0 END AS is_member
FROM orders
""")
def membership_flag(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return profile.membership(o, "o_custkey", c, "c_custkey").select("o_orderkey", "is_member")


def _brand_sets(spark, sf):
    p = load(spark, sf, "part")
    a = p.where(F.col("p_size") > 48).select(F.col("p_brand").alias("feature"))
    b = p.where(F.col("p_retailprice") > 998).select(F.col("p_brand").alias("feature"))
    return a, b


SETS_SQL = ("WITH a AS (SELECT p_brand AS feature FROM part WHERE p_size > 48), "
            "b AS (SELECT p_brand AS feature FROM part WHERE p_retailprice > 998) ")


@query("feature_union", SETS_SQL + "SELECT feature FROM a UNION SELECT feature FROM b")
def feature_union(spark, sf):
    a, b = _brand_sets(spark, sf)
    return profile.combine_features(a, b, "union")


@query("feature_intersection", SETS_SQL + "SELECT feature FROM a INTERSECT SELECT feature FROM b")
def feature_intersection(spark, sf):
    a, b = _brand_sets(spark, sf)
    return profile.combine_features(a, b, "intersection")


@query("feature_difference", SETS_SQL + "SELECT DISTINCT feature FROM a WHERE feature NOT IN (SELECT feature FROM b)")
def feature_difference(spark, sf):
    a, b = _brand_sets(spark, sf)
    return profile.feature_difference(a, b)


@query("crosstab", with_claims("SELECT gender, claim_injury_type, count(*) AS count FROM claims GROUP BY 1, 2"))
def crosstab(spark, sf):
    return profile.crosstab(claims(spark, sf), "gender", "claim_injury_type")


@query("pivot_counts", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F, count(*) FILTER (WHERE l_linestatus = 'O') AS O
FROM lineitem GROUP BY 1
""")
def pivot_counts(spark, sf):
    return profile.pivot_counts(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


@query("stats_transposed", "WITH d AS (SELECT feature, CAST(count(value) AS DOUBLE) AS count, avg(value) AS mean, "
       "stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.25) AS q25, "
       "quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max FROM ("
       + _long_sql("lineitem", ["l_quantity", "l_discount"], "DOUBLE") + ") GROUP BY 1) "
       + " UNION ALL ".join(
           f"SELECT '{s}' AS \"column\", round(max({s}) FILTER (WHERE feature = 'l_discount'), 6) AS l_discount, "
           f"round(max({s}) FILTER (WHERE feature = 'l_quantity'), 6) AS l_quantity FROM d" for s in STATS))
def stats_transposed(spark, sf):
    d = profile.describe_numeric(load(spark, sf, "lineitem"), ["l_quantity", "l_discount"])
    return rounded(columns.transpose(d, "feature"))


# -- column discovery ---------------------------------------------------------------------


@query("column_selection", with_claims("""
SELECT accident_date, assembly_date, c_2_date, c_3_date, age_at_injury, birth_year, average_weekly_wage,
       number_of_dependents, ime_4_count, claim_injury_type FROM claims
"""))
def column_selection(spark, sf):
    c = claims(spark, sf)
    target = columns.resolve_column(c, "Claim Injury Type")
    dates = columns.columns_like(c, ["date"])
    nums = columns.numeric_columns(c, exclude=["claim_identifier"])
    feats, _ = columns.features_and_target(c, target)
    keep = [x for x in feats if x in dates or x in nums] + [target]
    return columns.drop_present(columns.project(c, keep), ["not_a_column"], keep=[target])


@query("sanitize_names", with_claims("SELECT * FROM claims"))
def sanitize_names(spark, sf):
    c = claims(spark, sf)
    titled = c.toDF(*[x.replace("_", " ").title().replace("C 2", "C-2").replace("C 3", "C-3") for x in c.columns])
    return columns.sanitize_names(titled)


@query("event_time")
def event_time(spark, sf):
    return columns.add_event_time(claims(spark, sf), "claim_identifier")


# -- quality suites ----------------------------------------------------------------------

ORDER_RULES = [
    {"type": "expect_table_row_count_to_be_between", "min": 1000, "max": 1_000_000_000},
    {"type": "expect_table_columns_to_match_set",
     "columns": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                 "o_comment"], "exact": None},
    {"type": "expect_column_to_exist", "column": "o_orderdate"},
    {"type": "expect_column_values_to_not_be_null", "column": "o_orderkey"},
    {"type": "expect_column_values_to_be_between", "column": "o_totalprice", "min": 1000, "max": 400000},
    {"type": "expect_column_values_to_be_in_set", "column": "o_orderstatus", "value_set": ["F", "O", "P"]},
    {"type": "expect_column_values_to_be_in_set", "column": "o_orderpriority", "value_set": ["1-URGENT", "2-HIGH"]},
]

SUITE_SQL = """
WITH n AS (SELECT count(*) AS n FROM orders),
want(c) AS (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'),
                   ('o_orderpriority'), ('o_comment')),
miss AS (SELECT count(*) AS m FROM want WHERE c NOT IN (SELECT column_name FROM (DESCRIBE orders))),
res AS (
SELECT 'expect_table_columns_to_match_set' AS rule, NULL AS "column", m = 0 AS success, CAST(m AS DOUBLE) AS observed,
       CAST(m AS BIGINT) AS unexpected, CAST((SELECT count(*) FROM want) AS BIGINT) AS total FROM miss
UNION ALL
SELECT 'expect_column_to_exist', 'o_orderdate', true, 1.0, 0, 1
  FROM (SELECT 1) WHERE 'o_orderdate' IN (SELECT column_name FROM (DESCRIBE orders))
UNION ALL
SELECT 'expect_table_row_count_to_be_between', NULL, n >= 1000 AND n <= 1000000000, CAST(n AS DOUBLE), 0, n FROM n
UNION ALL
SELECT 'expect_column_values_to_not_be_null', 'o_orderkey', count(*) FILTER (WHERE o_orderkey IS NULL) = 0,
       round(count(*) FILTER (WHERE o_orderkey IS NULL) * 100.0 / count(*), 6),
       count(*) FILTER (WHERE o_orderkey IS NULL), count(*) FROM orders
UNION ALL
SELECT 'expect_column_values_to_be_between', 'o_totalprice',
       count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) = 0,
       round(count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) * 100.0 / count(o_totalprice), 6),
       count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000), count(*) FROM orders
UNION ALL
SELECT 'expect_column_values_to_be_in_set', 'o_orderstatus',
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) = 0,
       round(count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) * 100.0 / count(o_orderstatus), 6),
       count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')), count(*) FROM orders
UNION ALL
SELECT 'expect_column_values_to_be_in_set', 'o_orderpriority',
       count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) = 0,
       round(count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) * 100.0 / count(o_orderpriority), 6),
       count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')), count(*) FROM orders)
"""


@query("expectation_suite", SUITE_SQL + "SELECT * FROM res")
def expectation_suite(spark, sf):
    _, res = quality.run_suite(load(spark, sf, "orders"), ORDER_RULES)
    return rounded(res)


@query("suite_summary", SUITE_SQL + """
SELECT count(*) AS rules, count(*) FILTER (WHERE NOT coalesce(success, false)) AS failed,
       coalesce(bool_and(coalesce(success, false)), true) AS success FROM res
""")
def suite_summary(spark, sf):
    _, res = quality.run_suite(load(spark, sf, "orders"), ORDER_RULES)
    return quality.suite_summary(res)
