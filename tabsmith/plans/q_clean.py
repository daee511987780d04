"""Catalogue: minimal slice, columns, cleaning, coercion, imputation (S1, P*, C*, T*, I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.functions.dates import components
from tabsmith.functions.scalars import above
from tabsmith.operators import clean, columns, encode, impute
from tabsmith.operators.quantiles import exact_quantiles
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.registry import query, rounded

# -- minimal slice: date parts + frequency encoding + relative price vs exact median


@query("orders_features", """
WITH m AS (SELECT median(o_totalprice) AS med FROM orders),
f AS (SELECT coalesce(o_orderpriority, 'Unknown') AS v,
             count(*) / (SELECT count(*) FROM orders) AS freq
      FROM orders GROUP BY 1)
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
       CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS order_dow,
       o.o_orderpriority,
       round(f.freq, 6) AS enc_priority,
       CASE WHEN o.o_totalprice > m.med THEN 1 ELSE 0 END AS relative_price,
       count(*) AS n_orders
FROM orders o JOIN f ON f.v = coalesce(o.o_orderpriority, 'Unknown'), m
GROUP BY ALL
""")
def orders_features(spark, sf):
    o = load(spark, sf, "orders").select("o_orderdate", "o_orderpriority", "o_totalprice")
    med = exact_quantiles(o.select(F.col("o_totalprice").alias("v")), [], "v", [0.5], ["median"]).first()["median"]
    freq = encode.fit_frequency(o, ["o_orderpriority"])
    parts = components("o_orderdate")
    d = encode.frequency(o, freq, ["o_orderpriority"], prefix="enc_")
    out = (d.select(parts["Year"].alias("order_year"), parts["DayOfWeek"].alias("order_dow"),
                    "o_orderpriority", F.col("enc_o_orderpriority").alias("enc_priority"),
                    above("o_totalprice", med).alias("relative_price"))
             .groupBy("order_year", "order_dow", "o_orderpriority", "enc_priority", "relative_price")
             .agg(F.count(F.lit(1)).alias("n_orders")))
    return rounded(out)


@query("scan_project_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice
FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'
""")
def scan_project_filter(spark, sf):
    li = load(spark, sf, "lineitem")
    return columns.project(clean.filter_rows(li, (F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R")),
                           ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@query("drop_null_rows_cols", with_claims("""
SELECT c_2_date, c_3_date, ime_4_count FROM claims
WHERE NOT (c_2_date IS NULL AND c_3_date IS NULL AND ime_4_count IS NULL)
"""))
def drop_null_rows_cols(spark, sf):
    c = claims(spark, sf).select("c_2_date", "c_3_date", "ime_4_count",
                                 F.lit(None).cast("string").alias("oiics_nature_of_injury_description"))
    return columns.drop_all_null_columns(clean.drop_all_null_rows(c))


@query("dedupe_distinct", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
""")
def dedupe_distinct(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return clean.drop_duplicates(li)


@query("dedupe_drop_all_copies", """
SELECT l_orderkey, l_linenumber, any_value(l_quantity) AS l_quantity, any_value(l_returnflag) AS l_returnflag
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1
""")
def dedupe_drop_all_copies(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return clean.drop_all_copies(li, ["l_orderkey", "l_linenumber"])


@query("dedupe_full_rows", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
GROUP BY ALL HAVING count(*) = 1
""")
def dedupe_full_rows(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return clean.drop_all_copies(li)


@query("duplicate_report", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(sum(n - 1) AS BIGINT) AS duplicated_rows,
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_duplicated_keys,
       round(sum(n - 1) * 100.0 / sum(n), 6) AS duplicated_pct
FROM g
""")
def duplicate_report(spark, sf):
    li = load(spark, sf, "lineitem")
    return clean.duplicate_summary(li, ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity FROM lineitem l
WHERE (l.l_orderkey, l.l_linenumber) IN
      (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY 1 HAVING count(*) > 1)
""")
def duplicate_rows(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return clean.duplicate_rows(li, ["l_orderkey", "l_linenumber"])


@query("limit_range", with_claims("""
SELECT claim_identifier,
       CASE WHEN age_at_injury >= 14 AND age_at_injury <= 90 THEN age_at_injury END AS age_at_injury,
       CASE WHEN birth_year >= 1938 THEN birth_year END AS birth_year
FROM claims
"""))
def limit_range(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "age_at_injury", "birth_year")
    return clean.limit_range(clean.limit_range(c, "age_at_injury", 14, 90), "birth_year", 1938, None)


@query("range_counts", with_claims("""
SELECT count(*) FILTER (WHERE age_at_injury = 0) AS n_zero,
       count(*) FILTER (WHERE age_at_injury < 14) AS n_below,
       count(*) FILTER (WHERE age_at_injury > 90) AS n_above
FROM claims
"""))
def range_counts(spark, sf):
    return clean.range_counts(claims(spark, sf), "age_at_injury", 14, 90)


OUTLIER_SQL = """
SELECT claim_identifier, age_at_injury, average_weekly_wage, birth_year, ime_4_count FROM claims
WHERE (age_at_injury <= 90 OR age_at_injury IS NULL)
  AND (average_weekly_wage < 100000 OR average_weekly_wage IS NULL)
  AND (birth_year > 1938 OR birth_year IS NULL)
  AND ime_4_count < 40
"""


@query("outlier_filter", with_claims(OUTLIER_SQL))
def outlier_filter(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "age_at_injury", "average_weekly_wage",
                                 "birth_year", "ime_4_count")
    return clean.remove_outliers(c)


@query("outlier_reduction", with_claims(f"""
SELECT CAST((SELECT count(*) FROM claims) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM ({OUTLIER_SQL})) AS BIGINT) AS rows_after,
       round(((SELECT count(*) FROM claims) - (SELECT count(*) FROM ({OUTLIER_SQL}))) * 100.0
             / (SELECT count(*) FROM claims), 6) AS reduction_pct
"""))
def outlier_reduction(spark, sf):
    return clean.reduction_report(claims(spark, sf), clean.outlier_condition())


@query("replace_values", with_claims("""
SELECT claim_identifier,
       CASE WHEN gender IN ('P') THEN 'Unknown' ELSE gender END AS gender,
       CASE WHEN carrier_type IN ('AUTOMOBILE', 'FURNITURE') THEN 'HOUSEHOLD' ELSE carrier_type END AS carrier_type
FROM claims
"""))
def replace_values(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "gender", "carrier_type")
    c = clean.replace_values(c, ["gender"], {"P": "Unknown"})
    return clean.replace_values(c, ["carrier_type"], {"AUTOMOBILE": "HOUSEHOLD", "FURNITURE": "HOUSEHOLD"})


@query("fd_check", """
SELECT p_brand, count(DISTINCT p_type) AS n_values FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1
""")
def fd_check(spark, sf):
    return clean.dependency_violations(load(spark, sf, "part"), "p_brand", "p_type")


@query("incoherent_ages", with_claims("""
SELECT claim_identifier, age_at_injury, birth_year FROM claims
WHERE abs((year(c_2_date) - birth_year) - age_at_injury) > 1
"""))
def incoherent_ages(spark, sf):
    c = claims(spark, sf)
    computed = F.year("c_2_date") - F.col("birth_year")
    return clean.incoherent_rows(c, computed, F.col("age_at_injury"), 1) \
                .select("claim_identifier", "age_at_injury", "birth_year")


@query("class_balance", with_claims("""
WITH g AS (SELECT claim_injury_type, count(*) AS n FROM claims GROUP BY 1)
SELECT claim_injury_type, n, round(n / sum(n) OVER (), 6) AS share,
       round(min(n) OVER () / max(n) OVER (), 6) AS min_max_ratio FROM g
"""))
def class_balance(spark, sf):
    return rounded(clean.class_balance(claims(spark, sf), "claim_injury_type"))


@query("coerce_types", """
SELECT event_id,
       TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS ts_parsed,
       TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE replace(replace(props, '{"k": ', ''), '}', '') END AS DOUBLE) AS k_value,
       coalesce(CAST(CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS VARCHAR), 'nan') AS user_text,
       CAST(floor(value) AS BIGINT) AS value_floor
FROM events
""")
def coerce_types(spark, sf):
    e = load(spark, sf, "events")
    raw = e.select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.lit("not a date"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_parsed"),
        F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
         .otherwise(F.replace(F.replace("props", F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit(""))).alias("k_value"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_text"),
        F.floor("value").cast("double").alias("value_floor"))
    out = clean.to_timestamp_lenient(raw, ["ts_parsed"])
    out = clean.to_number_lenient(out, ["k_value"])
    out = clean.to_text(out, ["user_text"], null_text="nan")
    return clean.to_bigint(out, ["value_floor"])


@query("preprocess_raw", """
SELECT event_id,
       TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS event_date,
       TRY_CAST(CASE WHEN event_id % 9 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS event_count,
       event_type AS county
FROM events
""")
def preprocess_raw(spark, sf):
    e = load(spark, sf, "events")
    raw = e.select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.lit("bad"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_date"),
        F.when(F.col("event_id") % 9 == 0, F.lit("x"))
         .otherwise(F.col("value").cast("string")).alias("event_count"),
        F.col("event_type").alias("county"),
        F.lit(None).cast("string").alias("empty_column"))
    return clean.preprocess(raw)


# -- imputation ----------------------------------------------------------------


@query("impute_median", with_claims("""
SELECT claim_identifier,
       coalesce(CAST(age_at_injury AS DOUBLE), (SELECT median(age_at_injury) FROM claims)) AS age_at_injury,
       round(coalesce(CASE WHEN average_weekly_wage = 0 THEN NULL ELSE average_weekly_wage END,
                (SELECT median(CASE WHEN average_weekly_wage = 0 THEN NULL ELSE average_weekly_wage END) FROM claims)), 6)
         AS average_weekly_wage
FROM claims
"""))
def impute_median(spark, sf):
    c = claims(spark, sf).select(
        "claim_identifier", F.col("age_at_injury").cast("double").alias("age_at_injury"),
        F.when(F.col("average_weekly_wage") != 0, F.col("average_weekly_wage")).alias("average_weekly_wage"))
    meds = impute.fit_medians(c, ["age_at_injury", "average_weekly_wage"])
    return rounded(impute.fill_from(c, meds))


@query("fill_from_other", with_claims("""
SELECT claim_identifier, coalesce(accident_date, assembly_date) AS accident_date,
       coalesce(ime_4_count, 0) AS ime_4_count, coalesce(c_3_date, c_2_date) AS c_3_date
FROM claims
"""))
def fill_from_other(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "accident_date", "assembly_date", "ime_4_count",
                                 "c_2_date", "c_3_date")
    c = impute.fill_from_column(c, "accident_date", "assembly_date")
    c = impute.fill_from_column(c, "c_3_date", "c_2_date")
    c = impute.fill_constant(c, {"ime_4_count": 0.0})
    return c.drop("assembly_date", "c_2_date")


@query("derive_year_fields", with_claims("""
SELECT claim_identifier,
       coalesce(age_at_injury, CAST(year(accident_date) - birth_year AS BIGINT)) AS age_at_injury,
       coalesce(birth_year, CAST(year(accident_date) - age_at_injury AS BIGINT)) AS birth_year
FROM claims
"""))
def derive_year_fields(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "accident_date", "age_at_injury", "birth_year")
    c = impute.derive_age(c, "age_at_injury", "accident_date", "birth_year", out="_age")
    c = impute.derive_birth_year(c, "birth_year", "accident_date", "age_at_injury", out="_by")
    return c.select("claim_identifier", F.col("_age").alias("age_at_injury"),
                    F.col("_by").alias("birth_year"))


@query("cast_types", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts,
       CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS price_int
FROM orders
""")
def cast_types(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"), "o_custkey",
        F.floor("o_totalprice").cast("double").alias("price_int"))
    return clean.cast_types(o, ["order_ts"], ["o_custkey"], ["price_int"])
