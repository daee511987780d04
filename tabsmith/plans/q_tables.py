"""Catalogue: feature tables (F1-F5), sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators import encode, models, profile, select, table_stats, tables
from tabsmith.plans.claims import claims, load, with_claims
from tabsmith.plans.registry import query, rounded
from tabsmith.session import scratch_dir
from tabsmith.sources import io

GROUPS = [
    {"name": "personal_information", "columns": ["age_at_injury", "birth_year", "gender"],
     "features_desc": {"age_at_injury": "age of the worker at the accident"}},
    {"name": "financial_features", "columns": ["average_weekly_wage", "number_of_dependents", "ime_4_count"]},
    {"name": "dates", "columns": ["accident_date", "assembly_date", "c_2_date", "hearing_date"]},
    {"name": "medical_case_processing", "columns": ["wcio_part_of_body_code", "wcio_nature_of_injury_code"]},
]
GROUP_SUITES = {"personal_information_expectations": [
    {"type": "expect_column_values_to_be_between", "column": "age_at_injury", "min": 16, "max": 100}]}


@query("feature_group_tables", with_claims("""
SELECT group_name, version, status, n_features, n_missing,
       CASE WHEN status = 'created' THEN (SELECT count(*) FROM claims) END AS rows,
       CASE group_name WHEN 'personal_information' THEN (SELECT count(*) FILTER (WHERE age_at_injury < 16 OR age_at_injury > 100) = 0 FROM claims)
       END AS validation_passed
FROM (VALUES ('personal_information', 1, 'created', 3, 0),
             ('financial_features', 1, 'created', 3, 0),
             ('dates', 1, 'created', 3, 1),
             ('medical_case_processing', 1, 'skipped', 0, 2)) v(group_name, version, status, n_features, n_missing)
"""))
def feature_group_tables(spark, sf):
    c = claims(spark, sf)
    status = tables.create_feature_tables(c, "claim_identifier", GROUPS, scratch_dir(spark, "feature-store"),
                                          suites=GROUP_SUITES)
    return status.select("group_name", "version", "status", "n_features",
                         F.size("missing_columns").alias("n_missing"), "rows", "validation_passed")


@query("feature_group_append", with_claims("""
SELECT claim_identifier, average_weekly_wage, number_of_dependents, ime_4_count FROM claims
UNION ALL
SELECT claim_identifier, average_weekly_wage, number_of_dependents, ime_4_count FROM claims
"""))
def feature_group_append(spark, sf):
    from tabsmith.operators.columns import add_event_time
    c = claims(spark, sf)
    root = scratch_dir(spark, "feature-store")
    g = GROUPS[1]
    tables.create_feature_group(c, "claim_identifier", g, root)
    more = add_event_time(c.select("claim_identifier", *g["columns"]), "claim_identifier")
    tables.insert_rows(more, root, g["name"], 1)
    return tables.read_group(spark, root, g["name"], 1).select(
        "claim_identifier", "average_weekly_wage", "number_of_dependents", "ime_4_count")


@query("feature_group_stats", with_claims("""
WITH l AS (SELECT 'average_weekly_wage' AS feature, average_weekly_wage AS value FROM claims
           WHERE average_weekly_wage IS NOT NULL
           UNION ALL SELECT 'ime_4_count', ime_4_count FROM claims WHERE ime_4_count IS NOT NULL)
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max FROM l GROUP BY 1
"""))
def feature_group_stats(spark, sf):
    stats = tables.table_statistics(claims(spark, sf), ["average_weekly_wage", "ime_4_count"])
    return rounded(stats["describe"])


STATS = ["average_weekly_wage", "number_of_dependents", "ime_4_count"]


@query("feature_group_merged_stats", with_claims(f"""
WITH l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM claims WHERE {c} IS NOT NULL" for c in STATS)}),
s AS (SELECT feature, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS mn, max(v) AS mx, count(DISTINCT v) AS d FROM l GROUP BY 1),
w AS (SELECT *, pow(2.0, greatest(ceil(log2((mx - mn) / 32)), ceil(log2(greatest(abs(mn), abs(mx)))) - 50)) AS width FROM s),
b AS (SELECT feature, floor(v / width) * width AS lower, count(*) AS count FROM l JOIN w USING (feature) GROUP BY 1, 2)
SELECT 'describe' AS part, feature, stat AS detail, round(value, 6) AS value FROM (
  SELECT feature, unnest(['count', 'mean', 'std', 'min', 'max']) AS stat, unnest([CAST(n AS DOUBLE), mean, std, mn, mx]) AS value FROM s)
UNION ALL SELECT 'histogram', feature, CAST(CAST(lower AS BIGINT) AS VARCHAR), CAST(count AS DOUBLE) FROM b
UNION ALL SELECT 'sketches', feature, 'within their errors', 1.0 FROM s
UNION ALL SELECT 'correlation', feature_a, feature_b, corr FROM (
{' UNION ALL '.join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM claims" for i, a in enumerate(STATS) for b in STATS[i + 1:])})
"""))
def feature_group_merged_stats(spark, sf):
    """a group written in three parts; its statistics are merged from those of the parts."""
    c = claims(spark, sf).withColumn("third", F.pmod(F.xxhash64("claim_identifier"), F.lit(3)))
    root = scratch_dir(spark, "feature-store")
    tables.create_feature_group(c.where("third = 0"), "claim_identifier", GROUPS[1], root)
    for k in (1, 2):
        tables.insert_rows(c.where(F.col("third") == k).select("claim_identifier", *STATS), root, GROUPS[1]["name"])
    got = table_stats.read_statistics(spark, root, GROUPS[1]["name"], 1)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("detail"), F.col(k).cast("double").alias("value")) for k in ("count", "mean", "std", "min", "max")]))
    describe = got["describe"].select(F.lit("describe").alias("part"), "feature", kinds.alias("s")).select("part", "feature", "s.*")
    bars = got["histogram"].select(F.lit("histogram").alias("part"), "feature", F.col("lower").cast("long").cast("string").alias("detail"),
                                   F.col("count").cast("double").alias("value"))
    corr = got["correlation"].select(F.lit("correlation").alias("part"), F.col("feature_a").alias("feature"), F.col("feature_b").alias("detail"),
                                     F.col("corr").alias("value"))
    # sketches against all rows: distinct values within 5 %, the median's rank within 2 % of the rows
    true = c.agg(*[F.count_distinct(x).alias(f"d_{x}") for x in STATS], *[F.count(x).alias(f"n_{x}") for x in STATS])
    mid = {r["feature"]: r for r in got["describe"].select("feature", "approx_distinct", "approx_q50").collect()}
    below = c.agg(*[F.count_if(F.col(x) < mid[x]["approx_q50"]).alias(f"b_{x}") for x in STATS],
                  *[F.count_if(F.col(x) <= mid[x]["approx_q50"]).alias(f"u_{x}") for x in STATS])
    lines = [F.struct(F.lit(x).alias("feature"), F.lit("within their errors").alias("detail"), (
        (F.abs(F.col(f"d_{x}") - mid[x]["approx_distinct"]) <= 0.05 * F.col(f"d_{x}")) & (F.col(f"b_{x}") <= 0.52 * F.col(f"n_{x}"))
        & (F.col(f"u_{x}") >= 0.48 * F.col(f"n_{x}"))).cast("double").alias("value")) for x in STATS]
    sketches = true.crossJoin(F.broadcast(below)).select(F.lit("sketches").alias("part"), F.explode(F.array(*lines)).alias("s")).select("part", "s.*")   # one row each
    return rounded(describe.unionByName(bars).unionByName(sketches).unionByName(corr))


@query("feature_group_histogram", with_claims(f"""
WITH c AS (SELECT average_weekly_wage AS v FROM claims WHERE average_weekly_wage IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM c),
b AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 10)) AS INTEGER), 9) AS bin FROM c, r)
SELECT 'average_weekly_wage' AS feature, CAST(i AS INTEGER) AS bin, count(b.bin) AS count FROM range(10) t(i) LEFT JOIN b ON b.bin = t.i GROUP BY i
"""))
def feature_group_histogram(spark, sf):
    """the histogram part of a table's statistics."""
    stats = tables.table_statistics(claims(spark, sf), ["average_weekly_wage"])
    return stats["histogram"].select("feature", "bin", "count")


@query("feature_descriptions", with_claims("SELECT claim_identifier, age_at_injury, gender FROM claims"))
def feature_descriptions(spark, sf):
    c = claims(spark, sf).select("claim_identifier", "age_at_injury", "gender")
    out = tables.describe_features(c, {"age_at_injury": "age of the worker at the accident",
                                       "gender": "recorded gender"})
    assert out.schema["age_at_injury"].metadata.get("comment")
    return out


LI_SCHEMA = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                          T.StructField("l_quantity", T.DoubleType()), T.StructField("l_returnflag", T.StringType())])


@query("csv_roundtrip", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def csv_roundtrip(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = io.write_table(li, scratch_dir(spark, "csv"), fmt="csv")
    return io.read_csv(spark, path, LI_SCHEMA, key="l_orderkey")


@query("table_roundtrip", "SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders")
def table_roundtrip(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    path = io.write_table(o, scratch_dir(spark, "table"), partition_by=["o_orderpriority"])
    return io.read_table(spark, path).select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")


@query("params_roundtrip", with_claims("""
SELECT 'carrier_type' AS feature, coalesce(carrier_type, 'Unknown') AS value,
       round(count(*) / (SELECT count(*) FROM claims), 6) AS freq FROM claims GROUP BY 2
"""))
def params_roundtrip(spark, sf):
    m = encode.fit_frequency(claims(spark, sf), ["carrier_type"])
    path = io.save_params(m, scratch_dir(spark, "params"))
    return rounded(io.load_params(spark, path))


@query("report_roundtrip", with_claims("""
WITH g AS (SELECT claim_injury_type, count(*) AS n_c FROM claims GROUP BY 1)
SELECT claim_injury_type, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS class_weight FROM g
"""))
def report_roundtrip(spark, sf):
    w = select.class_weights(claims(spark, sf), "claim_injury_type")
    path = io.write_report(w, scratch_dir(spark, "report"))
    return rounded(io.read_report(spark, path, T.StructType([T.StructField("claim_injury_type", T.StringType()),
                                                             T.StructField("class_weight", T.DoubleType())])))


@query("results_append", with_claims("""
SELECT 'run_1' AS run, count(*) AS rows FROM claims UNION ALL SELECT 'run_2', count(*) FROM claims
"""))
def results_append(spark, sf):
    path = scratch_dir(spark, "results")
    c = claims(spark, sf)
    for run in ("run_1", "run_2"):
        io.append_results(profile.shape(c).select(F.lit(run).alias("run"), "rows"), path)
    return spark.read.parquet(path)


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    from tabsmith.plans.model_input import KEY, model_frame
    d, feats, label, k = model_frame(spark, sf)
    m = models.train_forest(d.where(F.col("split") == "train"), feats, label, {"n_estimators": 20, "max_depth": 5})
    path = io.save_model(m, scratch_dir(spark, "model"))
    return models.predictions(io.load_model(path), d.where(F.col("split") == "test"), label, k, key=KEY)
