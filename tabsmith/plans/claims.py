"""Table loading and the claims-shaped view over the driver's test tables.

The view has one row per order (``o_orderkey`` is unique) and the column
set/types of the sanitised claims table: dates, nullable ages and birth
years, wages with zero placeholders, a count column, categorical codes and
a five-class target.  ``CLAIMS_SQL`` is the same view as SQL text; the
oracle queries use it as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.sources.io import read_table

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")   # NaN becomes null at every source


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    li = (load(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
               F.count(F.lit(1)).alias("n_lines")))
    age = (F.lit(10) + F.col("o_custkey") % 110).cast("bigint")
    key = F.col("o_orderkey")
    # nation is a fixed 25-row dimension: broadcasting it is size-safe.
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
          .join(li, key == F.col("l_orderkey"), "left"))
    return j.select(
        key.alias("claim_identifier"),
        F.when(key % 20 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("accident_date"),
        F.col("o_orderdate").alias("assembly_date"),
        F.col("first_ship").alias("c_2_date"),
        F.col("last_ship").alias("c_3_date"),
        F.when(key % 10 == 0, F.lit(None)).otherwise(age).alias("age_at_injury"),
        F.when(key % 15 == 0, F.lit(None))
         .otherwise((F.year("o_orderdate") - age).cast("bigint")).alias("birth_year"),
        F.when(key % 7 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("average_weekly_wage"),
        (key % 7).cast("bigint").alias("number_of_dependents"),
        F.col("n_lines").cast("double").alias("ime_4_count"),
        F.col("o_orderstatus").alias("gender"),
        F.col("c_mktsegment").alias("carrier_type"),
        F.col("n_name").alias("county_of_injury"),
        F.concat(F.lit("IC"), (F.col("c_nationkey") % 21).cast("string")).alias("industry_code"),
        F.col("o_orderpriority").alias("claim_injury_type"),
    )


CLAIMS_SQL = """
SELECT o.o_orderkey AS claim_identifier,
       CASE WHEN o.o_orderkey % 20 = 0 THEN NULL ELSE o.o_orderdate END AS accident_date,
       o.o_orderdate AS assembly_date,
       l.first_ship AS c_2_date,
       l.last_ship AS c_3_date,
       CASE WHEN o.o_orderkey % 10 = 0 THEN NULL
            ELSE CAST(10 + o.o_custkey % 110 AS BIGINT) END AS age_at_injury,
       CASE WHEN o.o_orderkey % 15 = 0 THEN NULL
            ELSE CAST(year(o.o_orderdate) - (10 + o.o_custkey % 110) AS BIGINT) END AS birth_year,
       CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice END AS average_weekly_wage,
       CAST(o.o_orderkey % 7 AS BIGINT) AS number_of_dependents,
       CAST(l.n_lines AS DOUBLE) AS ime_4_count,
       o.o_orderstatus AS gender,
       c.c_mktsegment AS carrier_type,
       n.n_name AS county_of_injury,
       'IC' || CAST(c.c_nationkey % 21 AS VARCHAR(10)) AS industry_code,
       o.o_orderpriority AS claim_injury_type
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n_lines
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def with_claims(sql: str) -> str:
    """Prefix an oracle query with the claims view as a CTE."""
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH claims AS ({CLAIMS_SQL}),\n{body[4:]}"
    return f"WITH claims AS ({CLAIMS_SQL})\n{body}"
