"""Catalogue: drift statistics (R1-R12) on lineitem shipped before vs after 1998-06-01."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabsmith.operators import drift
from tabsmith.plans.claims import load
from tabsmith.plans.registry import query, rounded

CUT = "1998-06-01"
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_receiptdays"]
CAT = ["l_returnflag", "l_linestatus", "l_shipmode"]
# l_receiptdays / l_shipmode are configured but absent: they count in total_features only.


def samples(spark, sf):
    li = load(spark, sf, "lineitem")
    before = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    return li.where(before), li.where(~before)


# -- oracle text -------------------------------------------------------------------

NUM_PRESENT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT_PRESENT = ["l_returnflag", "l_linestatus"]


def _long(cols, cast):
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS value, is_ref FROM base WHERE {c} IS NOT NULL"
        for c in cols)


BASE = f"""
base AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 1 ELSE 0 END AS is_ref FROM lineitem),
nl AS ({_long(NUM_PRESENT, 'DOUBLE')}),
g AS (SELECT feature, value, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM nl GROUP BY 1, 2),
cum AS (SELECT feature, value,
          sum(r) OVER (PARTITION BY feature ORDER BY value) / sum(r) OVER (PARTITION BY feature) AS f1,
          sum(c) OVER (PARTITION BY feature ORDER BY value) / sum(c) OVER (PARTITION BY feature) AS f2,
          lead(value) OVER (PARTITION BY feature ORDER BY value) AS nx,
          sum(r) OVER (PARTITION BY feature) AS n_ref, sum(c) OVER (PARTITION BY feature) AS n_cur
        FROM g),
ks0 AS (SELECT feature, max(n_ref) AS n_ref, max(n_cur) AS n_cur, max(abs(f1 - f2)) AS d,
               coalesce(sum(abs(f1 - f2) * (nx - value)), 0) AS w
        FROM cum GROUP BY 1 HAVING max(n_ref) > 0 AND max(n_cur) > 0),
ks AS (SELECT *, d * sqrt(n_ref * n_cur / (n_ref + n_cur)) AS lam FROM ks0),
ksp AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
          list_sum(list_transform(range(1, 101), lambda k: 2.0 * pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)))))
        END AS p FROM ks),
mom AS (SELECT feature, avg(CASE WHEN is_ref = 1 THEN value END) AS rm, avg(CASE WHEN is_ref = 0 THEN value END) AS cm,
               stddev_samp(CASE WHEN is_ref = 1 THEN value END) AS rs,
               stddev_samp(CASE WHEN is_ref = 0 THEN value END) AS cs FROM nl GROUP BY 1),
num AS (SELECT ksp.feature, d AS ks_statistic, p AS p_value, p < 0.05 AS drift_detected,
               rm AS reference_mean, cm AS current_mean, rs AS reference_std, cs AS current_std,
               abs(cm - rm) / (rs + 1e-8) AS mean_drift_magnitude, abs(cs - rs) / (rs + 1e-8) AS std_drift_magnitude,
               CASE WHEN p < 0.01 THEN 'high' WHEN p < 0.05 THEN 'medium' ELSE 'low' END AS drift_severity, w
        FROM ksp JOIN mom USING (feature)),
cl AS ({_long(CAT_PRESENT, 'VARCHAR')}),
cc AS (SELECT feature, value, sum(is_ref) AS o_r, sum(1 - is_ref) AS o_c FROM cl GROUP BY 1, 2),
ct AS (SELECT feature, sum(o_r) AS R, sum(o_c) AS C, count(*) AS k FROM cc GROUP BY 1),
cells AS (SELECT cc.*, R, C, k, R * (o_r + o_c) / (R + C) AS e_r, C * (o_r + o_c) / (R + C) AS e_c
          FROM cc JOIN ct USING (feature)),
chi0 AS (SELECT feature, any_value(R) AS R, any_value(C) AS C, CAST(any_value(k) - 1 AS INTEGER) AS dof,
           sum(pow(CASE WHEN k = 2 THEN greatest(abs(o_r - e_r) - 0.5, 0) ELSE abs(o_r - e_r) END, 2) / e_r
             + pow(CASE WHEN k = 2 THEN greatest(abs(o_c - e_c) - 0.5, 0) ELSE abs(o_c - e_c) END, 2) / e_c) AS chi2,
           max(abs(o_c / C - o_r / R)) AS mpd
         FROM cells GROUP BY 1),
chi1 AS (SELECT feature, R > 0 AND C > 0 AS ok, dof, CASE WHEN dof = 0 THEN 0.0 ELSE chi2 END AS x, mpd FROM chi0),
chi AS (SELECT feature, CASE WHEN ok THEN x END AS chi2_statistic, CASE WHEN ok THEN dof END AS dof,
          CASE WHEN NOT ok THEN NULL WHEN dof = 0 OR x = 0 THEN 1.0 WHEN x / 2 - dof / 2 > 1000 THEN 0.0
               ELSE greatest(0.0, 1.0 - exp(-x / 2 + (dof / 2) * ln(x / 2) - lgamma(dof / 2 + 1))
                 * list_sum(list_transform(range(0, 4000),
                     lambda n: exp(n * ln(x / 2) - (lgamma(dof / 2 + n + 1) - lgamma(dof / 2 + 1)))))) END AS p_value,
          CASE WHEN ok THEN mpd END AS max_proportion_difference,
          CASE WHEN ok THEN 'ok' ELSE 'error' END AS status FROM chi1),
cat AS (SELECT feature, chi2_statistic, dof, p_value, p_value < 0.05 AS drift_detected, max_proportion_difference,
          CASE WHEN p_value IS NULL THEN NULL WHEN p_value < 0.01 THEN 'high' WHEN p_value < 0.05 THEN 'medium'
               ELSE 'low' END AS drift_severity, status FROM chi),
rng AS (SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
               CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
        FROM nl WHERE is_ref = 1 GROUP BY 1),
b0 AS (SELECT nl.feature, value, is_ref, lo, hi, (hi - lo) / 10 AS step,
              CAST(floor((value - lo) * (10.0 / (hi - lo))) AS INTEGER) AS i0
       FROM nl JOIN rng USING (feature) WHERE value >= lo AND value <= hi),
b1 AS (SELECT *, CASE WHEN i0 >= 10 THEN 9 ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT *, CASE WHEN value < (CASE WHEN i1 >= 10 THEN hi ELSE i1 * step + lo END) THEN i1 - 1 ELSE i1 END AS i2
       FROM b1),
b3 AS (SELECT *, CASE WHEN value >= (CASE WHEN i2 + 1 >= 10 THEN hi ELSE (i2 + 1) * step + lo END) AND i2 != 9
                      THEN i2 + 1 ELSE i2 END AS bin FROM b2),
pc AS (SELECT feature, bin, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM b3 GROUP BY 1, 2),
grid AS (SELECT feature, CAST(unnest(range(10)) AS INTEGER) AS bin FROM rng),
pfull AS (SELECT grid.feature, grid.bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c
          FROM grid LEFT JOIN pc ON pc.feature = grid.feature AND pc.bin = grid.bin),
ptot AS (SELECT feature, sum(r) AS r_sum, sum(c) AS c_sum FROM pfull GROUP BY 1),
psi0 AS (SELECT feature, CASE WHEN any_value(c_sum) > 0 THEN
           sum(((c / c_sum + 1e-8) - (r / r_sum + 1e-8)) * ln((c / c_sum + 1e-8) / (r / r_sum + 1e-8))) END AS psi
         FROM pfull JOIN ptot USING (feature) GROUP BY 1),
psi AS (SELECT feature, psi, CASE WHEN psi < 0.1 THEN 'No significant population change'
                                  WHEN psi < 0.25 THEN 'Slight population change'
                                  WHEN psi < 0.5 THEN 'Moderate population change'
                                  ELSE 'Significant population change' END AS interpretation FROM psi0),
dist AS (SELECT psi.feature, psi, interpretation, w AS wasserstein FROM psi JOIN num USING (feature)),
fpos(name, pos) AS (VALUES {', '.join(f"('numerical_{c}', {i})" for i, c in enumerate(NUM))},
                           {', '.join(f"('categorical_{c}', {len(NUM) + i})" for i, c in enumerate(CAT))}),
feat AS (SELECT 'numerical_' || feature AS name, drift_detected, drift_severity FROM num
         UNION ALL SELECT 'categorical_' || feature, drift_detected, drift_severity FROM cat WHERE status = 'ok'),
fp AS (SELECT feat.*, pos FROM feat JOIN fpos USING (name)),
summ AS (SELECT {len(NUM) + len(CAT)} AS total_features, CAST(count(*) AS INTEGER) AS evaluated_features,
           CAST(count(*) FILTER (WHERE drift_detected) AS INTEGER) AS drifted_features,
           CAST(count(*) FILTER (WHERE drift_detected) AS DOUBLE) / {len(NUM) + len(CAT)} AS overall_drift_score,
           CAST(count(*) FILTER (WHERE drift_detected) AS DOUBLE) / {len(NUM) + len(CAT)} * 100 AS drift_percentage,
           coalesce(list(name ORDER BY pos) FILTER (WHERE drift_severity = 'high'), []::VARCHAR[]) AS high_drift_features,
           coalesce(list(name ORDER BY pos) FILTER (WHERE drift_severity = 'medium'), []::VARCHAR[]) AS medium_drift_features,
           coalesce(list(name ORDER BY pos) FILTER (WHERE drift_severity = 'low'), []::VARCHAR[]) AS low_drift_features
         FROM fp),
hpsi AS (SELECT coalesce(list(feature ORDER BY pos), []::VARCHAR[]) AS hp
         FROM (SELECT dist.feature, fpos.pos FROM dist JOIN fpos ON fpos.name = 'numerical_' || dist.feature
               WHERE psi > 0.5)),
alerts AS (SELECT overall_drift_score,
    CASE WHEN overall_drift_score > 0.5 THEN ['{drift.ALERT_HIGH}']
         WHEN overall_drift_score > 0.25 THEN ['{drift.ALERT_MEDIUM}']
         WHEN overall_drift_score > 0.1 THEN ['{drift.ALERT_LOW}'] ELSE []::VARCHAR[] END AS alerts,
    list_concat(list_concat(
      CASE WHEN overall_drift_score > 0.5 THEN {list(drift.RECS_HIGH)}
           WHEN overall_drift_score > 0.25 THEN {list(drift.RECS_MEDIUM)}
           WHEN overall_drift_score > 0.1 THEN {list(drift.RECS_LOW)} ELSE {list(drift.RECS_NONE)} END,
      CASE WHEN len(high_drift_features) > 0
           THEN ['{drift.REC_HIGH_FEATURES}' || array_to_string(high_drift_features, ', ')] ELSE []::VARCHAR[] END),
      CASE WHEN len(hp) > 0 THEN ['{drift.REC_PSI_FEATURES}' || array_to_string(hp, ', ')] ELSE []::VARCHAR[] END)
      AS recommendations,
    summ.*
  FROM summ, hpsi)
"""


def _with(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body


def _r(cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c not in ("feature", "drift_detected", "drift_severity",
                                                        "interpretation", "status", "dof", "value") else c
                     for c in [x.strip() for x in cols.split(",")])


@query("ks_drift", _with(f"SELECT {_r('feature, ks_statistic, p_value, drift_detected, drift_severity')} FROM num"))
def ks_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.numeric_drift(ref, cur, NUM).select(
        "feature", "ks_statistic", "p_value", "drift_detected", "drift_severity"))


MOM = "feature, reference_mean, current_mean, reference_std, current_std, mean_drift_magnitude, std_drift_magnitude"


@query("mean_std_drift", _with(f"SELECT {_r(MOM)} FROM num"))
def mean_std_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.numeric_drift(ref, cur, NUM).select(*[c.strip() for c in MOM.split(",")]))


NUMCOLS = ("feature, ks_statistic, p_value, drift_detected, reference_mean, current_mean, reference_std, "
           "current_std, mean_drift_magnitude, std_drift_magnitude, drift_severity")


@query("numeric_drift", _with(f"SELECT {_r(NUMCOLS)} FROM num"))
def numeric_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.numeric_drift(ref, cur, NUM))


CATCOLS = "feature, chi2_statistic, dof, p_value, drift_detected, max_proportion_difference, drift_severity, status"


@query("chi2_drift", _with(f"SELECT {_r(CATCOLS)} FROM cat"))
def chi2_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.categorical_drift(ref, cur, CAT))


@query("category_proportions", _with("""
SELECT feature, value, round(o_r / R, 6) AS reference_proportion, round(o_c / C, 6) AS current_proportion FROM cells
"""))
def category_proportions(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.category_proportions(ref, cur, CAT))


@query("align_counts", _with("SELECT feature, value, CAST(o_r AS BIGINT) AS ref_count, "
                             "CAST(o_c AS BIGINT) AS cur_count FROM cc"))
def align_counts(spark, sf):
    ref, cur = samples(spark, sf)
    return drift.category_counts(ref, cur, CAT)


@query("psi_drift", _with(f"SELECT {_r('feature, psi, interpretation')} FROM psi"))
def psi_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.psi(ref, cur, NUM))


@query("wasserstein_drift", _with("SELECT feature, round(w, 6) AS wasserstein FROM num"))
def wasserstein_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.ks_wasserstein(ref, cur, NUM).select("feature", "wasserstein"))


@query("distribution_drift", _with(f"SELECT {_r('feature, psi, interpretation, wasserstein')} FROM dist"))
def distribution_drift(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.distribution_drift(ref, cur, NUM))


SUMM = ("total_features, evaluated_features, drifted_features, round(overall_drift_score, 6) AS overall_drift_score, "
        "round(drift_percentage, 6) AS drift_percentage, high_drift_features, medium_drift_features, "
        "low_drift_features")


@query("drift_summary", _with(f"SELECT {SUMM} FROM summ"))
def drift_summary(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.detect_drift(ref, cur, NUM, CAT)["summary"])


@query("drift_alerts", _with("SELECT round(overall_drift_score, 6) AS overall_drift_score, alerts, recommendations "
                             "FROM alerts"))
def drift_alerts(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.detect_drift(ref, cur, NUM, CAT)["alerts"])


@query("drift_report", _with(f"""
SELECT (SELECT count(*) FROM base WHERE is_ref = 1) AS reference_rows,
       CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER) AS reference_columns,
       (SELECT count(*) FROM base WHERE is_ref = 0) AS current_rows,
       CAST((SELECT count(*) FROM (DESCRIBE lineitem)) AS INTEGER) AS current_columns,
       {SUMM}, alerts, recommendations
FROM alerts
"""))
def drift_report(spark, sf):
    ref, cur = samples(spark, sf)
    return rounded(drift.drift_report(ref, cur, NUM, CAT))


@query("drift_dashboard_table", _with("""
SELECT round(overall_drift_score, 6) AS overall_drift_score, total_features, drifted_features,
       round(drift_percentage, 6) AS drift_percentage, recommendations[1] AS first_recommendation FROM alerts
"""))
def drift_dashboard_table(spark, sf):
    from tabsmith.operators.reports import drift_table
    ref, cur = samples(spark, sf)
    return rounded(drift_table(drift.drift_report(ref, cur, NUM, CAT)))


@query("window_drift_stream", """
SELECT CAST(epoch(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS window_start, count(value) AS n,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, true AS ks_in_range
FROM events WHERE value IS NOT NULL GROUP BY 1
""")
def window_drift_stream(spark, sf):
    """Streamed events against all of them, by event-time windows held as state; the last row of each window."""
    from tabsmith.session import scratch_dir
    from tabsmith.streaming.state_drift import drift_window_stream
    events = load(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    path = f"{sf.rstrip('/')}/events.parquet"
    # as a glob, the path may be a single file
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    root = scratch_dir(spark, "window-drift")
    drift_window_stream(stream, events, ["value"], "ts", f"{root}/rows", f"{root}/checkpoint", "7 days").awaitTermination()
    rows = spark.read.parquet(f"{root}/rows")
    last = rows.groupBy("window_start").agg(F.max_by(F.struct("n", "mean", "sd", "ks"), F.struct("batch_id", "final")).alias("s"))
    return rounded(last.select(F.unix_timestamp("window_start").alias("window_start"), "s.n", "s.mean", "s.sd",
                               F.col("s.ks").between(0, 1).alias("ks_in_range")))
