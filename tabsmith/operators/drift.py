"""Drift statistics between a reference and a current frame.

Only what needs an order sorts anything:

* moments (R2), ranges and row counts are one wide aggregate of each sample;
* PSI (R4) bins the raw values against the reference range of their feature:
  a partial aggregate of at most bins x features rows for each task;
* chi-square (R3) aggregates (feature, category) counts and joins the
  per-feature totals (one row per feature);
* KS (R1) and Wasserstein (R5) share bucket totals of both samples and order
  only the values of the buckets that these leave open (``operators.ecdf``).

Test-statistic tails run on the one-row-per-feature tables.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.scalars import interpret_psi, severity
from tabsmith.functions.stats import chi2_sf, ks_pvalue
from tabsmith.operators import ecdf
from tabsmith.session import materialize

EPS_STD = 1e-8
EPS_PSI = 1e-8
P_THRESHOLD = 0.05
PSI_BINS = 10
# Fixed texts of the drift report (thresholds 0.5 / 0.25 / 0.1 on the overall score).
ALERT_HIGH = "HIGH_DRIFT_ALERT: More than 50% of features show significant drift"
ALERT_MEDIUM = "MEDIUM_DRIFT_ALERT: Significant drift detected in multiple features"
ALERT_LOW = "LOW_DRIFT_ALERT: Minor drift detected"
RECS_HIGH = ["Consider retraining the model with updated data",
             "Investigate data quality issues in drifted features"]
RECS_MEDIUM = ["Monitor model performance closely", "Consider feature engineering adjustments"]
RECS_LOW = ["Continue monitoring for trend changes"]
RECS_NONE = ["No significant drift detected - model should perform well"]
REC_HIGH_FEATURES = "High-drift features requiring attention: "
REC_PSI_FEATURES = "Features with significant distribution changes: "


def _present(ref: DataFrame, cur: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in ref.columns and c in cur.columns]


def _value(c: str):
    """The column as a double, NaN as null."""
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def side_stats(ref: DataFrame, cur: DataFrame, cols: list[str], sketched: bool = False) -> DataFrame:
    """``(is_ref, feature, n_rows, n, mean, sd, mn, mx)``: a row for each sample and numeric
    feature of both, plus one without a feature that counts the rows.  One wide
    aggregate of each sample: the rows are neither exploded nor shuffled.
    ``sketched`` adds ``q``, the quantiles that ``ecdf.splitters`` takes."""
    cols = _present(ref, cur, cols)

    def side(df, is_ref):
        x = df.select(*[_value(c).alias(f"x{i}") for i, c in enumerate(cols)])
        row = x.agg(F.count(F.lit(1)).alias("n_rows"), *[e for i in range(len(cols)) for e in (
            F.count(f"x{i}").alias(f"n{i}"), F.avg(f"x{i}").alias(f"a{i}"), F.stddev_samp(f"x{i}").alias(f"s{i}"),
            F.min(f"x{i}").alias(f"l{i}"), F.max(f"x{i}").alias(f"h{i}"),
            *([ecdf.sketch_columns(f"x{i}")[-1].alias(f"q{i}")] if sketched else []))])
        lines = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("sd"),
                          F.col(f"l{i}").alias("mn"), F.col(f"h{i}").alias("mx"),
                          *([F.col(f"q{i}").alias("q")] if sketched else [])) for i, c in enumerate(cols)]
        none = F.lit(None).cast("double")
        lines.append(F.struct(F.lit(None).cast("string").alias("feature"), F.col("n_rows").alias("n"), none.alias("mean"),
                              none.alias("sd"), none.alias("mn"), none.alias("mx"),
                              *([F.lit(None).cast("array<double>").alias("q")] if sketched else [])))
        return row.select(F.lit(is_ref).alias("is_ref"), "n_rows", F.explode(F.array(*lines)).alias("f")).select("is_ref", "n_rows", "f.*")

    return side(ref, True).unionByName(side(cur, False))


def _long(ref: DataFrame, cur: DataFrame, items) -> DataFrame:
    """``(items..., is_ref)``: one row for each struct of ``items`` of both samples."""
    def side(df, is_ref):
        return df.select(F.explode(F.array(*items)).alias("kv"), F.lit(is_ref).alias("is_ref")).select("kv.*", "is_ref")
    return side(ref, 1).unionByName(side(cur, 0))


def value_counts(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, value, r, c)``: the distinct numbers of each feature with their counts in both samples."""
    cols = _present(ref, cur, cols)
    if not cols:
        return ref.sparkSession.createDataFrame([], "feature string, value double, r bigint, c bigint")
    items = [F.struct(F.lit(c).alias("feature"), _value(c).alias("value")) for c in cols]
    return (_long(ref, cur, items).where(F.col("value").isNotNull()).groupBy("feature", "value")
            .agg(F.sum("is_ref").cast("bigint").alias("r"), F.sum(1 - F.col("is_ref")).cast("bigint").alias("c")))


def row_counts(stats: DataFrame) -> DataFrame:
    """(reference_rows, current_rows) from ``side_stats``."""
    rows = stats.where(F.col("feature").isNull())
    return rows.agg(F.max(F.when(F.col("is_ref"), F.col("n_rows"))).alias("reference_rows"),
                    F.max(F.when(~F.col("is_ref"), F.col("n_rows"))).alias("current_rows"))


def sample_totals(ref: DataFrame, cur: DataFrame, cols: list[str], stats: DataFrame, bins: int = PSI_BINS) -> ecdf.Totals:
    """Bucket totals that KS, Wasserstein and PSI share: the PSI edges are splitters.  ``stats``: sketched side statistics."""
    cols = _present(ref, cur, cols)
    rows = stats.where(F.col("feature").isNotNull()).collect()   # two for each feature
    found = [[{"n": r["n"], "mx": r["mx"], "q": r["q"]} for r in rows if r["feature"] == c and r["q"]] for c in cols]
    low = {r["feature"]: (r["mn"], r["mx"]) for r in rows if r["is_ref"] and r["mn"] is not None}
    return ecdf.Totals(ref, cur, cols, found, edges=[_psi_edges(*low[c], bins) if c in low else [] for c in cols])


def _psi_edges(mn: float, mx: float, bins: int) -> list[float]:
    """Bin edges of numpy's ``histogram``; the last is the next double, as the top bin is closed."""
    lo, hi = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
    step = (hi - lo) / bins
    return [lo, *[i * step + lo for i in range(1, bins)], math.nextafter(hi, math.inf)]


def psi_of_totals(totals: ecdf.Totals, stats: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """R4 from the bucket totals of ``sample_totals``."""
    rows = []
    for r in stats.where(F.col("is_ref") & F.col("mn").isNotNull()).collect():
        ref, cur = totals.between(totals.cols.index(r["feature"]), np.array(_psi_edges(r["mn"], r["mx"], bins)))
        seen, value = (ref > 0) | (cur > 0), None
        if cur.sum():
            a, b = ref[seen] / ref.sum() + EPS_PSI, cur[seen] / cur.sum() + EPS_PSI
            value = float(((b - a) * np.log(b / a)).sum())
        rows.append((r["feature"], value))
    return totals.spark.createDataFrame(rows, "feature string, psi double").withColumn("interpretation", interpret_psi(F.col("psi")))


def ks_wasserstein(ref: DataFrame, cur: DataFrame, cols: list[str], totals: ecdf.Totals | None = None) -> DataFrame:
    """R1 + R5: (feature, n_ref, n_cur, ks_statistic, wasserstein), exact, from bucket totals (``operators.ecdf``)."""
    return ecdf.ks_wasserstein(ref, cur, _present(ref, cur, cols), totals=totals)


def moments(ref: DataFrame, cur: DataFrame, cols: list[str], stats: DataFrame | None = None) -> DataFrame:
    """R2 inputs: mean and sample std of each side, per feature."""
    st = (stats if stats is not None else side_stats(ref, cur, cols)).where(F.col("feature").isNotNull())

    def of(c, is_ref):
        return F.max(F.when(F.col("is_ref") == is_ref, F.col(c)))   # one row for each side
    return st.groupBy("feature").agg(of("mean", True).alias("reference_mean"), of("mean", False).alias("current_mean"),
                                     of("sd", True).alias("reference_std"), of("sd", False).alias("current_std"))


def numeric_drift(ref: DataFrame, cur: DataFrame, cols: list[str], threshold: float = P_THRESHOLD,
                  ks: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """R11 (numeric half): KS statistic/p-value, moments, drift magnitudes, severity.

    Features with an empty side are left out (as the reference does).
    """
    ks = (ks if ks is not None else ks_wasserstein(ref, cur, cols)).where(
        (F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    m = moments(ref, cur, cols, stats)
    j = ks.join(m, "feature")
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    den = F.col("reference_std") + F.lit(EPS_STD)
    return j.select(
        "feature", "ks_statistic", p.alias("p_value"),
        (p < threshold).alias("drift_detected"),
        "reference_mean", "current_mean", "reference_std", "current_std",
        (F.abs(F.col("current_mean") - F.col("reference_mean")) / den).alias("mean_drift_magnitude"),
        (F.abs(F.col("current_std") - F.col("reference_std")) / den).alias("std_drift_magnitude"),
        severity(p).alias("drift_severity"))


def category_counts(ref: DataFrame, cur: DataFrame, cols: list[str], counts: DataFrame | None = None) -> DataFrame:
    """Aligned counts per (feature, category): categories of either side, 0-filled."""
    if counts is not None:
        return counts
    cols = _present(ref, cur, cols)
    if not cols:
        return ref.sparkSession.createDataFrame([], "feature string, value string, ref_count bigint, cur_count bigint")
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    return (_long(ref, cur, items).where(F.col("value").isNotNull()).groupBy("feature", "value")
            .agg(F.sum("is_ref").cast("bigint").alias("ref_count"), F.sum(1 - F.col("is_ref")).cast("bigint").alias("cur_count")))


def category_proportions(ref: DataFrame, cur: DataFrame, cols: list[str],
                         counts: DataFrame | None = None) -> DataFrame:
    """Per (feature, category): reference and current proportions (long table)."""
    cnt = category_counts(ref, cur, cols, counts)
    tot = cnt.groupBy("feature").agg(F.sum("ref_count").alias("R"), F.sum("cur_count").alias("C"))
    j = cnt.join(F.broadcast(tot), "feature")  # one row per feature
    return j.select("feature", "value", F.try_divide("ref_count", "R").alias("reference_proportion"),
                    F.try_divide("cur_count", "C").alias("current_proportion"))


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: list[str], threshold: float = P_THRESHOLD,
                      counts: DataFrame | None = None) -> DataFrame:
    """Chi-square test of homogeneity on the 2 x k table of each feature.

    Yates' correction when dof = 1; dof = 0 gives chi2 = 0, p = 1.  A feature
    with an empty side cannot be tested: its statistics are null and
    ``status = 'error'``.
    """
    cnt = category_counts(ref, cur, cols, counts)
    tot = cnt.groupBy("feature").agg(F.sum("ref_count").alias("R"), F.sum("cur_count").alias("C"),
                                     F.count(F.lit(1)).alias("k"))
    j = cnt.join(F.broadcast(tot), "feature")  # one row per feature: bounded
    n = F.col("R") + F.col("C")
    col_tot = F.col("ref_count") + F.col("cur_count")
    e_ref, e_cur = F.col("R") * col_tot / n, F.col("C") * col_tot / n

    def term(o, e):
        d = F.abs(F.col(o) - e)
        d = F.when(F.col("k") == 2, F.greatest(d - 0.5, F.lit(0.0))).otherwise(d)
        return F.try_divide(d * d, e)   # e = 0 only when a side is empty (reported as error)

    cell = j.select("feature", "R", "C", "k",
                    (term("ref_count", e_ref) + term("cur_count", e_cur)).alias("contrib"),
                    F.abs(F.try_divide("cur_count", "C") - F.try_divide("ref_count", "R")).alias("diff"))
    per = cell.groupBy("feature").agg(
        F.first("R").alias("R"), F.first("C").alias("C"), F.first("k").alias("k"),
        F.sum("contrib").alias("chi2"), F.max("diff").alias("max_proportion_difference"))
    ok = (F.col("R") > 0) & (F.col("C") > 0)
    dof = (F.col("k") - 1).cast("int")
    chi2 = F.when(ok, F.when(dof == 0, F.lit(0.0)).otherwise(F.col("chi2")))
    with_stat = per.select("feature", chi2.alias("chi2_statistic"), F.when(ok, dof).alias("dof"),
                           F.when(ok, F.col("max_proportion_difference")).alias("max_proportion_difference"),
                           F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("status"))
    p = F.when(F.col("status") == "ok", chi2_sf(F.col("chi2_statistic"), F.col("dof")))
    return with_stat.select(
        "feature", "chi2_statistic", "dof", p.alias("p_value"),
        F.when(p.isNotNull(), p < threshold).alias("drift_detected"),
        "max_proportion_difference",
        F.when(p.isNotNull(), severity(p)).alias("drift_severity"), "status")


def psi(ref: DataFrame, cur: DataFrame, cols: list[str], bins: int = PSI_BINS,
        stats: DataFrame | None = None) -> DataFrame:
    """Population stability index on ``bins`` equal-width bins of the reference range.

    Bin edges follow numpy's ``histogram``: a constant reference uses
    [v - 0.5, v + 0.5]; the last bin is closed; current values outside the
    range are dropped; an empty in-range current sample gives null.
    """
    cols = _present(ref, cur, cols)
    if not cols:
        return ref.sparkSession.createDataFrame([], "feature string, psi double, interpretation string")
    st = stats if stats is not None else side_stats(ref, cur, cols)
    rng = (st.where(F.col("is_ref") & F.col("feature").isNotNull() & F.col("mn").isNotNull())
             .select("feature",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi")))
    items = [F.struct(F.lit(c).alias("feature"), _value(c).alias("value")) for c in cols]
    inrange = (_long(ref, cur, items).join(F.broadcast(with_edges(rng, bins)), "feature")  # one row per feature: bounded
                .where((F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))))
    binned = with_bin(inrange, F.col("value"), bins).select("feature", "bin", "is_ref")
    counts_b = binned.groupBy("feature", "bin").agg(F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c"))
    # bins empty on both sides add (eps - eps) * ln(1) = 0, so only observed bins are summed
    fw = Window.partitionBy("feature")   # <= bins rows per feature
    j = counts_b.withColumn("r_sum", F.sum("r").over(fw)).withColumn("c_sum", F.sum("c").over(fw))
    p_ref = F.col("r") / F.col("r_sum") + EPS_PSI
    p_cur = F.when(F.col("c_sum") > 0, F.col("c") / F.col("c_sum") + EPS_PSI)
    term = (p_cur - p_ref) * F.log(p_cur / p_ref)
    out = j.groupBy("feature").agg(F.sum(term).alias("psi"), F.min("c_sum").alias("_c"))
    return out.select("feature", F.when(F.col("_c") > 0, F.col("psi")).alias("psi"),
                      interpret_psi(F.when(F.col("_c") > 0, F.col("psi"))).alias("interpretation"))


def with_edges(rng: DataFrame, bins: int) -> DataFrame:
    """Add the interior bin edges ``lo + i*step`` (i = 1..bins-1), numpy's linspace values."""
    step = (F.col("hi") - F.col("lo")) / bins
    return rng.withColumn("_edges", F.array(*[F.lit(float(i)) * step + F.col("lo") for i in range(1, bins)]))


def with_bin(df: DataFrame, v, bins: int, out: str = "bin") -> DataFrame:
    """numpy.histogram bin of an in-range value: the number of interior edges <= v
    (the last bin is closed because the top edge is not interior)."""
    from tabsmith.operators.ranking import with_sorted_position
    return with_sorted_position(df, "_edges", bins - 1, v, out, strict=False)


def distribution_drift(ref: DataFrame, cur: DataFrame, cols: list[str], ks: DataFrame | None = None,
                       stats: DataFrame | None = None, index: DataFrame | None = None) -> DataFrame:
    """PSI, its interpretation and the Wasserstein distance per numeric feature."""
    w = (ks if ks is not None else ks_wasserstein(ref, cur, cols)).where(
        (F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    index = index if index is not None else psi(ref, cur, cols, stats=stats)
    return index.join(w.select("feature", "wasserstein"), "feature")


def _report_row(numeric: DataFrame, categorical: DataFrame, distribution: DataFrame | None,
                numerical_features: list[str], categorical_features: list[str],
                rows_df: DataFrame | None = None, psi_alert: float = 0.5) -> DataFrame:
    """One aggregate over a union of the per-feature tables (and the one-row
    sample sizes when given): every report field comes out of a single row."""
    order = {f"numerical_{c}": i for i, c in enumerate(numerical_features)}
    order.update({f"categorical_{c}": len(numerical_features) + i for i, c in enumerate(categorical_features)})
    fpos = {c: i for i, c in enumerate(numerical_features + categorical_features)}

    def posmap(d):
        if not d:
            return lambda c: F.lit(0)
        m = F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
        return lambda c: m[c]

    pos, ppos = posmap(order), posmap(fpos)
    no_rows = [F.lit(None).cast("bigint").alias("ref_rows"), F.lit(None).cast("bigint").alias("cur_rows")]
    num = numeric.select(F.lit("feature").alias("kind"), F.concat(F.lit("numerical_"), "feature").alias("name"),
                         "drift_detected", "drift_severity", *no_rows)
    cat = (categorical.where(F.col("status") == "ok")
           .select(F.lit("feature").alias("kind"), F.concat(F.lit("categorical_"), "feature").alias("name"),
                   "drift_detected", "drift_severity", *no_rows))
    rows = num.unionByName(cat).withColumn("pos", pos(F.col("name")).cast("int"))
    if distribution is not None:
        hp = distribution.where(F.col("psi") > psi_alert).select(
            F.lit("psi").alias("kind"), F.col("feature").alias("name"),
            F.lit(None).cast("boolean").alias("drift_detected"), F.lit(None).cast("string").alias("drift_severity"),
            *no_rows, ppos(F.col("feature")).cast("int").alias("pos"))
        rows = rows.unionByName(hp)
    if rows_df is not None:
        rows = rows.unionByName(rows_df.select(
            F.lit("rows").alias("kind"), F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("boolean").alias("drift_detected"), F.lit(None).cast("string").alias("drift_severity"),
            F.col("reference_rows").cast("bigint").alias("ref_rows"),
            F.col("current_rows").cast("bigint").alias("cur_rows"), F.lit(None).cast("int").alias("pos")))
    total = len(numerical_features) + len(categorical_features)
    is_feat = F.col("kind") == "feature"

    def ordered(cond, alias):
        items = F.array_sort(F.collect_list(F.when(cond, F.struct(F.col("pos"), F.col("name")))))
        return F.transform(items, lambda s: s["name"]).alias(alias)

    aggs = [F.count_if(is_feat).cast("int").alias("evaluated_features"),
            F.count_if(is_feat & F.col("drift_detected")).cast("int").alias("drifted_features"),
            ordered(is_feat & (F.col("drift_severity") == "high"), "high_drift_features"),
            ordered(is_feat & (F.col("drift_severity") == "medium"), "medium_drift_features"),
            ordered(is_feat & (F.col("drift_severity") == "low"), "low_drift_features"),
            ordered(F.col("kind") == "psi", "high_psi_features"),
            F.coalesce(F.max("ref_rows"), F.lit(0)).cast("bigint").alias("reference_rows"),
            F.coalesce(F.max("cur_rows"), F.lit(0)).cast("bigint").alias("current_rows")]
    agg = rows.agg(*aggs)
    score = (F.col("drifted_features") / F.lit(total)) if total > 0 else F.lit(0.0)
    return agg.select(F.lit(total).alias("total_features"), "*",
                      score.cast("double").alias("overall_drift_score"),
                      (score * 100).cast("double").alias("drift_percentage"))


SUMMARY_COLS = ["total_features", "evaluated_features", "drifted_features", "overall_drift_score",
                "drift_percentage", "high_drift_features", "medium_drift_features", "low_drift_features"]


def drift_summary(numeric: DataFrame, categorical: DataFrame, numerical_features: list[str],
                  categorical_features: list[str]) -> DataFrame:
    """One row: totals, overall score and feature lists by severity.

    ``total_features`` counts every configured feature, present or not (the
    reference's denominator); ``evaluated_features`` counts the tested ones.
    Lists keep the configured order, numeric features first.
    """
    return _report_row(numeric, categorical, None, numerical_features, categorical_features).select(*SUMMARY_COLS)


def _alert_columns():
    s = F.col("overall_drift_score")
    empty = F.array().cast("array<string>")

    def lits(xs):
        return F.array(*[F.lit(x) for x in xs])

    alerts = (F.when(s > 0.5, F.array(F.lit(ALERT_HIGH))).when(s > 0.25, F.array(F.lit(ALERT_MEDIUM)))
               .when(s > 0.1, F.array(F.lit(ALERT_LOW))).otherwise(empty))
    base = (F.when(s > 0.5, lits(RECS_HIGH)).when(s > 0.25, lits(RECS_MEDIUM))
             .when(s > 0.1, lits(RECS_LOW)).otherwise(lits(RECS_NONE)))
    hi, hp = F.col("high_drift_features"), F.col("high_psi_features")
    high_rec = F.when(F.size(hi) > 0, F.array(F.concat(F.lit(REC_HIGH_FEATURES), F.array_join(hi, ", ")))) \
                .otherwise(empty)
    psi_rec = F.when(F.size(hp) > 0, F.array(F.concat(F.lit(REC_PSI_FEATURES), F.array_join(hp, ", ")))) \
               .otherwise(empty)
    return alerts.alias("alerts"), F.concat(base, high_rec, psi_rec).alias("recommendations")


def drift_alerts(numeric: DataFrame, categorical: DataFrame, distribution: DataFrame,
                 numerical_features: list[str], categorical_features: list[str],
                 psi_alert: float = 0.5) -> DataFrame:
    """Alerts and recommendations (thresholds 0.5 / 0.25 / 0.1; PSI > 0.5 list)."""
    row = _report_row(numeric, categorical, distribution, numerical_features, categorical_features,
                      psi_alert=psi_alert)
    return row.select("overall_drift_score", *_alert_columns())


def _shared(ref: DataFrame, cur: DataFrame, numerical_features: list[str], categorical_features: list[str]):
    """What several tables read is computed once: the aggregates and sketches of each sample, the
    category counts, and from one scan the bucket totals that KS, Wasserstein and PSI share."""
    stats = materialize(side_stats(ref, cur, numerical_features, sketched=True))
    cats = materialize(category_counts(ref, cur, categorical_features))
    totals = sample_totals(ref, cur, numerical_features, stats)
    ks = materialize(ks_wasserstein(ref, cur, numerical_features, totals))
    num = numeric_drift(ref, cur, numerical_features, ks=ks, stats=stats)
    cat = categorical_drift(ref, cur, categorical_features, counts=cats)
    dist = distribution_drift(ref, cur, numerical_features, ks=ks, stats=stats, index=psi_of_totals(totals, stats))
    return stats, cats, num, cat, dist


def detect_drift(ref: DataFrame, cur: DataFrame, numerical_features: list[str],
                 categorical_features: list[str]) -> dict[str, DataFrame]:
    """All drift tables; nothing is collected."""
    stats, cats, num, cat, dist = _shared(ref, cur, numerical_features, categorical_features)
    return {"numerical": num, "categorical": cat, "distribution": dist,
            "summary": drift_summary(num, cat, numerical_features, categorical_features),
            "alerts": drift_alerts(num, cat, dist, numerical_features, categorical_features),
            "proportions": category_proportions(ref, cur, categorical_features, counts=cats),
            "rows": row_counts(stats)}


def drift_report(ref: DataFrame, cur: DataFrame, numerical_features: list[str],
                 categorical_features: list[str]) -> DataFrame:
    """R12 one-row report: shapes, summary, alerts and recommendations."""
    stats, _, num, cat, dist = _shared(ref, cur, numerical_features, categorical_features)
    row = _report_row(num, cat, dist, numerical_features, categorical_features, rows_df=row_counts(stats))
    return row.select("reference_rows", F.lit(len(ref.columns)).alias("reference_columns"),
                      "current_rows", F.lit(len(cur.columns)).alias("current_columns"),
                      *SUMMARY_COLS, *_alert_columns())
