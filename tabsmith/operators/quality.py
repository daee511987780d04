"""Declarative data-quality rules (Q1-Q9).

A suite is a list of rule dicts.  ``run_suite`` fuses every rule into ONE
aggregate over the frame (plus schema checks on the driver), returns the
frame unchanged with a result table, and by default only warns: a failed
rule never stops the pipeline unless ``on_fail='raise'``.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col

log = logging.getLogger(__name__)

RESULT_SCHEMA = "rule string, column string, success boolean, observed double, unexpected bigint, total bigint"

# ---------------------------------------------------------------------------
# The raw and processed claims suites.
RAW_CLAIM_COLUMNS = [
    "C-2 Date", "Medical Fee Region", "WCIO Nature of Injury Code", "WCB Decision", "Number of Dependents",
    "Claim Identifier", "Birth Year", "WCIO Cause of Injury Code", "Age at Injury", "First Hearing Date",
    "Attorney/Representative", "Alternative Dispute Resolution", "County of Injury", "WCIO Part Of Body Code",
    "WCIO Nature of Injury Description", "Industry Code Description", "Accident Date",
    "OIICS Nature of Injury Description", "Gender", "WCIO Cause of Injury Description", "Carrier Name",
    "Claim Injury Type", "Agreement Reached", "WCIO Part Of Body Description", "Average Weekly Wage", "Zip Code",
    "IME-4 Count", "C-3 Date", "District Name", "COVID-19 Indicator", "Assembly Date", "Industry Code", "Carrier Type",
]
PROCESSED_CLAIM_COLUMNS = [
    "Age at Injury", "Average Weekly Wage", "Birth Year", "IME-4 Count", "Number of Dependents", "Days_to_C2",
    "Days_to_C3", "Days_to_First_Hearing", "C-2 Date_Day", "C-2 Date_Month", "C-2 Date_Year", "C-2 Date_DayOfWeek",
    "C-3 Date_Month", "C-3 Date_Day", "C-3 Date_Year", "C-3 Date_DayOfWeek", "First Hearing Date_Day",
    "First Hearing Date_Month", "First Hearing Date_Year", "First Hearing Date_DayOfWeek", "Accident Date_Day",
    "Accident Date_Month", "Accident Date_Year", "Accident Date_DayOfWeek", "Assembly Date_Day",
    "Assembly Date_Month", "Assembly Date_Year", "Assembly Date_DayOfWeek", "Alternative Dispute Resolution_U",
    "Alternative Dispute Resolution_Y", "Enc County of Injury", "Enc District Name", "Enc Industry Code",
    "Known Accident Date", "Known Assembly Date", "Known C-2 Date", "Known C-3 Date", "Enc WCIO Cause of Injury Code",
    "Enc WCIO Nature of Injury Code", "Enc WCIO Part Of Body Code", "Enc Zip Code", "Attorney/Representative_Y",
    "Carrier Type_2A. SIF", "Carrier Type_3A. SELF PUBLIC", "Carrier Type_4A. SELF PRIVATE",
    "Carrier Type_5D. SPECIAL FUND - UNKNOWN", "Carrier Type_UNKNOWN", "COVID-19 Indicator_Y",
    "Medical Fee Region_II", "Medical Fee Region_III", "Medical Fee Region_IV", "Medical Fee Region_UK",
    "Known First Hearing Date", "Known Age at Injury", "Known Birth Year", "Holiday_Accident", "Weekend_Accident",
    "Risk_Level", "Gender_M", "Gender_Unknown", "Accident_Season_Sin", "Accident_Season_Cos", "Relative_Wage",
    "Financial Impact Category", "Age_Group", "Claim Injury Type",
]
SUITES = {
    "raw_data_suite": [
        {"type": "expect_table_row_count_to_be_between", "min": 593471, "max": 593471},
        {"type": "expect_table_columns_to_match_set", "columns": RAW_CLAIM_COLUMNS, "exact": None},
    ],
    "processed_data_suite": [
        {"type": "expect_table_row_count_to_be_between", "min": 100000, "max": 593471},
        {"type": "expect_table_columns_to_match_set", "columns": PROCESSED_CLAIM_COLUMNS, "exact": None},
        {"type": "expect_column_values_to_not_be_null", "column": "Claim Injury Type"},
        {"type": "expect_column_values_to_be_between", "column": "Age at Injury", "min": 16, "max": 100},
    ],
}
# ---------------------------------------------------------------------------


def get_suite(name: str, suites: dict | None = None) -> list[dict]:
    """Q9: a missing suite is an empty suite (which passes)."""
    return list((suites or SUITES).get(name, []))


def _column_rule_exprs(i: int, r: dict):
    """(unexpected, denominator) aggregate expressions for a column rule."""
    c = col(r["column"])
    t = r["type"]
    if t == "expect_column_values_to_not_be_null":
        return F.count_if(c.isNull()), F.count(F.lit(1))
    if t == "expect_column_values_to_be_between":
        bad = F.lit(False)
        if r.get("min") is not None:
            bad = bad | (c < F.lit(r["min"]))
        if r.get("max") is not None:
            bad = bad | (c > F.lit(r["max"]))
        return F.count_if(c.isNotNull() & bad), F.count(c)
    if t == "expect_column_values_to_be_in_set":
        return F.count_if(c.isNotNull() & ~c.isin(list(r["value_set"]))), F.count(c)
    raise ValueError(f"unknown rule type {t!r}")


def run_suite(df: DataFrame, rules: list[dict], on_fail: str = "warn") -> tuple[DataFrame, DataFrame]:
    """Q1-Q7: evaluate all rules; returns (df unchanged, results)."""
    spark = df.sparkSession
    schema_rows, aggs, col_rules = [], [F.count(F.lit(1)).alias("_n")], []
    for i, r in enumerate(rules):
        t = r["type"]
        if t == "expect_table_columns_to_match_set":
            want, have = set(r["columns"]), set(df.columns)
            missing, extra = want - have, have - want
            ok = not missing and (not extra if r.get("exact") else True)
            schema_rows.append((t, None, ok, float(len(missing)), len(missing) + (len(extra) if r.get("exact") else 0),
                                len(want)))
        elif t == "expect_column_to_exist":
            ok = r["column"] in df.columns
            schema_rows.append((t, r["column"], ok, 1.0 if ok else 0.0, 0 if ok else 1, 1))
        elif t == "expect_table_row_count_to_be_between":
            col_rules.append((i, r))
        else:
            if r["column"] not in df.columns:
                schema_rows.append((t, r["column"], False, None, None, None))
                continue
            u, d = _column_rule_exprs(i, r)
            aggs += [u.alias(f"u{i}"), d.alias(f"d{i}")]
            col_rules.append((i, r))
    results = spark.createDataFrame(schema_rows, RESULT_SCHEMA)
    if col_rules:
        row = df.agg(*aggs)   # every data rule in one pass
        n = F.col("_n")
        structs = []
        for i, r in col_rules:
            t = r["type"]
            if t == "expect_table_row_count_to_be_between":
                ok = F.lit(True)
                if r.get("min") is not None:
                    ok = ok & (n >= r["min"])
                if r.get("max") is not None:
                    ok = ok & (n <= r["max"])
                structs.append(F.struct(F.lit(t).alias("rule"), F.lit(None).cast("string").alias("column"),
                                        ok.alias("success"), n.cast("double").alias("observed"),
                                        F.lit(0).cast("bigint").alias("unexpected"), n.alias("total")))
            else:
                u, d = F.col(f"u{i}"), F.col(f"d{i}")
                pct = F.when(d > 0, u * 100.0 / d).otherwise(F.lit(0.0))
                structs.append(F.struct(F.lit(t).alias("rule"), F.lit(r["column"]).alias("column"),
                                        (u == 0).alias("success"), pct.alias("observed"),
                                        u.cast("bigint").alias("unexpected"), n.alias("total")))
        data = row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
        results = results.unionByName(data) if schema_rows else data
    if on_fail == "raise":
        failed = [r["rule"] for r in results.where(~F.col("success")).collect()]
        if failed:
            raise ValueError(f"data validation failed: {failed}")
    elif on_fail == "warn":
        failed = [r["rule"] for r in results.where(~F.col("success")).collect()]   # one row for each rule
        if failed:
            log.warning("data validation failed: %s", failed)
    return df, results


def suite_summary(results: DataFrame) -> DataFrame:
    """Q8 as a table: rules evaluated, rules failed, overall success."""
    return results.agg(F.count(F.lit(1)).alias("rules"),
                       F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed"),
                       F.coalesce(F.min(F.coalesce(F.col("success"), F.lit(False)).cast("int")), F.lit(1))
                        .cast("boolean").alias("success"))


def suite_passes(df: DataFrame, rules: list[dict]) -> bool:
    """Q8: True when every rule passes; any evaluation error gives False."""
    try:
        _, res = run_suite(df, rules, on_fail="none")
        return bool(suite_summary(res).first()["success"])
    except Exception as e:  # noqa: BLE001
        log.warning("suite evaluation failed: %s", e)
        return False
