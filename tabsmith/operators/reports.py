"""Report tables: the data under each chart of the reference (V1-V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_features(summary: DataFrame, n: int = 15) -> DataFrame:
    """V1: the n features with the highest average importance (both importances kept)."""
    return summary.orderBy(F.desc("avg_importance"), "feature").limit(n)


def confusion_rates(conf: DataFrame) -> DataFrame:
    """V2: row-normalised confusion matrix in long form."""
    return conf.select("true_label", "predicted_label", "row_rate")


def class_table(report: DataFrame) -> DataFrame:
    """V3: class-wise precision / recall / F1 / support (average rows left out)."""
    return report.where(F.col("label").rlike("^[0-9]+$"))


def drift_table(report: DataFrame) -> DataFrame:
    """V4: score, counts, percent and the first recommendation of a drift report row."""
    return report.select("overall_drift_score", "total_features", "drifted_features", "drift_percentage",
                         F.element_at("recommendations", 1).alias("first_recommendation"))


def top_permutation(perm: DataFrame, n: int = 15) -> DataFrame:
    """V5: the n largest permutation importances."""
    return perm.orderBy(F.desc("importance_mean"), "feature").limit(n)
