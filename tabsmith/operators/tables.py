"""Versioned feature tables.

A feature group is a projection of the model table (key + event time +
the group's available columns), validated with its rule suite (never
blocking), written as Parquet under ``<root>/<group>/version=<v>`` and
described by a status row.  Spark writes in parallel tasks; no chunking.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col
from tabsmith.operators import quality, table_stats
from tabsmith.operators.columns import add_event_time

log = logging.getLogger(__name__)

STATUS_SCHEMA = ("group_name string, version int, status string, n_features int, "
                 "missing_columns array<string>, rows bigint, validation_passed boolean, path string")


def table_exists(spark, path: str) -> bool:
    """False only where the path does not exist; an unreadable table raises."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - schema read touches only the footer
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def describe_features(df: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """attach a ``comment`` to each described column (kept by Parquet/Hive writers)."""
    out = df
    for c, text in descriptions.items():
        if c in out.columns:
            out = out.withMetadata(c, {"comment": text})
    return out


def create_feature_group(df: DataFrame, key: str, group: dict, root: str, version: int = 1,
                         event_time: str = "datetime", overwrite: bool = False,
                         suites: dict | None = None) -> tuple:
    """one group -> status tuple (see STATUS_SCHEMA)."""
    spark = df.sparkSession
    name = group["name"]
    wanted = list(group.get("columns", []))
    available = [c for c in wanted if c in df.columns and c != key]
    missing = [c for c in wanted if c not in df.columns]
    path = f"{root.rstrip('/')}/{name}/version={version}"
    if not available:
        return (name, version, "skipped", 0, missing, None, None, path)
    if table_exists(spark, path) and not overwrite:
        return (name, version, "exists", len(available), missing, None, None, path)
    frame = add_event_time(df.select(col(key), *[col(c) for c in available]), key, event_time)
    frame = describe_features(frame, group.get("features_desc", {}))
    passed = None
    rules = quality.get_suite(f"{name}_expectations", suites or {})
    if rules:
        try:
            _, res = quality.run_suite(frame, rules, on_fail="none")
            passed = bool(quality.suite_summary(res).first()["success"])
        except Exception as e:  # noqa: BLE001 - validation never blocks the write
            log.warning("validation of %s failed to run: %s", name, e)
            passed = False
    frame.write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    numbers = table_stats.numeric_columns(written, key)
    if numbers:
        table_stats.append_statistics(written, root, name, version, numbers, mode="overwrite")
    rows = written.count()
    return (name, version, "created", len(available), missing, rows, passed, path)


def create_feature_tables(df: DataFrame, key: str, config: list[dict], root: str, version: int = 1,
                          overwrite: bool = False, suites: dict | None = None) -> DataFrame:
    """every configured group; failures are reported, not raised."""
    spark = df.sparkSession
    rows = []
    for g in config:
        try:
            rows.append(create_feature_group(df, key, g, root, version, overwrite=overwrite, suites=suites))
        except Exception as e:  # noqa: BLE001
            log.warning("feature group %s failed: %s", g.get("name"), e)
            rows.append((g.get("name"), version, "failed", 0, [], None, None, None))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def insert_rows(df: DataFrame, root: str, name: str, version: int = 1) -> str:
    """append rows to an existing group version, and their statistics to the group's."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}/version={version}"
    known = f"{table_stats.stats_path(root, name, version)}/pairs"
    df.write.mode("append").parquet(path)
    if table_exists(spark, known):
        columns = spark.read.parquet(known).select("columns").first()["columns"]
        given = df.select(*[(col(c) if c in df.columns else F.lit(None)).cast("double").alias(c) for c in columns])
        table_stats.append_statistics(given, root, name, version, columns)
    return path


def read_group(spark, root: str, name: str, version: int | None = None) -> DataFrame:
    """Read one version, or all versions with a ``version`` column (partition discovery)."""
    base = f"{root.rstrip('/')}/{name}"
    return spark.read.parquet(f"{base}/version={version}" if version is not None else base)


def table_statistics(df: DataFrame, numeric: list[str], bins: int = 10) -> dict[str, DataFrame]:
    """describe (exact quartiles), histograms and correlations of numeric columns, from the rows.

    ``table_stats.read_statistics`` gives those of a written group without reading its rows.
    """
    from tabsmith.operators.profile import correlation, describe_numeric, histogram
    return {"describe": describe_numeric(df, numeric), "histogram": histogram(df, numeric, bins),
            "correlation": correlation(df, numeric, lower_only=True)}
