"""Query registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and, if given, its DuckDB oracle."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle rounds the same way)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits).alias(f.name)
        out.append(c)
    return df.select(*out)
