"""Sources and sinks.

All stage boundaries are Parquet; CSV is read with an explicit schema and
JSON is used only for small report tables.  Double columns have NaN turned
into null at every source so that later comparisons follow SQL null rules
(Spark orders NaN above every number and treats NaN = NaN as true).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN with null in every float/double column (other columns untouched)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name)
        out.append(c)
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             key: str | None = None, header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (PERMISSIVE: bad fields become null).

    ``key`` names the row-key column; it stays an ordinary column (there is no
    row index in Spark) and rows whose key is null are kept.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = nan_to_null(reader.csv(path))
    if key is not None and key not in df.columns:
        raise ValueError(f"key column {key!r} not in {df.columns}")
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple | list = (), fmt: str = "parquet") -> str:
    """Write a stage; ``mode='append'`` is the results-append sink."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def append_results(df: DataFrame, path: str) -> str:
    """Append rows of run results (metrics + parameters) to a results table."""
    return write_table(df, path, mode="append")


def write_report(df: DataFrame, path: str) -> str:
    """JSON report sink; nested structs/arrays/maps are kept as JSON objects."""
    df.write.mode("overwrite").json(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def save_params(df: DataFrame, path: str) -> str:
    """Fitted parameters (encoder maps, medians, fold scalers) are tables."""
    return write_table(df, path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> str:
    """Persist a fitted ``pyspark.ml`` model or pipeline, a forest of blocks, or a boosted model (``load_boosted`` reads it)."""
    from tabsmith.operators.boosting import BoostedModel
    from tabsmith.operators.forest import ForestModel
    if isinstance(model, (BoostedModel, ForestModel)):
        return model.save(SparkSession.getActiveSession(), path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """A pipeline or a forest of blocks, which has no folder of metadata."""
    from pyspark.errors import AnalysisException
    from pyspark.ml import PipelineModel

    from tabsmith.operators.forest import ForestModel
    spark = SparkSession.getActiveSession()
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException:
        return ForestModel.load(spark, path)
    return PipelineModel.load(path)


def load_boosted(spark: SparkSession, path: str):
    """A boosted model as ``save_model`` wrote it."""
    from tabsmith.operators.boosting import BoostedModel
    return BoostedModel.load(spark, path)
