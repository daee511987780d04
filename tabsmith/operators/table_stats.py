"""Mergeable statistics of a feature group (F3, F4), kept beside its rows.

Every write of rows appends the statistics of these rows alone, under
``<root>/<group>/_stats/version=<v>``; reading merges what the writes left, so an
append costs what it appends, however large the group is:

* moments of every pair of columns (``operators.blocks``): counts, means, deviations, correlations;
* for each column the least and greatest value, an HLL sketch of the distinct values and a KLL sketch of the ranks;
* a histogram on bins whose width is a power of two: bins of a write fall whole into the
  wider ones of the group, so merged counts are exact.

Merged statistics equal those of all rows at once: counts, extremes and histograms
exactly, moments to rounding, sketches within their errors (about 2 %).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators import blocks

#: Bins of a histogram, at most twice as many and one: its width is the least power of two that is enough.
BINS = 32
#: Rank error of a KLL sketch: about 1 %.
KLL_K = 400

FEATURES = "feature string, n long, mn double, mx double, hll binary, kll binary"
HISTOGRAM = "feature string, e int, bin long, count long"


def numeric_columns(df: DataFrame, key: str | None = None) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != key]


def stats_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/_stats/version={version}"


def _width(mn, mx):
    """Exponent of a histogram's bin width: never falls as the range grows."""
    room = F.when(mx > mn, F.ceil(F.log2((mx - mn) / BINS))).otherwise(F.lit(-1074))
    size = F.greatest(F.abs(mn), F.abs(mx))
    return F.greatest(room, F.when(size > 0, F.ceil(F.log2(size)) - 50).otherwise(F.lit(-1000))).cast("int")


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    def value(c):
        v = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(v), v)
    return df.select(*[value(c).alias(f"x{i}") for i, c in enumerate(columns)])


def append_statistics(df: DataFrame, root: str, name: str, version: int, columns: list[str], mode: str = "append") -> str:
    """Write the statistics of the rows of ``df``; ``mode`` "overwrite" begins anew."""
    path = stats_path(root, name, version)
    x = _values(df, columns)
    blocks.pair_block(x).withColumn("columns", F.array(*[F.lit(c) for c in columns])).write.mode(mode).parquet(f"{path}/pairs")
    row = x.agg(*[e for i in range(len(columns)) for e in (
        F.count(f"x{i}").alias(f"n{i}"), F.min(f"x{i}").alias(f"l{i}"), F.max(f"x{i}").alias(f"h{i}"),
        F.hll_sketch_agg(F.when(F.col(f"x{i}").isNotNull(), F.xxhash64(f"x{i}")), 12).alias(f"d{i}"), F.kll_sketch_agg_double(f"x{i}", KLL_K).alias(f"q{i}"))])
    lines = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"l{i}").alias("mn"), F.col(f"h{i}").alias("mx"),
                               F.col(f"d{i}").alias("hll"), F.col(f"q{i}").alias("kll")) for i, c in enumerate(columns)])
    row.select(F.explode(lines).alias("s")).select("s.*").where("n > 0").write.mode(mode).parquet(f"{path}/features")
    ranges = _merged_features(df.sparkSession.read.schema(FEATURES).parquet(f"{path}/features"))
    widths = {r["feature"]: r["e"] for r in ranges.select("feature", _width(F.col("mn"), F.col("mx")).alias("e")).collect()}   # a row for each column
    at = [F.struct(F.lit(c).alias("feature"), F.lit(widths[c]).alias("e"), F.floor(F.col(f"x{i}") * F.pow(F.lit(2.0), F.lit(-widths[c]))).alias("bin"))
          for i, c in enumerate(columns) if c in widths]
    if at:
        binned = x.select(F.explode(F.array(*at)).alias("b")).select("b.*").where("bin IS NOT NULL")
        bins = binned.groupBy("feature", "e", "bin").agg(F.count(F.lit(1)).alias("count"))
    else:
        bins = df.sparkSession.createDataFrame([], HISTOGRAM)
    bins.write.mode(mode).parquet(f"{path}/bins")
    return path


def _merged_features(rows: DataFrame) -> DataFrame:
    return rows.groupBy("feature").agg(F.sum("n").alias("n"), F.min("mn").alias("mn"), F.max("mx").alias("mx"),
                                       F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def read_statistics(spark: SparkSession, root: str, name: str, version: int) -> dict[str, DataFrame]:
    """``describe``, ``histogram`` and ``correlation`` of all rows written so far, merged from the writes' statistics."""
    path = stats_path(root, name, version)
    pairs = spark.read.parquet(f"{path}/pairs")
    columns = pairs.first()["columns"]
    merged = pairs.drop("columns").groupBy().applyInArrow(blocks._merged, blocks.SCHEMA)
    features = _merged_features(spark.read.schema(FEATURES).parquet(f"{path}/features"))

    def moments(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for row in b.to_pylist():
                m = blocks.from_row(row)
                n, mean, square = (np.diagonal(m[f]) for f in ("n", "mean", "square"))
                held = np.flatnonzero(n > 0)
                with np.errstate(all="ignore"):
                    std = np.sqrt(square / (n - 1))
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array([columns[i] for i in held], pa.string()), "mean": pa.array(mean[held], pa.float64()),
                    "std": pa.array([None if n[i] < 2 else float(std[i]) for i in held], pa.float64())})
    ranks = [F.kll_sketch_get_quantile_double("kll", F.lit(p)).alias(a) for p, a in ((0.25, "approx_q25"), (0.5, "approx_q50"), (0.75, "approx_q75"))]
    describe = features.join(merged.mapInArrow(moments, "feature string, mean double, std double"), "feature").select(
        "feature", F.col("n").alias("count"), "mean", "std", F.col("mn").alias("min"), F.col("mx").alias("max"),
        F.hll_sketch_estimate("hll").alias("approx_distinct"), *ranks)
    wide = features.select("feature", _width(F.col("mn"), F.col("mx")).alias("width"))
    bins = spark.read.schema(HISTOGRAM).parquet(f"{path}/bins").join(wide, "feature")
    histogram = (bins.groupBy("feature", "width", F.expr("shiftright(bin, least(width - e, 63))").alias("bin")).agg(F.sum("count").alias("count"))
                 .select("feature", (F.col("bin") * F.pow(F.lit(2.0), F.col("width"))).alias("lower"),
                         ((F.col("bin") + 1) * F.pow(F.lit(2.0), F.col("width"))).alias("upper"), "count"))

    def corr(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for row in b.to_pylist():
                r = blocks.correlations(blocks.from_row(row))
                at = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
                yield pa.RecordBatch.from_pydict({
                    "feature_a": pa.array([columns[i] for i, _ in at], pa.string()), "feature_b": pa.array([columns[j] for _, j in at], pa.string()),
                    "corr": pa.array([None if np.isnan(r[i, j]) else float(r[i, j]) for i, j in at], pa.float64())})
    return {"describe": describe, "histogram": histogram,
            "correlation": merged.mapInArrow(corr, "feature_a string, feature_b string, corr double")}
