"""Helpers the corpus operators share: shared-folder tables, Arrow batches, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.session import scratch_dir

#: Rows of an Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` (never raises it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage without computing twice; a lost executor costs no
    recomputation of what stands before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_value(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast ``value``, an object of this package's classes, and return what gives it in a task.

    A broadcast is pickled by reference to its class, which workers without the
    package cannot follow; these bytes hold the class as well.
    """
    from pyspark import cloudpickle
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        import pickle
        return pickle.loads(held.value)
    return get


def free_name(columns: list[str], base: str) -> str:
    """``base``, with a number behind it where a column has that name in any case."""
    taken = {c.lower() for c in columns}
    return next(n for n in (base, *(f"{base}{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def map_texts(df: DataFrame, columns: list[str], schema: T.StructType,
              make: Callable[[], Callable[[list[list]], dict]]) -> DataFrame:
    """Add the columns of ``schema`` computed from ``columns``; every input column stays.

    ``make()`` runs once per task and returns a function from a batch's
    columns (lists) to the new columns (lists).  An existing column with the
    name of a new one, in any case, is replaced.
    """
    bounded_batches(df.sparkSession)
    new = [f.name for f in schema.fields]
    kept = [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in new}]
    out = T.StructType(kept + list(schema.fields))
    keep = [f.name for f in kept]
    arrow = [_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            fn = fn or make()
            got = fn([batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns])
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            cols += [pa.array(got[n], t) for n, t in zip(new, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=keep + new)

    return df.mapInArrow(run, out)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in t.fields])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
            T.FloatType: pa.float32(), T.BooleanType: pa.bool_(), T.StringType: pa.string(),
            T.BinaryType: pa.binary()}[type(t)]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node reachable from every node of an undirected graph.

    ``edges`` has long columns ``a`` and ``b``; rows with a null end and
    loops link nothing.  Returns ``(node, component)``, a row for each node
    that has an edge.

    Each round hooks every node onto its smallest neighbour, jumps once along
    these pointers and contracts the graph, so chains shrink geometrically.
    Rounds read tables of the shared folder; joins are on one unique side, so
    a node of very many edges can be split by the skew join.
    """
    e = table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
              .where("a < b").distinct(), name)
    labels = None
    while not e.isEmpty():
        ends = e.selectExpr("a AS u", "b AS w").unionByName(e.selectExpr("b AS u", "a AS w"))
        hook = table(ends.groupBy("u").agg(F.min("w").alias("m")).selectExpr("u", "least(u, m) AS p"), name)
        jump = table(hook.join(hook.selectExpr("u AS p", "p AS r"), "p").select("u", "r"), name)
        if labels is None:
            labels = jump.selectExpr("u AS node", "r AS component")
        else:
            labels = table(labels.join(jump, labels.component == jump.u, "left")
                           .selectExpr("node", "coalesce(r, component) AS component"), name)
        e = table(e.join(jump.selectExpr("u AS a", "r AS ra"), "a").join(jump.selectExpr("u AS b", "r AS rb"), "b")
                  .selectExpr("least(ra, rb) AS a", "greatest(ra, rb) AS b").where("a < b").distinct(), name)
    return labels if labels is not None else edges.sparkSession.createDataFrame([], "node long, component long")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
