"""Session helpers.

``get_spark`` is for tests, benchmarks and scripts; library functions never
create a session, they take the one their input DataFrame belongs to.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpointed intermediates are deleted once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "tabsmith", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for the 100 TB / 1000-executor target (applied by the cluster operator, not by
# the library): many initial shuffle partitions that AQE coalesces to ~256 MB each,
# skew-join splitting, and a broadcast threshold the bounded dimension tables fit in.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is always read
    from the session.  Only when it is unset on a ``local[...]`` master a
    private folder is created and registered; any other master raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not path:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
            try:
                spark.conf.set("spark.checkpoint.dir", path)
            except Exception:  # noqa: BLE001 - some deployments forbid runtime core confs
                pass
        sc.setCheckpointDir(path)
    return path or sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str = "stored"):
    """``df`` written as Parquet below the shared folder and read back: for rows that are read many times."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a partition up to which it is left as it is, least rows of a task among many.
LEAVE_ROWS, TASK_ROWS = 1 << 16, 1 << 14


def spread(df, most_rows: int = 1 << 19):
    """``df`` over all cores, for work that goes over its rows many times.

    Small frames keep their partitions.  Where one holds more than ``LEAVE_ROWS`` rows and more than
    half as many again as an even deal, rows are dealt evenly: a task for each core, or several
    for each so that none has more than ``most_rows``.
    """
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]   # a row for each partition
    n, cores = sum(sizes), max(1, df.sparkSession.sparkContext.defaultParallelism)
    wanted = max(1, min(cores * -(-n // (cores * most_rows)), n // TASK_ROWS))
    if max(sizes, default=0) <= max(LEAVE_ROWS, 1.5 * n / wanted):
        return df
    return df.repartition(wanted)


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder (eager).

    Used for intermediate results that several statistics read, so the raw
    data is scanned once: aggregates, and distinct values where all of them
    are to be ranked (``ranking``).  Never ``localCheckpoint``: a reliable
    checkpoint survives executor loss.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
