"""Validation and drift checks on arriving data (Structured Streaming).

The reference validates each new dataset and compares it with the training
data in batch.  Here the same operators run on every micro-batch of a
streaming source through ``foreachBatch``.  Each batch's result is written
to ``<path>/batch_id=<n>`` with overwrite, so a retried batch replaces its
own output (idempotent sink) and the checkpoint makes the query restartable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabsmith.operators import drift, quality


def start(stream_df: DataFrame, handler, checkpoint: str, available_now: bool, mode: str = "append"):
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder: without it a restart would begin at batch 0 and overwrite results")
    w = stream_df.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def validate_stream(stream_df: DataFrame, rules: list[dict], results_path: str,
                    checkpoint: str, available_now: bool = True):
    """Q7 per micro-batch: rule results with the batch id appended to ``results_path``."""
    def handle(batch: DataFrame, batch_id: int):
        _, res = quality.run_suite(batch, rules, on_fail="none")
        # the batch id is the partition directory; reading the folder restores it as a column
        res.write.mode("overwrite").parquet(f"{results_path}/batch_id={batch_id}")
    return start(stream_df, handle, checkpoint, available_now)


def drift_stream(stream_df: DataFrame, reference: DataFrame, numerical: list[str], categorical: list[str],
                 results_path: str, checkpoint: str, available_now: bool = True):
    """R12 per micro-batch: the one-row drift report of the batch against ``reference``.

    The reference's columns are written to the shared folder at the start, so a batch does not
    compute again what ``reference`` is made from; ``state_drift`` keeps its statistics instead.
    """
    from tabsmith.session import stored
    reference = stored(reference.select(*[c for c in dict.fromkeys([*numerical, *categorical]) if c in reference.columns]), "drift-reference")

    def handle(batch: DataFrame, batch_id: int):
        drift.drift_report(reference, batch, numerical, categorical) \
             .write.mode("overwrite").parquet(f"{results_path}/batch_id={batch_id}")
    return start(stream_df, handle, checkpoint, available_now)
