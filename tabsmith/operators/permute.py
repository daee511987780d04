"""Seeded permutations of row numbers by a small Feistel network.

``permuted(i)`` is a bijection on 0 .. n-1 for every key: four rounds of mixing
half the bits into the other half permute the numbers below a power of four,
and a number that falls outside is put through again until it is inside (the
walk stays on the cycle it began on, so no two meet).  So a row's partner in a
random permutation is computed; nothing is ranked or sorted.  The module is
pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS = 4


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def permuted(i: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    """Images of the numbers ``i`` (below ``n``) under the permutation of ``key``."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    low = np.uint64((1 << half) - 1)
    seeds = np.random.SeedSequence(list(key)).generate_state(ROUNDS, np.uint64).tolist()
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        a, b = x >> np.uint64(half), x & low
        for s in seeds:
            a, b = b, a ^ (_mix(b, s) & low)
        out[todo] = (a << np.uint64(half)) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def numbered(df: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """``df`` with dense numbers in ``id_col``, written to the shared folder, and the number of rows.

    A row's number is its place in its partition after the sizes of the
    partitions before; only these sizes (a row for each partition) are collected.
    """
    from tabsmith.session import stored
    part, place = f"{id_col}_part", f"{id_col}_place"
    rows = stored(df.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
                  "numbered")
    sizes = sorted((r[part], r["count"]) for r in rows.groupBy(part).count().collect())
    first, offsets = 0, []
    for p, n in sizes:
        offsets.append((p, first))
        first += n
    table = df.sparkSession.createDataFrame(offsets, f"{part} int, {id_col} long")
    out = rows.join(F.broadcast(table), part).withColumn(id_col, F.col(id_col) + F.col(place))   # a row for each partition
    return out.drop(part, place), first


def dealt_values(rows: DataFrame, n: int, id_col: str, columns: list[str], repeats: int, seed: int) -> DataFrame:
    """``(id, slot, value)``: every row's value of each column, sent to the row that takes it in each repeat.

    Slot ``c * repeats + r`` is column ``c`` in repeat ``r``; every (id, slot) has one value.
    """
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.column(0).to_numpy()
            for c in range(k):
                for r in range(repeats):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(permuted(i, n, (seed, c, r))), pa.array(np.full(len(i), c * repeats + r, np.int32)), b.column(c + 1)],
                        names=["id", "slot", "value"])
    narrow = rows.select(F.col(id_col).cast("long"), *[F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(columns)])
    return narrow.mapInArrow(run, "id long, slot int, value double")
