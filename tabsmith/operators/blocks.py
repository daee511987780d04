"""Mergeable blocks of pairwise moments: every pair of columns from one scan.

For k columns each task folds its Arrow batches into k x k arrays, each cell
over the rows where both columns have a value: the count, the mean of the row's
column, its centred square sum and the centred product sum.  A batch costs four
matrix products with the null mask.  Blocks merge by Chan's formula, first in
``FAN`` groups of tasks, then to one; a block has 6 k^2 numbers whatever the rows.

Cells also hold whether the row's column is constant there (exactly, by its
value), and whether an infinite value takes part, which no finite moment has.
The module is pickled by value, so Python workers need no copy of the package.
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

#: Groups that the blocks of all tasks are merged in before the last merge.
FAN = 64
FIELDS = ("n", "mean", "square", "product", "constant", "value", "infinite")
SCHEMA = "part int, " + ", ".join(f"{f} binary" for f in FIELDS)


def empty_block(k: int) -> dict[str, np.ndarray]:
    def zeros():
        return np.zeros((k, k))
    return {"n": zeros(), "mean": zeros(), "square": zeros(), "product": zeros(), "constant": np.ones((k, k), bool),
            "value": zeros(), "infinite": np.zeros((k, k), bool)}


def block_of(x: np.ndarray, varied: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Block of the rows of ``x``; NaN is a missing value.  ``varied``: cells known not to be constant."""
    with np.errstate(all="ignore"):
        there = ~np.isnan(x)
        endless = np.isinf(x)
        w = there.astype(float)
        plain = there & ~endless
        shift = np.where(plain, x, 0.0).sum(axis=0) / np.maximum(plain.sum(axis=0), 1)
        shift = np.where(np.isfinite(shift), shift, 0.0)
        y = np.where(plain, x - shift, 0.0)
        n = w.T @ w
        total = y.T @ w
        m = np.divide(total, n, out=np.zeros_like(n), where=n > 0)
        square = np.maximum((y * y).T @ w - total * m, 0.0)
        product = y.T @ y - total * m.T
    mean = np.where(n > 0, m + shift[:, None], 0.0)
    constant, value = np.ones_like(n, bool) if varied is None else ~varied, np.zeros_like(n)
    for b in np.flatnonzero(constant.any(axis=0)):   # exact test of the cells left: the least and greatest value where b has one
        open_ = np.flatnonzero(constant[:, b])
        rows = x[np.ix_(there[:, b], open_)]
        if len(rows):
            low, high = np.fmin.reduce(rows, axis=0), np.fmax.reduce(rows, axis=0)
            constant[open_, b], value[open_, b] = (low == high) | np.isnan(low), np.where(np.isnan(low), 0.0, low)
    return {"n": n, "mean": mean, "square": square, "product": product, "constant": constant, "value": value,
            "infinite": (endless.astype(float).T @ w) > 0}


def merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Block of both row sets."""
    n = a["n"] + b["n"]
    share = np.divide(b["n"], n, out=np.zeros_like(n), where=n > 0)
    delta = np.where((a["n"] > 0) & (b["n"] > 0), b["mean"] - a["mean"], 0.0)
    weight = a["n"] * share
    mean = np.where(a["n"] == 0, b["mean"], a["mean"] + delta * share)
    either = (a["n"] == 0) | (b["n"] == 0)
    return {"n": n, "mean": mean, "square": a["square"] + b["square"] + delta * delta * weight,
            "product": a["product"] + b["product"] + delta * delta.T * weight,
            "constant": a["constant"] & b["constant"] & (either | (a["value"] == b["value"])),
            "value": np.where(a["n"] == 0, b["value"], a["value"]), "infinite": a["infinite"] | b["infinite"]}


def to_row(block: dict[str, np.ndarray], part: int) -> dict:
    return {"part": part, **{f: block[f].tobytes() for f in FIELDS}}


def from_row(row: dict) -> dict[str, np.ndarray]:
    out = {}
    for f in FIELDS:
        flat = np.frombuffer(row[f], bool if f in ("constant", "infinite") else float)
        k = int(round(len(flat) ** 0.5))
        out[f] = flat.reshape(k, k)
    return out


ARROW = pa.schema([("part", pa.int32()), *[(f, pa.binary()) for f in FIELDS]])


def _merged(rows: pa.Table) -> pa.Table:
    total = None
    for r in rows.to_pylist():
        total = from_row(r) if total is None else merge(total, from_row(r))
    return pa.Table.from_pylist([to_row(total, 0)], schema=ARROW)


def numbers(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    """Columns of doubles as a matrix, missing values as NaN."""
    cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(first, batch.num_columns)]
    return np.column_stack(cols) if cols else np.zeros((batch.num_rows, 0))


def pair_block(df: DataFrame) -> DataFrame:
    """One row: the block of all columns of ``df``, which are doubles; no row for a frame without partitions."""
    k = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = empty_block(k)
        for b in batches:
            if b.num_rows:
                total = merge(total, block_of(numbers(b), ~total["constant"]))
        yield pa.RecordBatch.from_pylist([to_row(total, TaskContext.get().partitionId())], schema=ARROW)
    each = df.mapInArrow(run, SCHEMA)
    some = each.groupBy(F.pmod("part", F.lit(FAN))).applyInArrow(_merged, SCHEMA)
    return some.groupBy().applyInArrow(_merged, SCHEMA)


def correlations(block: dict[str, np.ndarray]) -> np.ndarray:
    """Pearson correlation of every pair; NaN where one is constant over the common rows or they are under two."""
    with np.errstate(all="ignore"):
        r = block["product"] / np.sqrt(block["square"] * block["square"].T)
    bad = (block["n"] < 2) | block["constant"] | block["constant"].T | block["infinite"] | block["infinite"].T
    return np.where(bad, np.nan, np.clip(r, -1.0, 1.0))


def pair_rows(df: DataFrame, names: list[str], lower_only: bool, value: str, of) -> DataFrame:
    """``(feature_a, feature_b, value)`` of the pairs of columns; ``of`` gives the matrix of a block, NaN for null,
    and which columns take part."""
    n = len(names)
    schema = f"feature_a string, feature_b string, {value} double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                matrix, keep = of(from_row(row))
                at = [i for i in range(n) if keep[i]]
                pairs = [(i, j) for i in at for j in at if i < j or not lower_only and i > j]
                got = [matrix[i, j] for i, j in pairs]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[i] for i, _ in pairs], pa.string()), pa.array([names[j] for _, j in pairs], pa.string()),
                    pa.array([None if np.isnan(x) else float(x) for x in got], pa.float64())], names=["feature_a", "feature_b", value])
    return pair_block(df).mapInArrow(run, schema)
