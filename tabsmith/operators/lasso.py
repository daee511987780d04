"""L1-regularised least squares with cross-validation from one scan.

The scan gives each fold's moments: rows, means and centred products of the
features and the label; partial moments merge by Chan's formula.  A training
set is all rows less a fold, by taking the fold's moments away; its error on
the fold follows from the fold's moments.  Coordinate descent with covariance
updates works on products alone, from the largest penalty to the smallest, each
starting where the one before ended.  The driver holds folds x features^2
numbers.  The module is pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators.blocks import FAN, numbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The smallest penalty of a path as a share of the one that zeroes all coefficients.
SPAN = 1e-3
#: A sweep that changes the fit by less than this share of the label's variance ends a descent; most sweeps of one.
TOLERANCE, SWEEPS = 1e-20, 100_000

Moments = tuple[float, np.ndarray, np.ndarray]   # rows, means, centred products; the label comes last


def moments(x: np.ndarray) -> Moments:
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    return float(len(x)), mean, (x - mean).T @ (x - mean)


def merged(a: Moments, b: Moments) -> Moments:
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    delta = b[1] - a[1]
    return n, a[1] + delta * (b[0] / n), a[2] + b[2] + np.outer(delta, delta) * (a[0] * b[0] / n)


def without(whole: Moments, part: Moments) -> Moments:
    """Moments of the rows of ``whole`` that are not in ``part``."""
    n = whole[0] - part[0]
    if not part[0] or n <= 0:
        return whole if not part[0] else (0.0, np.zeros_like(whole[1]), np.zeros_like(whole[2]))
    mean = (whole[0] * whole[1] - part[0] * part[1]) / n
    delta = part[1] - mean
    return n, mean, whole[2] - part[2] - np.outer(delta, delta) * (n * part[0] / whole[0])


def total(folds: list[Moments]) -> Moments:
    out = folds[0]
    for f in folds[1:]:
        out = merged(out, f)
    return out


def fold_moments(df: DataFrame, features: list[str], label: str, n_folds: int, seed: int) -> list[Moments]:
    """Moments of each fold's rows without a null; a row's fold is a hash of its values."""
    cols = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate([*features, label])]
    k = len(cols)
    x = df.select(*cols)
    x = x.select(F.pmod(F.xxhash64(*x.columns, F.lit(seed)), F.lit(n_folds)).cast("double").alias("fold"), *x.columns)
    schema, arrow = "part int, body binary", pa.schema([("part", pa.int32()), ("body", pa.binary())])

    def pack(folds):
        return np.concatenate([np.concatenate([[n], m, c.ravel()]) for n, m, c in folds]).tobytes()

    def unpack(body):
        rows = np.frombuffer(body).reshape(n_folds, 1 + k + k * k)
        return [(float(r[0]), r[1:1 + k], r[1 + k:].reshape(k, k)) for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        folds = [moments(np.zeros((0, k)))] * n_folds
        for b in batches:
            m = numbers(b)
            m = m[np.isfinite(m).all(axis=1)]
            folds = [merged(f, moments(m[m[:, 0] == i, 1:])) for i, f in enumerate(folds)]
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "body": pa.array([pack(folds)], pa.binary())})

    def merge(rows: pa.Table) -> pa.Table:
        folds = None
        for body in rows.column("body").to_pylist():
            folds = unpack(body) if folds is None else [merged(a, b) for a, b in zip(folds, unpack(body), strict=True)]
        return pa.Table.from_pydict({"part": [0], "body": [pack(folds)]}, schema=arrow)
    some = x.mapInArrow(run, schema).groupBy(F.pmod("part", F.lit(FAN))).applyInArrow(merge, schema)
    row = some.groupBy().applyInArrow(merge, schema).first()
    return unpack(bytes(row["body"])) if row else [moments(np.zeros((0, k)))] * n_folds


def descend(gram: np.ndarray, cross: np.ndarray, penalty: float, start: np.ndarray, scale: float) -> np.ndarray:
    """Minimum of b'Gb/2 - c'b + penalty |b|_1 by cyclic coordinate descent from ``start``."""
    b = start.copy()
    slope = cross - gram @ b          # c - G b, kept up to date
    size = np.diag(gram)
    live = np.flatnonzero(size > 0)
    b[size <= 0] = 0.0
    active = live
    for sweep in range(SWEEPS):
        most = 0.0
        for j in active:
            old = b[j]
            pull = slope[j] + size[j] * old
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / size[j]
            if new != old:
                slope -= gram[:, j] * (new - old)
                b[j] = new
                most = max(most, size[j] * (new - old) ** 2)
        if most <= TOLERANCE * scale:
            if len(active) == len(live):
                break
            active = live             # the others may come in again
        elif sweep % 10 == 0:
            active = live
        else:
            active = live[b[live] != 0] if b.any() else live
    return b


def solve(m: Moments, penalty: float, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Coefficients and intercept for one penalty."""
    n, mean, c = m
    k = len(mean) - 1
    if n < 1:
        return np.zeros(k), 0.0
    gram, cross, scale = c[:k, :k] / n, c[:k, k] / n, max(c[k, k] / n, 1e-300)
    coef = descend(gram, cross, penalty, np.zeros(k) if start is None else start, scale)
    return coef, float(mean[k] - mean[:k] @ coef)


def path(m: Moments, n_alphas: int, span: float = SPAN) -> list[float]:
    """Penalties from the smallest that zeroes all coefficients down to ``span`` of it, evenly in logarithm."""
    k = len(m[1]) - 1
    top = float(np.abs(m[2][:k, k]).max(initial=0.0) / m[0]) if m[0] else 0.0
    return [(top or 1e-6) * span ** (i / max(1, n_alphas - 1)) for i in range(n_alphas)]


def squared_error(m: Moments, coef: np.ndarray, intercept: float) -> float:
    """Mean squared error on the rows of ``m``."""
    n, mean, c = m
    k = len(coef)
    spread = c[k, k] - 2 * coef @ c[:k, k] + coef @ c[:k, :k] @ coef
    return float(spread / n + (mean[k] - intercept - mean[:k] @ coef) ** 2)


def cross_validated(folds: list[Moments], n_alphas: int) -> tuple[np.ndarray, float, float, list[tuple[float, float]]]:
    """Coefficients, intercept, penalty, and the (penalty, mean squared error) of the path."""
    whole = total(folds)
    alphas = path(whole, n_alphas)
    errors = np.zeros(n_alphas)
    held = [f for f in folds if f[0]]
    for fold in held:
        rest, coef = without(whole, fold), np.zeros(len(whole[1]) - 1)
        for i, a in enumerate(alphas):
            coef, intercept = solve(rest, a, coef)
            errors[i] += squared_error(fold, coef, intercept) / len(held)
    best = int(errors.argmin()) if held else 0
    coef = np.zeros(len(whole[1]) - 1)
    for a in alphas[:best + 1]:
        coef, intercept = solve(whole, a, coef)
    return coef, intercept, alphas[best], list(zip(alphas, errors.tolist(), strict=True))
