"""Votes of a random forest for rows of which one feature at a time has another value.

Permutation importance scores every row once for each feature and repeat.  All
of these scorings share the row's own way through a tree up to the first test
of the feature, and all of it where the feature is not tested or the other value
falls on the same side.  So a batch of rows goes through a tree once, and a
(row, feature, repeat) leaves that way where its value first decides otherwise.
Votes are added tree by tree, as the model does, so predictions are the same to
the last digit.  The module is pickled by value.

Values are compared as codes: the number of the forest's cuts of a feature that are
below the value (missing: above all).  ``sent`` brings codes to blocks of row numbers, a few
rows for each batch and block and not one for each value; ``hits`` scores a block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators import permute
from tabsmith.session import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most rows of a block, least rows of one, blocks for each core, and scorings of a batch.
BLOCK_ROWS, LEAST_ROWS, CORE_BLOCKS, BATCH = 1 << 16, 1 << 12, 8, 1 << 18


def forest_of(model) -> tuple | None:
    """``(inputs, forest)`` of an assembler and a random forest with numeric cuts; None for any other model."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.feature import VectorAssembler

    from tabsmith.operators.forest import ForestModel
    if isinstance(model, ForestModel):
        return model.features, model
    stages = getattr(model, "stages", [])
    if len(stages) != 2 or not isinstance(stages[0], VectorAssembler) or not isinstance(stages[1], RandomForestClassificationModel):
        return None
    if stages[0].getHandleInvalid() != "keep" or stages[1].isSet("thresholds") or stages[1].getFeaturesCol() != stages[0].getOutputCol():
        return None
    return (stages[0].getInputCols(), stages[1]) if stages[1].numFeatures == len(stages[0].getInputCols()) else None


def arrays(spark, forest) -> tuple[list[np.ndarray], list[tuple]] | None:
    """Cuts of each feature and the trees, read from the saved model (a row for each node).

    A tree is (feature, code up to which rows go left, children, class shares, depth); a leaf is its own
    child.  None where a test is one of categories.
    """
    from tabsmith.operators.forest import ForestModel
    if isinstance(forest, ForestModel):
        top = np.iinfo(np.uint16).max
        return forest.cuts, [(feature, np.where(tree["feature"] >= 0, cut, top), child.T.ravel(), np.ascontiguousarray(share.T), depth)
                             for tree, (feature, cut, child, share, depth) in zip(forest.trees, forest.walks(), strict=True)]
    path = scratch_dir(spark, "forest")
    forest.write().save(path)
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "leftChild", "rightChild", "impurityStats", F.col("split.featureIndex").alias("feature"),
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("cut"), F.col("split.numCategories").alias("categories"))
    t = node.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    col = {c: t[c].to_numpy() for c in ("treeID", "leftChild", "rightChild", "feature", "cut", "categories")}
    inner = col["leftChild"] >= 0
    if (col["categories"][inner] != -1).any():
        return None
    cuts = [np.unique(col["cut"][inner & (col["feature"] == f)]) for f in range(forest.numFeatures)]
    stats = np.array(t["impurityStats"].to_pylist(), dtype=float).reshape(len(inner), -1)
    total = np.zeros(len(stats))
    for k in range(stats.shape[1]):
        total = total + stats[:, k]
    share = np.divide(stats, total[:, None], out=np.zeros_like(stats), where=total[:, None] != 0)
    trees = []
    for i in range(int(col["treeID"].max()) + 1):
        at = np.flatnonzero(col["treeID"] == i)
        own, test = np.arange(len(at)), inner[at]
        feature = np.where(test, col["feature"][at], 0)
        code = np.full(len(at), np.iinfo(np.uint16).max, np.int64)
        for f in range(len(cuts)):
            here = test & (feature == f)
            code[here] = np.searchsorted(cuts[f], col["cut"][at][here])
        kids = np.concatenate([np.where(test, col["leftChild"][at], own), np.where(test, col["rightChild"][at], own)])
        depth, level = 0, np.zeros(1, np.int64)
        while test[level].any():
            level = np.unique(np.concatenate([kids[level], kids[level + len(at)]])[np.tile(test[level], 2)])
            depth += 1
        trees.append((feature.astype(np.int64), code, kids.astype(np.int64), np.ascontiguousarray(share[at].T), depth))
    return cuts, trees


def coded(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of cuts below each value (``value <= cuts[j]`` where it is ``j`` at most)."""
    return np.searchsorted(cuts, values).astype(np.uint16)


def leaves(tree: tuple, codes: np.ndarray, other: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Node where each row ends for each feature and repeat: (rows, features * repeats).

    ``other[i, place[f], r]`` is the code of feature ``f`` in repeat ``r``; the last place holds no feature.
    """
    feature, cut, kids, _, depth = tree
    n, (rows, width), (_, places, repeats) = len(feature), codes.shape, other.shape
    flat, first = codes.ravel(), np.arange(rows) * width
    pairs, gone = other.reshape(rows * places, repeats), np.zeros((rows * places, repeats), bool)
    gone.reshape(other.shape)[:, -1] = True
    at = np.zeros(rows, np.int64)
    none = np.zeros(0, np.int64)
    row, slot, own, value, node = none, none, none, none.astype(codes.dtype), none
    for _ in range(depth):
        if len(node):
            f = feature[node]
            v = np.where(f == own, value, flat[row * width + f])
            node = kids[node + n * (v > cut[node])]
        f, c = feature[at], cut[at]
        right = flat[first + f] > c
        line = np.arange(rows) * places + place[f]
        turned = ((pairs[line] > c[:, None]) != right[:, None]) & ~gone[line]
        r, k = np.nonzero(turned)
        if len(r):
            there = line[r]
            gone[there, k] = True
            row, slot, own = np.concatenate([row, r]), np.concatenate([slot, place[f[r]] * repeats + k]), np.concatenate([own, f[r]])
            value = np.concatenate([value, pairs[there, k]])
            node = np.concatenate([node, kids[at[r] + n * ~right[r]]])
        at = kids[at + n * right]
    out = np.repeat(at[:, None], (places - 1) * repeats, axis=1)
    out[row, slot] = node
    return out


def hits(trees: list[tuple], codes: np.ndarray, other: np.ndarray, place: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Rows predicted right, for each feature and repeat.  ``label`` is the class number."""
    slots = (other.shape[1] - 1) * other.shape[2]
    found, step = np.zeros(slots, np.int64), max(64, BATCH // max(1, slots))
    for i in range(0, len(codes), step):
        part, those = codes[i:i + step], other[i:i + step]
        votes = [np.zeros((len(part), slots)) for _ in trees[0][3]]
        for tree in trees:
            leaf = leaves(tree, part, those, place)
            for vote, share in zip(votes, tree[3], strict=True):
                vote += share[leaf]
        best, most = np.zeros((len(part), slots), np.int64), votes[0].copy()   # the first of equals, as the model does
        for k in range(1, len(votes)):
            more = votes[k] > most
            best[more], most[more] = k, votes[k][more]
        found += (best == label[i:i + step, None]).sum(axis=0)
    return found


def block_rows(n: int, cores: int) -> int:
    """Rows of a block: a number of blocks for each core, none of more than ``BLOCK_ROWS`` rows."""
    return max(LEAST_ROWS, min(BLOCK_ROWS, -(-n // (cores * CORE_BLOCKS))))


def slot_counts(rows: DataFrame, n: int, id_col: str, label: str, inputs: list[str], features: list[str], repeats: int, seed: int,
                cuts: list[np.ndarray], trees: list[tuple]) -> DataFrame:
    """``(slot, right, seen)``, several rows for each slot: rows with a label, and of these the ones predicted right.

    Slot ``c * repeats + r`` is column ``c`` in repeat ``r`` (``permute.dealt_values``).  ``rows`` have the numbers
    0 .. n-1 in ``id_col`` and doubles in the other columns.
    """
    width, k, classes = len(inputs), len(features), len(trees[0][3])
    cores = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    size = block_rows(n, cores)
    parts = min(max(cores, -(-n // size)), 1 << 14)
    of = [inputs.index(f) if f in inputs else -1 for f in features]
    place = np.array([features.index(f) if f in features else k for f in inputs], np.int64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            i = b.column(0).to_numpy()
            y = b.column(1).to_numpy(zero_copy_only=False)
            known = ~np.asarray(b.column(1).is_null().to_numpy(zero_copy_only=False))
            kind = np.full(len(i), classes, np.int16)      # a label that is no class is never predicted
            for c in range(classes):
                kind[y == c] = c
            kind[~known] = -1
            codes = [coded(b.column(c + 2).to_numpy(zero_copy_only=False), cuts[c]) for c in range(width)]
            to, slot, code = [], [], []
            for c in range(k):
                if of[c] < 0:
                    continue
                for r in range(repeats):
                    to.append(permute.permuted(i, n, (seed, c, r)))
                    slot.append(np.full(len(i), c * repeats + r, np.uint16))
                    code.append(codes[of[c]])
            own = np.column_stack([*codes, kind.view(np.uint16)]) if width else kind.view(np.uint16)[:, None]
            for what, ids, parts in (("own", i, (own,)), ("other", np.concatenate([*to, i[:0]]),
                                                          (np.concatenate([*slot, own[:0, 0]]), np.concatenate([*code, own[:0, 0]])))):
                block = ids // size
                order = np.argsort(block, kind="stable")
                names, starts = np.unique(block[order], return_index=True)
                ends = [*starts[1:].tolist(), len(order)]
                where = (ids - block * size).astype(np.uint16)
                out = [[], [], [], []]
                for s, e in zip(starts.tolist(), ends, strict=True):
                    at = order[s:e]
                    data = [where[at].tobytes(), *[p[at].tobytes() for p in parts], *[None] * (2 - len(parts))]
                    for have, x in zip(out, [what, *data], strict=True):
                        have.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(out[0], pa.string()),
                                                  *[pa.array(x, pa.binary()) for x in out[1:]]],
                                                 names=["id_block", "what", "place", "a", "b"])

    def score(got: pa.Table) -> pa.Table:
        base = got["id_block"][0].as_py() * size
        held = min(size, n - base)
        own, other = np.zeros((held, width + 1), np.uint16), np.zeros((held, k + 1, repeats), np.uint16)
        flat = other.reshape(held, (k + 1) * repeats)
        for row in got.select(["what", "place", "a", "b"]).to_pylist():
            at, a = np.frombuffer(row["place"], np.uint16), np.frombuffer(row["a"], np.uint16)
            if row["what"] == "own":
                own[at] = a.reshape(len(at), width + 1)
            else:
                flat[at, a] = np.frombuffer(row["b"], np.uint16)
        label = own[:, width].view(np.int16).astype(np.int64)
        keep = label >= 0
        right = hits(trees, np.ascontiguousarray(own[keep, :width]), np.ascontiguousarray(other[keep]), place, label[keep])
        slots = k * repeats
        return pa.table({"slot": pa.array(np.arange(slots), pa.int32()), "right": pa.array(right, pa.int64()),
                         "seen": pa.array(np.full(slots, keep.sum()), pa.int64())})
    narrow = rows.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{label}`").cast("double"),
                         *[F.col(f"`{c}`").alias(f"x{j}") for j, c in enumerate(inputs)])
    sent = narrow.mapInArrow(send, "id_block long, what string, place binary, a binary, b binary")
    return sent.repartition(parts, "id_block").groupBy("id_block").applyInArrow(score, "slot int, right long, seen long")
