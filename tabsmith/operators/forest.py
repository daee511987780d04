"""Random forest of large frames: all nodes of a level of every tree from one pass over the rows (K2).

Rows are binned once and kept in units, as in ``boosting``.  A unit also holds a word for each tree and
row: how often the tree's bootstrap drew the row (Poisson with mean 1) and the row's open node.  A level
is one job: tasks move the rows on by the last level's splits and count classes by (node, drawn feature,
bin), one tree after another, so that the counts of a tree stay in the processor's cache; counts are
merged by tree and the best splits found in tasks.  What the driver holds is the nodes of the trees.

Settings are those of Spark's forest: ceil(sqrt(features)) features drawn for each node, ``max_bins`` bins,
Gini impurity, children of one row or more, any gain above 0, and votes by the leaves' class shares;
missing values go right at every cut.  The module is pickled by value.
"""

from __future__ import annotations

import json
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators.boosting import KEPT, TASK_ROWS, UNIT_ROWS, _blocks, feature_cuts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a task's counts, and levels up to which a word holds a row's node.
COUNT_BYTES, MOST_DEPTH = 1 << 27, 20


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of cuts below every value; a missing value is above all."""
    return np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]).astype(np.uint8) if cuts else np.zeros(x.shape, np.uint8)


def forest_cuts(df: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """At most ``max_bins`` - 1 cuts of each feature: all values but the last where they are few, else quantiles."""
    value = [F.col(f"`{f}`").cast("double") for f in features]
    value = [F.when(~F.isnan(v), v) for v in value]
    about = df.agg(*[F.approx_count_distinct(v).alias(f"n{i}") for i, v in enumerate(value)]).first()
    few = [i for i in range(len(features)) if about[i] <= 2 * max_bins]   # sets of at most some 2 * max_bins values
    sets = df.agg(*[F.collect_set(value[i]).alias(f"s{i}") for i in few]).first() if few else []
    cuts = feature_cuts(df, features, max_bins + 1)
    for i, values in zip(few, sets, strict=True):
        if len(values) <= max_bins:
            cuts[i] = np.sort(np.array(values, float))[:-1]
    return cuts


# -- units of rows ----------------------------------------------------------------------

def _units(rows, n_features: int, n_bins: int, n_classes: int, n_trees: int, bits: int, seed: int):
    """Units of stored blocks; bins are held times the number of classes, feature by feature."""
    held, n = [], 0
    word = np.uint16 if bits + 4 <= 16 else np.uint32
    most = (1 << (8 * np.dtype(word).itemsize - bits)) - 1

    def unit():
        y = np.concatenate([h[1] for h in held])
        bins = np.concatenate([h[2] for h in held]).T.astype(np.uint8 if n_bins * n_classes <= 256 else np.int32) * n_classes
        draws = np.concatenate([np.random.default_rng((seed, h[0])).poisson(1.0, (n_trees, len(h[1]))) for h in held], axis=1)
        w = np.concatenate([h[3] for h in held])
        return {"bins": np.ascontiguousarray(bins), "y": y, "w": None if (w == 1).all() else w, "bits": bits,
                "at": np.minimum(draws, most).astype(word) << word(bits)}
    for r in rows:
        y = np.frombuffer(r["y"], np.int32)
        if held and n + len(y) > UNIT_ROWS:
            yield unit()
            held, n = [], 0
        held.append((r["block"], y, np.frombuffer(r["bins"], np.uint8).reshape(len(y), n_features), np.frombuffer(r["w"], float)))
        n += len(y)
    if held:
        yield unit()


def _moved(units, splits: list[tuple]):
    """Units with every row in its node of the next level; a row whose node stays a leaf is dropped from the tree."""
    for u in units:
        at, n, bits = np.zeros_like(u["at"]), u["bins"].shape[1], u["bits"]
        flat, low, word = u["bins"].ravel(), (1 << bits) - 1, u["at"].dtype.type
        for t, (feature, cut, child) in enumerate(splits):
            if not len(feature):
                continue
            live = np.flatnonzero(u["at"][t])
            was = u["at"][t].take(live)
            node = (was & word(low)).astype(np.intp)
            right = flat.take((feature * n).take(node) + live) > cut.take(node)
            to = child.take(2 * node + right)
            stays = to >= 0
            at[t][live[stays]] = (was[stays] & word(~low & int(np.iinfo(word).max))) | to[stays].astype(word)
        yield {**u, "at": at}


def _counts(units, drawn: list[np.ndarray], trees: list[int], n_bins: int, n_classes: int, weighted: bool):
    """``(tree, counts)`` of a partition: nodes x drawn features x bins x classes."""
    out = {}
    for u in units:
        n, word = u["bins"].shape[1], u["at"].dtype.type
        flat, low = u["bins"].ravel(), word((1 << u["bits"]) - 1)
        for t in trees:
            nodes, m = drawn[t].shape
            if t not in out:
                out[t] = np.zeros(nodes * m * n_bins * n_classes, float if weighted else np.int64)
            live = np.flatnonzero(u["at"][t])
            was = u["at"][t].take(live)
            node = (was & low).astype(np.intp)
            times = (was >> word(u["bits"])).astype(np.int64)
            if weighted:
                times = times * (1.0 if u["w"] is None else u["w"].take(live))
            cell = node * (m * n_bins * n_classes) + u["y"].take(live)
            first = np.ascontiguousarray(drawn[t].T) * n
            for j in range(m):
                bins = flat.take(first[j].take(node) + live)
                np.add.at(out[t], cell + bins, times)
                cell += n_bins * n_classes
    for t, counts in out.items():
        # most counts of a deep level are small
        yield t, counts.astype(np.uint16 if not weighted and counts.max(initial=0) < 1 << 15 else counts.dtype)


def _gini(x: np.ndarray) -> np.ndarray:
    """Weight times Gini impurity."""
    total = x.sum(axis=-1)
    return total - np.divide((x * x).sum(axis=-1), total, out=np.zeros_like(total), where=total > 0)


def best_splits(counts: np.ndarray, drawn: np.ndarray, n_bins: int, n_classes: int) -> tuple[np.ndarray, ...]:
    """``(feature, cut, gain, left counts, all counts)`` of each node's best split; feature -1 where none gains."""
    x = counts.reshape(*drawn.shape, n_bins, n_classes).astype(float)
    total = x[:, 0].sum(axis=1)
    left = np.cumsum(x, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    gain = np.full(left.shape[:3], -np.inf)
    ok = (left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0)
    lost = _gini(total)[:, None, None] - _gini(left) - _gini(right)
    weight = np.maximum(total.sum(axis=-1), 1e-300)[:, None, None]
    np.copyto(gain, lost / weight, where=ok)
    nodes = np.arange(len(x))
    if not gain.shape[2]:
        return np.full(len(x), -1), nodes * 0, nodes * 0.0, total * 0, total
    best = gain.reshape(len(x), -1).argmax(axis=1)
    j, cut = np.divmod(best, gain.shape[2])
    top = gain[nodes, j, cut]
    found = top > 1e-15
    return np.where(found, drawn[nodes, j], -1), cut, np.where(found, top, 0.0), left[nodes, j, cut], total


# -- the model --------------------------------------------------------------------------

class ForestModel:
    """Trees as arrays: feature (-1 for a leaf), last bin that goes left, left child (the right one is next), class counts, gain."""

    def __init__(self, features: list[str], cuts: list[np.ndarray], trees: list[dict[str, np.ndarray]], n_classes: int):
        self.features, self.cuts, self.trees, self.n_classes = features, cuts, trees, n_classes

    def walks(self) -> list[tuple]:
        """``(feature, cut, children, class shares, depth)`` of each tree; a leaf is its own child."""
        out = []
        for t in self.trees:
            inner, own = t["feature"] >= 0, np.arange(len(t["feature"]))
            child = np.column_stack([np.where(inner, t["left"], own), np.where(inner, t["left"] + 1, own)])
            depth = np.zeros(len(own), int)
            for node in np.flatnonzero(inner):
                depth[t["left"][node]] = depth[t["left"][node] + 1] = depth[node] + 1
            total = t["counts"].sum(axis=1, keepdims=True)
            share = np.divide(t["counts"], total, out=np.zeros_like(t["counts"]), where=total != 0)
            out.append((np.where(inner, t["feature"], 0), np.where(inner, t["cut"], 255), child, share, int(depth.max())))
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _votes(to_bins(x, self.cuts), self.walks(), self.n_classes)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (an array) and ``prediction``."""
        cuts, walks, n_classes = self.cuts, self.walks(), self.n_classes

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(list(_votes(to_bins(rows.to_numpy(float, na_value=np.nan), cuts), walks, n_classes)))
        cols = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(self.features)])
        out = df.withColumn("probability", score(cols))
        return out.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))

    def gains(self) -> np.ndarray:
        """Importance of each feature: its share of a tree's gain by rows, averaged over the trees."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            inner, one = t["feature"] >= 0, np.zeros(len(total))
            np.add.at(one, t["feature"][inner], t["gain"][inner] * t["counts"][inner].sum(axis=1))
            total += one / one.sum() if one.sum() else 0
        return total / total.sum() if total.sum() else total

    def save(self, spark: SparkSession, path: str) -> str:
        """A row of JSON for the head and for every tree."""
        head = {"features": self.features, "cuts": [c.tolist() for c in self.cuts], "n_classes": self.n_classes}
        rows = [(i, json.dumps({k: v.tolist() for k, v in t.items()})) for i, t in enumerate(self.trees)]
        spark.createDataFrame([(-1, json.dumps(head)), *rows], "tree int, body string").write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        rows = spark.read.parquet(path).orderBy("tree").collect()   # a row for each tree
        head = json.loads(rows[0]["body"])
        kinds = {"counts": float, "gain": float}
        trees = [{k: np.array(v, kinds.get(k, np.int64)) for k, v in json.loads(r["body"]).items()} for r in rows[1:]]
        return ForestModel(head["features"], [np.array(c, float) for c in head["cuts"]], trees, head["n_classes"])


def _votes(bins: np.ndarray, walks: list[tuple], n_classes: int) -> np.ndarray:
    """Mean class shares of the leaves of all trees."""
    n, at = len(bins), np.arange(len(bins))
    flat, total = np.ascontiguousarray(bins.T).ravel(), np.zeros((n, n_classes))
    for feature, cut, child, share, depth in walks:
        node, first, kids = np.zeros(n, np.intp), feature * n, child.ravel()
        for _ in range(depth):
            node = kids.take(2 * node + (flat.take(first.take(node) + at) > cut.take(node)))
        total += share.take(node, axis=0)
    return total / max(len(walks), 1)


def train(df: DataFrame, features: list[str], label: str, trees: int = 100, max_depth: int = 10, weight_col: str | None = None,
          seed: int = 42, max_bins: int = 32, n_classes: int | None = None) -> ForestModel:
    """Grow a forest level by level; the label holds 0, 1, ..., ``n_classes`` - 1, rows without one are left out."""
    from tabsmith.session import checkpoint_root, scratch_dir, spread
    if not (0 <= max_depth <= MOST_DEPTH and 2 <= max_bins <= 254):
        raise ValueError(f"max_depth must be 0 to {MOST_DEPTH}, max_bins 2 to 254")
    spark, f = df.sparkSession, len(features)
    checkpoint_root(spark)
    rows = df.where(F.col(f"`{label}`").isNotNull())
    n_classes = n_classes or int(rows.agg(F.max(F.col(f"`{label}`"))).first()[0] or 0) + 1
    weight = F.col(f"`{weight_col}`").cast("double") if weight_col else F.lit(1.0)
    names = [f"x{i}" for i in range(f)]
    narrow = rows.select(F.col(f"`{label}`").cast("double").alias("y"), weight.alias("w"),
                         *[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(features, names, strict=True)])
    cuts = forest_cuts(narrow, names, max_bins)
    path = scratch_dir(spark, "forest-blocks")
    _blocks(spread(narrow), cuts, to_bins).write.parquet(path)
    stored = spark.read.parquet(path)
    n = (stored.agg(F.sum(F.octet_length("y"))).first()[0] or 0) // 4
    wide = max((len(c) for c in cuts), default=0) + 1
    state = stored.rdd.coalesce(max(1, n // TASK_ROWS)).mapPartitions(lambda part: _units(part, f, wide, n_classes, trees, max_depth, seed))
    m = f if trees == 1 else max(1, math.ceil(math.sqrt(f)))
    grown = [{"feature": [-1], "cut": [0], "left": [0], "counts": [np.zeros(n_classes)], "gain": [0.0]} for _ in range(trees)]
    open_ = [[0] for _ in range(trees)]
    kept = [state.persist(KEPT)]
    try:
        for level in range(max_depth if n else 0):
            drawn = [np.random.default_rng((seed, t, level)).random((len(o), f)).argsort(axis=1)[:, :m] for t, o in enumerate(open_)]
            found = {}
            todo = [t for t in range(trees) if open_[t]]
            while todo:   # trees whose counts a task can hold
                some, size = [], 0
                while todo and (not some or size + len(open_[todo[0]]) * m * wide * n_classes * 8 <= COUNT_BYTES):
                    size += len(open_[todo[0]]) * m * wide * n_classes * 8
                    some.append(todo.pop(0))
                parts = kept[-1].mapPartitions(lambda units, some=some, drawn=drawn: _counts(units, drawn, some, wide, n_classes, weight_col is not None))
                merged = parts.reduceByKey(lambda a, b: np.add(a, b, dtype=float if weight_col else np.int64),
                                           min(len(some), spark.sparkContext.defaultParallelism))
                best = merged.map(lambda c, drawn=drawn: (c[0], best_splits(c[1], drawn[c[0]], wide, n_classes)))
                found.update(best.collect())   # a few numbers for each node
            splits = []
            for t, tree in enumerate(grown):
                if t not in found:
                    open_[t] = []
                    splits.append((np.zeros(0, np.intp),) * 3)
                    continue
                feature, cut, gain, left, total = found[t]
                child, next_ = np.full(2 * len(feature), -1), []
                for i, node in enumerate(open_[t]):
                    tree["counts"][node] = total[i]
                    if feature[i] < 0:
                        continue
                    tree["feature"][node], tree["cut"][node], tree["gain"][node], tree["left"][node] = int(feature[i]), int(cut[i]), float(gain[i]), len(tree["cut"])
                    for side, counts in enumerate((left[i], total[i] - left[i])):
                        if level + 1 < max_depth and np.count_nonzero(counts > 0) > 1:   # a pure node stays a leaf
                            child[2 * i + side] = len(next_)
                            next_.append(len(tree["cut"]))
                        for column, fill in (("feature", -1), ("cut", 0), ("left", 0), ("counts", counts), ("gain", 0.0)):
                            tree[column].append(fill)
                splits.append((np.maximum(feature, 0).astype(np.intp), cut.astype(np.intp) * n_classes, child))
                open_[t] = next_
            if not any(open_):
                break
            kept.append(kept[-1].mapPartitions(lambda units, splits=splits: _moved(units, splits)).persist(KEPT))
            if len(kept) > 2:
                kept.pop(0).unpersist()
    finally:
        for k in kept:
            k.unpersist()
    done = [{"feature": np.array(t["feature"]), "cut": np.array(t["cut"]), "left": np.array(t["left"]), "counts": np.array(t["counts"], float),
             "gain": np.array(t["gain"])} for t in grown]
    return ForestModel(list(features), cuts, done, n_classes)
