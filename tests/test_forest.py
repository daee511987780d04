"""Forests grown on blocks of rows: against slow second versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import forest, models
from tabsmith.sources import io

NAMES = ["a", "b", "c", "y y"]


def frame(spark, n=300, k=3, seed=5):
    """Rows of one partition, with missing values and few and many different ones."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.random(n).round(2), rng.integers(0, 2, n)]).astype(float)
    y = (x[:, 0] + x[:, 1] / 3 + rng.normal(size=n) * 0.7 > np.linspace(0, 2, k)[:, None]).sum(axis=0) % k
    x[rng.random(n) < 0.1, 2] = np.nan
    pdf = pd.DataFrame(x, columns=NAMES).assign(label=y.astype(float), w=rng.integers(1, 4, n) * 0.5, id=range(n))
    return spark.createDataFrame(pdf).coalesce(1), pdf


def gini(counts):
    return 1 - ((counts / counts.sum()) ** 2).sum() if counts.sum() else 0.0


@pytest.mark.parametrize("weight", [None, "w"])
def test_block_forest_equals_plain(spark, weight):
    """Every node's counts are those of its drawn rows, and no cut of its drawn features gains more than its own."""
    df, pdf = frame(spark)
    trees, depth, k, seed = 4, 4, 3, 7
    m = forest.train(df, NAMES, "label", trees, depth, weight, seed)
    assert [len(c) for c in m.cuts][1] == 5 and len(m.cuts[3]) == 1 and len(m.cuts[0]) == 31
    bins = forest.to_bins(pdf[NAMES].to_numpy(), m.cuts).astype(int)
    y = pdf["label"].to_numpy(int)
    draws = np.random.default_rng((seed, 0)).poisson(1.0, (trees, len(y))) * (pdf[weight].to_numpy() if weight else 1.0)

    def counts(rows, w):
        return np.bincount(y[rows], w[rows], k)
    splits = 0
    for t, tree in enumerate(m.trees):
        w, open_ = draws[t], [(0, draws[t] > 0)]
        for level in range(depth):
            drawn = np.random.default_rng((seed, t, level)).random((len(open_), 4)).argsort(axis=1)[:, :2]
            below = []
            for (node, rows), features in zip(open_, drawn, strict=True):
                total = counts(rows, w)
                assert tree["counts"][node] == pytest.approx(total)
                gains = {}
                for f in features:
                    for cut in range(len(m.cuts[f])):
                        left, right = counts(rows & (bins[:, f] <= cut), w), counts(rows & (bins[:, f] > cut), w)
                        if left.sum() and right.sum():
                            gains[f, cut] = gini(total) - (left.sum() * gini(left) + right.sum() * gini(right)) / total.sum()
                if max(gains.values(), default=0) < 1e-12:
                    assert tree["feature"][node] == -1
                    continue
                f, cut = int(tree["feature"][node]), int(tree["cut"][node])
                assert gains[f, cut] == pytest.approx(max(gains.values())) == tree["gain"][node]
                splits += 1
                for child, part in ((tree["left"][node], rows & (bins[:, f] <= cut)), (tree["left"][node] + 1, rows & (bins[:, f] > cut))):
                    assert tree["counts"][child] == pytest.approx(counts(part, w))
                    if np.count_nonzero(counts(part, w)) > 1:
                        below.append((child, part))
            open_ = below
    assert splits > 20
    p = np.zeros((len(y), k))
    for tree in m.trees:
        for i in range(len(y)):
            node = 0
            while tree["feature"][node] >= 0:
                node = tree["left"][node] + (bins[i, tree["feature"][node]] > tree["cut"][node])
            p[i] += tree["counts"][node] / tree["counts"][node].sum() / trees
    assert m.probabilities(pdf[NAMES].to_numpy()) == pytest.approx(p)


def test_large_frames_get_a_forest_of_blocks(spark, monkeypatch, tmp_path):
    """From some size on a forest is grown on blocks; scores, folds, importances, votes and a reload work on it alike."""
    holed, pdf = frame(spark, n=600)
    pdf = pdf.fillna(0.5)
    df = spark.createDataFrame(pdf).coalesce(1)
    small = {"n_estimators": 12, "max_depth": 5}
    ml = models.train_forest(df, NAMES, "label", small)
    monkeypatch.setattr(models, "FOREST_ROWS", 100)
    m = models.train_forest(df, NAMES, "label", small)
    assert isinstance(m, forest.ForestModel) and not isinstance(ml, forest.ForestModel) and len(m.trees) == 12
    out = models.predictions(m, df, "label", 3, key="id").orderBy("id").toPandas()
    p = m.probabilities(pdf[NAMES].to_numpy())
    assert out[[f"prob_class_{i}" for i in range(3)]].to_numpy() == pytest.approx(p) and (out["predicted_label"] == p.argmax(axis=1)).all()
    got, other = ((models.predictions(x, df, "label", 3).where("true_label = predicted_label").count() / 600) for x in (m, ml))
    assert abs(got - other) < 0.06   # as good as Spark's own
    again = io.load_model(io.save_model(m, f"{tmp_path}/m"))
    assert (again.probabilities(pdf[NAMES].to_numpy()) == p).all()
    imp = {r["feature"]: r["importance"] for r in models.importances(m, NAMES).collect()}
    assert sum(imp.values()) == pytest.approx(1) and imp["a"] == max(imp.values())
    fast = {r["feature"]: r["importance_mean"] for r in models.permutation_importance(m, df, NAMES, "label", "id", 2, 3).collect()}
    monkeypatch.setattr(models, "_forest_accuracy", lambda *a: None)
    slow = {r["feature"]: r["importance_mean"] for r in models.permutation_importance(m, df, NAMES, "label", "id", 2, 3).collect()}
    assert fast == pytest.approx(slow) and fast["a"] > 0.05
    seen, train = [], forest.train
    monkeypatch.setattr(forest, "train", lambda *a, **k: seen.append(1) or train(*a, **k))
    monkeypatch.setitem(models.FOREST_PARAMS, "n_estimators", 5)
    scores = models.cv_performance(df, NAMES, "label", "id", n_folds=2).collect()
    with pytest.raises(Exception, match="NaN"):   # refused at any size, by Spark's forest
        models.train_forest(holed, NAMES, "label", small)
    assert len(scores) == 2 and len(seen) == 2 and all(r["f1_train"] > 0.4 for r in scores)


def test_block_forest_of_odd_input(spark):
    schema = "a double, flat double, y double"
    none = forest.train(spark.createDataFrame([], schema), ["a", "flat"], "y", 3, 2, n_classes=2)
    assert len(none.trees) == 3 and none.probabilities(np.zeros((2, 2))).tolist() == [[0.0, 0.0]] * 2
    rows = [(None, 1.0, 1.0)] * 40 + [(float(i % 5), 1.0, 0.0) for i in range(40)] + [(1.0, 1.0, None)]
    m = forest.train(spark.createDataFrame(rows, schema).repartition(3), ["a", "flat"], "y", 5, 3)
    assert m.probabilities(np.array([[np.nan, 1.0], [2.0, 1.0]])).argmax(axis=1).tolist() == [1, 0] and m.gains()[1] == 0
    one = forest.train(spark.createDataFrame(rows, schema).where(F.col("y") == 1), ["a", "flat"], "y", 2, 3)
    assert all(len(t["feature"]) == 1 for t in one.trees) and one.probabilities(np.zeros((1, 2))).tolist() == [[0.0, 1.0]]
    with pytest.raises(ValueError):
        forest.train(spark.createDataFrame(rows, schema), ["a"], "y", 2, 40)


def test_fold_votes_of_block_forests_are_summed(spark, monkeypatch):
    """A fold ensemble of a large frame grows a forest of blocks for each fold; its scores are the sum of theirs."""
    _, pdf = frame(spark, n=400)
    pdf = pdf.fillna(0.5)
    df, made, train = spark.createDataFrame(pdf).coalesce(1), [], forest.train
    monkeypatch.setattr(models, "FOREST_ROWS", 100)
    monkeypatch.setitem(models.FOREST_PARAMS, "n_estimators", 5)
    monkeypatch.setattr(forest, "train", lambda *a, **k: made.append(train(*a, **k)) or made[-1])
    out = models.fold_ensemble(df, df.where("id < 60"), NAMES, "label", "id", 3, n_folds=3).orderBy("id").toPandas()
    assert len(made) == 3
    p = sum(m.probabilities(pdf[NAMES].to_numpy()[:60]) for m in made)
    assert out[[f"prob_class_{i}" for i in range(3)]].to_numpy() == pytest.approx(p) and (out["predicted_label"] == p.argmax(axis=1)).all()
