"""Softmax boosting, lasso paths: against slow second versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import boosting, lasso, models, select
from tabsmith.sources import io


def frame(spark, n=240, k=3, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 6, n), rng.random(n), np.ones(n)])
    y = (x[:, 0] + x[:, 1] / 3 + rng.normal(size=n) * 0.7 > np.linspace(0, 2, k)[:, None]).sum(axis=0) % k
    x[rng.random(n) < 0.1, 2] = np.nan
    names = ["a", "b", "c", "flat"]
    pdf = pd.DataFrame(x, columns=names).assign(y=y.astype(float), w=rng.integers(1, 4, n) * 0.5)
    return spark.createDataFrame(pdf).repartition(3), pdf, names


def plain_boosting(x, y, w, k, rounds, s):
    """Trees by going through all rows for every cut of every node, without sums to reuse."""
    scores, counts, gains, losses = np.zeros((len(y), k)), np.zeros(x.shape[1], int), np.zeros(x.shape[1]), []

    def mean_loss():
        p = boosting.softmax(scores)
        return -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum()

    def split(rows, g, h):
        best = None
        for f in range(x.shape[1]):
            for cut in range(x[:, f].max()):
                left = rows & (x[:, f] <= cut)
                right = rows & ~left
                if h[left].sum() < s.min_child_weight - 1e-9 or h[right].sum() < s.min_child_weight - 1e-9:
                    continue
                gain = 0.5 * (sum(g[m].sum() ** 2 / (h[m].sum() + s.reg_lambda) for m in (left, right))
                              - g[rows].sum() ** 2 / (h[rows].sum() + s.reg_lambda))
                if gain > 1e-10 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, left, right)
        return best
    for _ in range(rounds):
        losses.append(mean_loss())
        p, step = boosting.softmax(scores), np.zeros_like(scores)
        for c in range(k):
            g, h = w * (p[:, c] - (y == c)), w * p[:, c] * (1 - p[:, c])
            open_, leaves = [(np.ones(len(y), bool), 0)], []
            while open_:
                found = [(split(r, g, h) if d < s.max_depth else None, r, d) for r, d in open_]
                if s.leaf_wise:
                    leaves += [r for b, r, d in found if not b]
                    found = [z for z in found if z[0]]
                    if not found or len(leaves) + len(found) >= s.max_leaves:
                        leaves += [r for _, r, _ in found]
                        break
                    at = max(range(len(found)), key=lambda i: found[i][0][0])
                    take, open_ = [found[at]], [(r, d) for i, (_, r, d) in enumerate(found) if i != at]
                else:
                    leaves += [r for b, r, d in found if not b]
                    take, open_ = [z for z in found if z[0]], []
                for (gain, f, left, right), _, d in take:
                    counts[f] += 1
                    gains[f] += gain
                    open_ += [(left, d + 1), (right, d + 1)]
            for r in leaves:
                step[r, c] = -s.learning_rate * g[r].sum() / (h[r].sum() + s.reg_lambda)
        scores += step
    losses.append(mean_loss())
    return boosting.softmax(scores), counts, gains, losses


@pytest.mark.parametrize("kind", [{"max_depth": 3}, {"max_depth": 64, "max_leaves": 7, "leaf_wise": True}])
def test_boosting_equals_plain(spark, kind):
    df, pdf, names = frame(spark)
    m = boosting.train(df, names, "y", 3, "w", rounds=6, learning_rate=0.4, max_bins=16, **kind)
    bins = boosting.to_bins(pdf[names].to_numpy(), m.cuts).astype(int)
    s = boosting.Settings(kind["max_depth"], kind.get("max_leaves"), kind.get("leaf_wise", False), 1.0, 1.0, 0.4)
    p, counts, gains, losses = plain_boosting(bins, pdf["y"].to_numpy(int), pdf["w"].to_numpy(), 3, 6, s)
    assert m.split_counts().tolist() == counts.tolist() and counts[3] == 0
    assert m.gains() == pytest.approx(gains / gains.sum(), rel=1e-9)
    assert m.losses == pytest.approx(losses, rel=1e-9) and all(a > b for a, b in zip(losses, losses[1:], strict=False))
    assert m.probabilities(pdf[names].to_numpy()) == pytest.approx(p, rel=1e-9)
    table = m.split_table(spark).groupBy("feature").count().collect()
    assert {r["feature"]: r["count"] for r in table} == {n: c for n, c in zip(names, counts.tolist(), strict=True) if c}


def test_boosting_over_many_rounds_and_a_reload(spark, tmp_path):
    """Scores that are brought up to date and checkpointed give what all trees give."""
    df, pdf, names = frame(spark, n=400)
    m = boosting.train(df, names, "y", 3, rounds=23, max_depth=2, subsample=0.7, colsample=0.6, seed=3)
    assert len(m.trees) == 23 and len(m.losses) == 24
    p = m.probabilities(pdf[names].to_numpy())
    assert m.losses[-1] == pytest.approx(-np.log(p[np.arange(400), pdf["y"].to_numpy(int)]).mean(), rel=1e-9)
    again = io.load_boosted(spark, io.save_model(m, f"{tmp_path}/m"))
    assert (again.probabilities(pdf[names].to_numpy()) == p).all() and again.losses == m.losses
    out = models.predictions(again, df, "y", 3).toPandas()
    assert (out["prediction_confidence"] > 1 / 3 - 1e-9).all()
    assert np.allclose(out[[f"prob_class_{i}" for i in range(3)]].sum(axis=1), 1)


def test_boosting_of_odd_input(spark):
    schema = "a double, flat double, y double"
    none = boosting.train(spark.createDataFrame([], schema), ["a", "flat"], "y", 2, rounds=3)
    assert none.trees == [] and none.probabilities(np.zeros((2, 2))).tolist() == [[0.5, 0.5]] * 2
    blank = boosting.train(spark.createDataFrame([(None, 1.0, 0.0), (None, 1.0, 1.0), (None, 1.0, None)], schema), ["a", "flat"], "y", rounds=2)
    assert blank.split_counts().tolist() == [0, 0] and blank.losses[0] == pytest.approx(np.log(2))
    missing = [(None, 1.0, 1.0)] * 40 + [(float(i % 5), 1.0, 0.0) for i in range(40)]
    m = boosting.train(spark.createDataFrame(missing, schema), ["a", "flat"], "y", rounds=5, max_depth=2, learning_rate=0.5)
    assert m.losses[-1] < 0.2 and m.split_counts()[0] > 0   # a cut between missing and known
    with pytest.raises(ValueError):
        boosting.train(spark.createDataFrame(missing, schema), ["a"], "y", max_bins=300)


def test_boosted_importance_counts(spark):
    df, _, names = frame(spark)
    got = {r["feature"]: r for r in select.boosted_importance(df, names, "y", {"rounds": 4}, keep=5).collect()}
    assert got["flat"]["splits"] == 0 and not got["flat"]["keep"] and sum(r["importance"] for r in got.values()) == pytest.approx(1)
    assert got["a"]["keep"] and got["a"]["splits"] >= 5


def test_large_training_sets_are_dealt_to_all_cores(spark):
    """One partition of many rows is dealt evenly before blocks are made and trees are grown; a small one stays."""
    from tabsmith.session import spread
    one = spark.range(0, 100_000, 1, 1).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    sizes = [r["count"] for r in spread(one).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 100_000 and max(sizes) < 30_000
    assert spread(one.limit(1000)).rdd.getNumPartitions() == 1 and spread(one, 10_000).rdd.getNumPartitions() == 6
    assert spread(one.limit(0)).count() == 0


def test_forests_trees_and_folds_get_even_partitions(spark, monkeypatch, tmp_path):
    """Rows in one large partition are dealt to all cores before a forest, a tree or the folds read them."""
    from pyspark.ml import Pipeline
    one = spark.range(0, 100_000, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    seen, fit = [], Pipeline.fit

    def look(self, df, *more):
        last = self.getStages()[-1]
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((type(last).__name__, len(sizes), max(sizes) < 30_000, last.hasParam("cacheNodeIds") and last.getCacheNodeIds()))
        return fit(self, df, *more)
    monkeypatch.setattr(Pipeline, "fit", look)
    small = {"n_estimators": 2, "max_depth": 2}
    models.train_forest(one, ["x"], "y", small)
    select.tree_importance(one, ["x"], "y")
    models.cv_performance(one, ["x"], "y", "id", n_folds=2, trainer=lambda d: models.train_forest(d, ["x"], "y", small))
    assert seen[0] == ("RandomForestClassifier", 4, True, True) and seen[1][:3] == ("DecisionTreeClassifier", 4, True)
    assert len(seen) == 4 and all(n == 4 and even and kept for _, n, even, kept in seen[2:])


def test_only_the_drawn_features_are_summed_on_scores_as_they_are():
    """A job neither scores earlier rounds again nor sums features that a tree may not use."""
    rng = np.random.default_rng(1)
    bins, y, k = rng.integers(0, 8, (500, 5)).astype(np.uint8), rng.integers(0, 3, 500).astype(np.int32), 3
    block = {"block": 0, "bins": bins, "y": y, "w": np.ones(500), "scores": rng.normal(size=(500, k))}
    tree = boosting.Tree()
    left, right = tree.split(0, 2, 3, 1.0)
    tree.split(right, 4, 5, 1.0)
    grown = boosting.steps(tree.arrays())
    at = np.where(bins[:, 2] <= 3, left, np.where(bins[:, 4] <= 5, right + 1, right + 2))
    assert (boosting.route(grown, bins) == at).all() and grown["depth"] == 2
    got, = boosting._sums(iter([block]), [grown] * k, [[left], [], [right + 2]], [[0, 3]] * k, 8, (42, 0), 1.0, True)
    p = boosting.softmax(block["scores"])
    for c, node in ((0, left), (2, right + 2)):
        for f in range(5):
            for b in range(8):
                rows = (at == node) & (bins[:, f] == b)
                g, h = (p[rows, c] - (y[rows] == c)).sum(), (p[rows, c] * (1 - p[rows, c])).sum()
                assert got[c][0, f, b] == pytest.approx([g, h] if f in (0, 3) else [0, 0])
    assert got[-1][1] == 500 and got[1].shape[0] == 0


def test_features_are_summed_in_packs_and_rows_found_by_masks():
    """Joint sums of a few packs give every feature's own sums; masks give the leaves of a walk; units stay small."""
    rng = np.random.default_rng(4)
    sizes, n, k = [9, 4, 64, 3, 40], 3000, 3
    packs = boosting.pack(sizes, 300)
    assert sorted(f for p in packs for f in p) == list(range(5)) and len(packs) == 3
    assert all(np.prod([sizes[f] for f in p]) <= 300 for p in packs)
    bins = np.asfortranarray(np.column_stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8))
    tree = boosting.Tree()
    left, right = tree.split(0, 2, 30, 1.0)
    tree.split(left, 0, 3, 1.0)
    tree.split(right, 4, 12, 1.0)
    grown = boosting.steps(tree.arrays())
    walked = np.where(bins[:, 2] <= 30, np.where(bins[:, 0] <= 3, 3, 4), np.where(bins[:, 4] <= 12, 5, 6))
    assert (boosting.route(grown, bins) == walked).all()
    block = {"block": 0, "bins": bins, "y": rng.integers(0, k, n).astype(np.int32), "w": rng.random(n), "scores": rng.normal(size=(n, k))}
    more = (iter([block]), [grown] * k, [[3, 6], [5], []], [[0, 2, 4], [1], [3]], 64, (42, 0), 0.7, True)
    alone, = boosting._sums(*more)
    joint, = boosting._sums(iter([{**block, "codes": boosting._codes(bins, sizes, packs)}]), *more[1:], sizes, packs)
    assert all(a.shape == b.shape and a == pytest.approx(b) for a, b in zip(alone, joint, strict=True)) and alone[0].any()
    stored = [{"block": i, "y": np.zeros(10_000, np.int32).tobytes(), "bins": np.zeros((10_000, 5), np.uint8).tobytes(), "w": np.ones(10_000).tobytes()}
              for i in range(8)]
    units = list(boosting._unpack(iter(stored), k, sizes, packs))
    assert [len(u["y"]) for u in units] == [30_000, 30_000, 20_000] and units[2]["parts"] == [(6, 10_000), (7, 10_000)]


def test_no_job_for_children_that_are_never_split(spark, monkeypatch):
    """A round by level takes as many jobs as its trees are deep; leaves at the depth limit have their rows' values."""
    df, pdf, names = frame(spark)
    asked, sums = [], boosting.grow

    def look(tree, allowed, s):
        grower, got = sums(tree, allowed, s), None
        try:
            nodes = next(grower)
            while True:
                asked.append(max(tree.depth[n] for n in nodes))
                got = yield nodes
                nodes = grower.send(got)
        except StopIteration:
            pass
    monkeypatch.setattr(boosting, "grow", look)
    m = boosting.train(df, names, "y", 3, "w", rounds=1, max_depth=3, max_bins=16)
    assert sorted(asked) == [0] * 3 + [1] * 3 + [2] * 3
    bins, y, w = boosting.to_bins(pdf[names].to_numpy(), m.cuts), pdf["y"].to_numpy(int), pdf["w"].to_numpy()
    for k, tree in enumerate(m.trees[0]):
        leaf = boosting.route(boosting.steps(tree), bins)
        for node in np.unique(leaf):
            g, h = (w * (1 / 3 - (y == k)))[leaf == node].sum(), (w * 2 / 9)[leaf == node].sum()
            assert tree["value"][node] == pytest.approx(-0.1 * g / (h + 1))


def test_both_parts_are_scored_in_one_pass(spark, monkeypatch):
    """Training and validation rows go through a model once, and its trees are made steps once, not for every batch."""
    from tabsmith.operators import models
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(y=y.astype(float), split=np.where(np.arange(400) % 4 == 0, "val", np.where(np.arange(400) % 9 == 1, "test", "train")))
    df = spark.createDataFrame(pdf)
    scored, predictions = [], models.predictions
    monkeypatch.setattr(models, "predictions", lambda *a, **k: scored.append(predictions(*a, **k)) or scored[-1])
    fitted, metrics, _ = models.train_and_evaluate(df, ["a", "b"], "y", 3, boosted={"n_estimators": 3, "max_depth": 2}, forest={"n_estimators": 3, "max_depth": 3})
    assert len(scored) == 2
    monkeypatch.undo()
    got = {r["model"]: r for r in metrics.collect()}
    for name, m in fitted.items():
        for part, column in (("train", "f1_train"), ("val", "f1_macro")):
            one = models.macro_metrics(models.predictions(m, df.where(F.col("split") == part), "y", 3)).first()
            assert got[name][column] == pytest.approx(one["f1_macro"])
        assert got[name]["accuracy"] == pytest.approx(one["accuracy"])
    made, steps = [], boosting.steps
    monkeypatch.setattr(boosting, "steps", lambda t: made.append(1) or steps(t))
    out = fitted["boosted"].transform(df.repartition(4))
    assert len(made) == 9   # three rounds of three classes, all on the driver
    p = np.array([r["probability"] for r in out.orderBy("a").collect()])
    assert len(made) == 9 and p == pytest.approx(fitted["boosted"].probabilities(pdf.sort_values("a")[["a", "b"]].to_numpy()))


def test_elimination_gets_even_partitions(spark, monkeypatch):
    """Every fit of an elimination reads rows that are dealt to all cores."""
    from pyspark.ml.classification import LogisticRegression
    one = spark.range(0, 100_000, 1, 1).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"),
                                               (F.col("id") % 2).cast("double").alias("y"))
    seen, fit = [], LogisticRegression.fit

    def look(self, df, *more):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((len(sizes), max(sizes) < 30_000))
        return fit(self, df, *more)
    monkeypatch.setattr(LogisticRegression, "fit", look)
    assert select.recursive_elimination(one, ["x", "z"], "y").count() == 2 and seen == [(4, True)] * 2


def test_voting_folds_get_even_partitions(spark):
    """The forests of a fold ensemble read folds that are dealt to all cores."""
    one = spark.range(0, 100_000, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    seen = []

    def trainer(d):
        sizes = [r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((len(sizes), max(sizes) < 30_000))
        return models.train_forest(d, ["x"], "y", {"n_estimators": 2, "max_depth": 2})
    out = models.fold_ensemble(one, one.limit(10), ["x"], "y", "id", 2, n_folds=2, trainer=trainer)
    assert seen == [(4, True)] * 2 and out.count() == 10


# -- lasso ----------------------------------------------------------------------------

def regression(seed=2, n=500):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * [1, 10, 0.1, 3, 1, 1] + [0, 5, 1, 0, 100, 0]
    x[:, 5] = x[:, 0] * 0.9 + rng.normal(size=n) * 0.3
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 4 * x[:, 2] + rng.normal(size=n)
    return x, y


def slow_lasso(x, y, penalty):
    """Accelerated proximal gradient on the rows."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    size = np.sqrt((xc ** 2).mean(axis=0))
    z = xc / size
    step = 1 / np.linalg.eigvalsh(z.T @ z / len(y)).max()
    b = look = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(30_000):
        new = look - step * (z.T @ (z @ look - yc) / len(y))
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty / size, 0)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        look, b = new + (old - 1) / t * (new - b), new
    return b / size


def test_lasso_equals_a_solver_on_rows(spark):
    x, y = regression()
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcdef")).assign(y=y)).repartition(4)
    for penalty in (0.01, 0.3, 2.0):
        got = {r["feature"]: r["coefficient"] for r in select.lasso_coefficients(df, list("abcdef"), "y", reg=penalty).collect()}
        assert [got[f] for f in "abcdef"] == pytest.approx(slow_lasso(x, y, penalty).tolist(), abs=1e-6)


def test_lasso_cross_validation(spark):
    x, y = regression(n=300)
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcdef")).assign(y=y, k=3.0))
    folds = lasso.fold_moments(df, list("abcdef"), "y", 4, 7)
    assert sum(f[0] for f in folds) == 300
    fold = [r[0] for r in df.select(F.pmod(F.xxhash64(*"abcdefy", F.lit(7)), F.lit(4))).collect()]
    fold, rows = np.array(fold), df.toPandas()
    x, y = rows[list("abcdef")].to_numpy(), rows["y"].to_numpy()
    coef, intercept, best, path = lasso.cross_validated(folds, 9)
    assert [a for a, _ in path] == pytest.approx([path[0][0] * 1e-3 ** (i / 8) for i in range(9)])
    for penalty, error in path[::4]:
        errors = []
        for f in range(4):
            b = slow_lasso(x[fold != f], y[fold != f], penalty)
            at = y[fold != f].mean() - x[fold != f].mean(axis=0) @ b
            errors.append(((y[fold == f] - at - x[fold == f] @ b) ** 2).mean())
        assert error == pytest.approx(np.mean(errors), rel=1e-6)
    assert best == min(path, key=lambda p: p[1])[0] and coef == pytest.approx(slow_lasso(x, y, best), abs=1e-6)
    got = select.lasso_coefficients(df, ["a", "k"], "y", n_folds=3, n_alphas=5).collect()
    assert {r["feature"]: r["selected"] for r in got} == {"a": True, "k": False}


def test_moments_subtract(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4)) + 1e3
    a, b = lasso.moments(x[:20]), lasso.moments(x[20:])
    whole = lasso.merged(a, b)
    assert whole[2] == pytest.approx(lasso.moments(x)[2], rel=1e-9)
    assert lasso.without(whole, a)[2] == pytest.approx(b[2], rel=1e-7) and lasso.without(whole, whole)[0] == 0
    none = spark.createDataFrame([], "a double, y double")
    assert [r["coefficient"] for r in select.lasso_coefficients(none, ["a"], "y").collect()] == [0.0]


def test_the_frame_joins_the_claims_once(spark, monkeypatch):
    """The joins of the claims view and the split are done once: labels, cuts and fits read written rows."""
    from tabsmith.plans import model_input
    made, views, stored, claims = {}, [], model_input.stored, model_input.claims

    def keep(df, name="stored"):
        made[name] = (df._jdf.queryExecution().optimizedPlan().toString(), stored(df, name))
        return made[name][1]
    monkeypatch.setattr(model_input, "stored", keep)
    monkeypatch.setattr(model_input, "claims", lambda *a: views.append(claims(*a)) or views[-1])
    d, feats, label, k = model_input.model_frame(spark, "/root/testdata/sf0.001")
    assert list(made) == ["claims", "split", "model-frame"] and len(views) == 1 and d.count() == views[0].count()
    assert "l_shipdate" in made["claims"][0]
    assert all("l_shipdate" not in made[n][0] and "o_orderkey" not in made[n][0] for n in ("split", "model-frame"))
