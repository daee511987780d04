import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import models, permute


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 65_537])
def test_bijection(n):
    i = np.arange(n)
    one, two = permute.permuted(i, n, (42, 0, 0)), permute.permuted(i, n, (42, 0, 1))
    assert sorted(one.tolist()) == sorted(two.tolist()) == list(range(n))
    assert (one == np.concatenate([permute.permuted(i[:n // 2], n, (42, 0, 0)), permute.permuted(i[n // 2:], n, (42, 0, 0))])).all()
    if n >= 1000:
        assert (one != two).mean() > 0.99 and (one != i).mean() > 0.99 and abs(np.corrcoef(one, i)[0, 1]) < 0.1


def test_numbers_are_dense(spark):
    df = spark.range(1000).where("id % 7 > 0").repartition(6)
    rows, n = permute.numbered(df, "_id")
    got = rows.collect()
    assert sorted(r["_id"] for r in got) == list(range(n)) and n == df.count() and rows.columns == ["id", "_id"]


def test_dealt_values_are_permutations(spark):
    df = spark.range(500).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b")).repartition(4)
    rows, n = permute.numbered(df, "_id")
    got = permute.dealt_values(rows, n, "_id", ["a", "b"], 3, 1).toPandas()
    assert len(got) == 500 * 6
    for slot, part in got.groupby("slot"):
        assert sorted(part["id"]) == list(range(500))
        assert sorted(part["value"]) == [v * (1 + slot // 3) for v in range(500)]


def test_one_exchange_of_the_rows(spark):
    """The rows and their dealt values are exchanged once; what is left are sums by slot."""
    df = spark.range(2000).select((F.col("id") % 10).cast("double").alias("x"), F.lit(1.0).alias("c"), F.rand(3).alias("z"),
                                  (F.col("id") % 10 > 4).cast("double").alias("y"), "id")
    m = models.train_forest(df, ["x", "c", "z"], "y", {"n_estimators": 4, "max_depth": 4})
    out = models.permutation_importance(m, df, ["x", "c"], "y", "id", 3)
    got = {r["feature"]: r for r in out.collect()}
    assert got["c"]["importance_mean"] == 0 and got["c"]["importance_std"] == 0 and 0.3 < got["x"]["importance_mean"] < 0.7
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("hashpartitioning(id") == 1 and "Window" not in plan
    assert [c for c in models.permutation_importance(m, df.limit(0), ["x"], "y", "id").collect()] == []


def test_forest_scorings_equal_rows_of_their_own(spark, monkeypatch):
    """A forest's joint scoring gives what scoring a row for each feature and repeat gives; no such rows are made."""
    rng = np.random.default_rng(4)
    n = 6000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 4, n), rng.random(n), np.ones(n)]).tolist()
    rows = [(i, *[None if c == 2 and i % 9 == 0 else float("nan") if c == 0 and i % 31 == 0 else v for c, v in enumerate(r)], f"t{i % 5}",
             None if i % 50 == 0 else 7.0 if i % 51 == 0 else float((r[0] > 0) + (r[1] > 1) * (r[2] > 0.4))) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, `z 1` double, flat double, text string, y double").repartition(3)
    inputs = ["a", "b", "z 1", "flat"]
    m = models.train_forest(df.where("y < 7").dropna(), inputs, "y", {"n_estimators": 7, "max_depth": 6})
    other = df.withColumn("unused", F.col("id") * 0.5)
    for features, repeats in ((inputs, 3), (["z 1", "unused"], 2)):
        once = models.permutation_importance(m, other, features, "y", "id", repeats, 9).collect()
        with monkeypatch.context() as p:
            p.setattr(models, "_forest_accuracy", lambda *a: None)
            each = models.permutation_importance(m, other, features, "y", "id", repeats, 9).collect()
        assert [r["feature"] for r in once] == [r["feature"] for r in each] and len(once) == len(features)
        for a, b in zip(once, each, strict=True):
            assert a["importance_mean"] == pytest.approx(b["importance_mean"], abs=1e-12)
            assert a["importance_std"] == pytest.approx(b["importance_std"], abs=1e-12)
    asked = []
    with monkeypatch.context() as p:
        p.setattr(permute, "dealt_values", lambda *a: asked.append(1))
        models.permutation_importance(m, df, inputs, "y", "id", 2)
    assert not asked


def test_blocks_stay_small():
    from tabsmith.operators import permuted_votes
    assert permuted_votes.block_rows(10, 4) == permuted_votes.LEAST_ROWS
    assert permuted_votes.block_rows(10 ** 9, 4) == permuted_votes.BLOCK_ROWS == 1 << 16
    assert 10 ** 6 / permuted_votes.block_rows(10 ** 6, 8) >= 8 * 7


def test_leaves_follow_the_other_value(monkeypatch):
    """Every row, feature and repeat ends where a walk of its own ends; batches change nothing."""
    from tabsmith.operators import permuted_votes
    rng = np.random.default_rng(8)
    depth, width, repeats, rows = 5, 4, 3, 300
    inner, nodes = 2 ** depth - 1, 2 ** (depth + 1) - 1
    own = np.arange(nodes)
    test = (own < inner) & (rng.random(nodes) < 0.9)
    feature, cut = np.where(test, rng.integers(0, width, nodes), 0), np.where(test, rng.integers(0, 6, nodes), 65535)
    kids = np.concatenate([np.where(test, 2 * own + 1, own), np.where(test, 2 * own + 2, own)])
    tree = (feature, cut, kids, rng.integers(0, 4, (3, nodes)) / 4, depth)
    codes = rng.integers(0, 7, (rows, width)).astype(np.uint16)
    place = np.array([1, 3, 0, 2])   # feature 1 is not permuted: the last place
    other = np.zeros((rows, 4, repeats), np.uint16)
    other[:, :3] = rng.integers(0, 7, (rows, 3, repeats))
    got = permuted_votes.leaves(tree, codes, other, place)

    def walk(c):
        at = 0
        while test[at]:
            at = 2 * at + 1 + int(c[feature[at]] > cut[at])
        return at
    for i in range(rows):
        for f in (0, 2, 3):
            for r in range(repeats):
                c = codes[i].copy()
                c[f] = other[i, place[f], r]
                assert got[i, place[f] * repeats + r] == walk(c)
    label = rng.integers(0, 3, rows)
    want = (np.argmax(2 * tree[3].T[got], axis=2) == label[:, None]).sum(axis=0)
    assert (permuted_votes.hits([tree, tree], codes, other, place, label) == want).all()
    monkeypatch.setattr(permuted_votes, "BATCH", 1)
    assert (permuted_votes.hits([tree, tree], codes, other, place, label) == want).all()
