import pytest
from pyspark.sql import functions as F

from tabsmith.operators import split
from tabsmith.operators.ranking import hashed_rank


def ranked_split(df, key, target, test, val, seed):
    """The split by every row's rank."""
    r = hashed_rank(df, [target], key, seed)
    n_test = F.round(F.lit(float(test)) * F.col("_group_n"))
    n_val = F.round(F.lit(float(val)) * (F.col("_group_n") - n_test))
    s = F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val").otherwise("train")
    return {x[key]: x["s"] for x in r.select(key, s.alias("s")).collect()}


def classes(spark, n=3000):
    c = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).when(F.col("id") == 7, "one").otherwise((F.col("id") % 4).cast("string"))
    return spark.range(n).select("id", c.alias("y"), (F.col("id") * 2).alias("split"), F.lit(1).alias("other")).repartition(5)


@pytest.mark.parametrize(("test", "val"), [(0.1, 0.2), (0.2, 0.0), (0.0, 0.5), (1.0, 0.0), (0.0, 0.0), (0.5, 1.0)])
def test_same_membership_as_ranks(spark, test, val):
    df = classes(spark)
    out = split.stratified_split(df, "id", "y", test, val, 42)
    assert out.columns == ["id", "y", "other", "split"]
    assert {r["id"]: r["split"] for r in out.collect()} == ranked_split(df, "id", "y", test, val, 42)


def test_refinement_by_more_digits(spark, monkeypatch):
    """With room for a few rows only, buckets of one digit are counted by further ones."""
    monkeypatch.setattr(split, "DIGITS", 1)
    monkeypatch.setattr(split, "MOST_ROWS", 3)
    monkeypatch.setattr(split.class_cuts, "__defaults__", (3,))
    df = classes(spark, 1500)
    got = {r["id"]: r["split"] for r in split.stratified_split(df, "id", "y", 0.15, 0.3, 7).collect()}
    assert got == ranked_split(df, "id", "y", 0.15, 0.3, 7)


def test_split_sorts_no_rows(spark):
    plan = split.stratified_split(classes(spark), "id", "y")._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Window" not in plan and "Sort " not in plan and plan.count("Exchange hashpartitioning") == 0
    assert split.stratified_split(classes(spark).limit(0), "id", "y").count() == 0
