"""Feature ranking and selection.

Statistics are aggregates over contingency tables built with ``groupBy``;
the model-based selectors reuse ``models``.  Tables are (feature, ...) rows,
one per feature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col
from tabsmith.functions.stats import chi2_sf
from tabsmith.operators import boosting, lasso

# The two named feature subsets, in order; the second holds the first.
ESSENTIAL_FEATURES = [
    "IME-4 Count", "Days_to_First_Hearing", "C-2 Date_Year", "Accident Date_Year", "Assembly Date_Year",
    "Attorney/Representative_Y", "Enc WCIO Nature of Injury Code", "Relative_Wage",
]
FEATURE_SUBSETS = {
    "essential": ESSENTIAL_FEATURES,
    "reduced": ESSENTIAL_FEATURES + [
        "Age at Injury", "Days_to_C2", "Days_to_C3", "C-2 Date_Day", "C-2 Date_DayOfWeek", "C-3 Date_Day", "C-3 Date_Month",
        "C-3 Date_Year", "First Hearing Date_Day", "First Hearing Date_Month", "First Hearing Date_Year",
        "First Hearing Date_DayOfWeek", "Accident Date_Month",
    ],
}
# Vote bands: (upper bound inclusive, label) for numeric and categorical features.
VOTE_BANDS_NUMERIC = ((2, "drop"), (4, "try"), (6, "keep"))
VOTE_BANDS_CATEGORICAL = ((3, "drop"), (5, "try"), (7, "keep"))


def select_by_importance(imp: DataFrame, threshold="median", max_features: int | None = None) -> DataFrame:
    """K5/K6: keep features with importance >= threshold ('median', 'mean' or a number);
    ``max_features`` keeps the top n of those instead."""
    if isinstance(threshold, str):
        from tabsmith.operators.quantiles import exact_quantiles
        if threshold == "median":
            t = exact_quantiles(imp, [], "importance", [0.5], ["t"]).first()["t"]
        elif threshold == "mean":
            t = imp.agg(F.avg("importance").alias("t")).first()["t"]
        else:
            raise ValueError(f"unknown threshold {threshold!r}")
    else:
        t = float(threshold)
    kept = imp.where(F.col("importance") >= F.lit(t))
    if max_features is not None:
        kept = kept.orderBy(F.desc("importance"), "feature").limit(max_features)
    return kept


def combine_selection(a: DataFrame, b: DataFrame, method: str = "union",
                      names: tuple[str, str] = ("xgb_importance", "rf_importance")) -> DataFrame:
    """K7: union/intersection of two selections with both importances (0 when the
    method did not select it) and their average, sorted by average then name."""
    from tabsmith.operators.profile import combine_features, lookup_importance
    feats = combine_features(a, b, method)
    out = lookup_importance(feats, (names[0], a), (names[1], b))
    return out.withColumn("avg_importance", (F.col(names[0]) + F.col(names[1])) / 2) \
              .orderBy(F.desc("avg_importance"), "feature")


def _contingency(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, x, y, n) for every feature in one aggregation; nulls dropped.

    The table (features x categories x classes rows) is checkpointed: every
    statistic below reads it several times and the input is scanned once.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), col(f).cast("string").alias("x"))
                                  for f in features]))
    long = df.select(col(target).cast("string").alias("y"), stacked.alias("kv")) \
             .select("kv.feature", "kv.x", "y").where(F.col("x").isNotNull() & F.col("y").isNotNull())
    from tabsmith.session import materialize
    return materialize(long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("n")))


def chi2_independence(df: DataFrame, features: list[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Chi-square test of independence per feature against the target
    -> (feature, chi2, dof, p_value, important).

    Only observed cells are materialised: sum over all cells of (o-e)^2/e
    equals sum_observed o^2/e - N.  For a 2 x 2 table (dof 1) Yates'
    correction uses that every cell has the same |o - e| = D:
    chi2 = max(D - 0.5, 0)^2 * N * (sum_i 1/r_i) * (sum_j 1/c_j).
    """
    ct = _contingency(df, features, target)
    px = ct.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    py = ct.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    rx = px.groupBy("feature").agg(F.count(F.lit(1)).alias("r"), F.sum(1.0 / F.col("nx")).alias("inv_r"))
    cy = py.groupBy("feature").agg(F.count(F.lit(1)).alias("c"), F.sum(1.0 / F.col("ny")).alias("inv_c"))
    j = ct.join(px, ["feature", "x"]).join(py, ["feature", "y"])
    tot = ct.groupBy("feature").agg(F.sum("n").alias("n_total"))
    e = F.col("nx") * F.col("ny") / F.col("n_total")
    per = (j.join(F.broadcast(tot), "feature").groupBy("feature")
            .agg(F.sum(F.col("n") * F.col("n") / e).alias("s"), F.first("n_total").alias("n_total"),
                 F.first(F.abs(F.col("n") - e)).alias("D")))
    per = per.join(rx, "feature").join(cy, "feature")
    dof = ((F.col("r") - 1) * (F.col("c") - 1)).cast("int")
    yates = F.pow(F.greatest(F.col("D") - 0.5, F.lit(0.0)), 2) * F.col("n_total") * F.col("inv_r") * F.col("inv_c")
    chi2 = (F.when(dof == 0, F.lit(0.0)).when(dof == 1, yates)
             .otherwise(F.greatest(F.col("s") - F.col("n_total"), F.lit(0.0))))
    out = per.select("feature", chi2.alias("chi2"), dof.alias("dof"))
    p = chi2_sf(F.col("chi2"), F.col("dof"))
    return out.select("feature", "chi2", "dof", p.alias("p_value"), (p < alpha).alias("important"))


def mutual_information(df: DataFrame, features: list[str], target: str, keep: float = 0.01) -> DataFrame:
    """Plug-in mutual information (nats) of each discrete feature with the target."""
    ct = _contingency(df, features, target)
    tot = ct.groupBy("feature").agg(F.sum("n").alias("n_total"))
    px = ct.groupBy("feature", "x").agg(F.sum("n").alias("nx"))
    py = ct.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    j = ct.join(px, ["feature", "x"]).join(py, ["feature", "y"]).join(F.broadcast(tot), "feature")
    term = (F.col("n") / F.col("n_total")) * F.log(F.col("n") * F.col("n_total") / (F.col("nx") * F.col("ny")))
    out = j.groupBy("feature").agg(F.sum(term).alias("mutual_information"))
    return out.withColumn("keep", F.col("mutual_information") >= keep)


def class_weights(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """K22: 'balanced' weights n / (k * n_c) as a (class, weight) table."""
    g = df.groupBy(col(target).alias(target)).agg(F.count(F.lit(1)).alias("n_c"))
    n, k = g.agg(F.sum("n_c"), F.count(F.lit(1))).first()   # two numbers
    return g.select(target, (F.lit(n) / (F.lit(k) * F.col("n_c"))).alias(out))


def with_class_weights(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """Attach K22 weights (one row per class: AQE broadcasts it by its size)."""
    return df.join(class_weights(df, target, out), target)


def selection_reduction(before: list[str], selected: DataFrame) -> DataFrame:
    """K7: features before and after a selection and the percentage removed."""
    n = len(before)
    kept = F.count(F.lit(1))
    pct = (n - kept) * F.lit(100.0 / n) if n else F.lit(0.0)
    return selected.agg(F.lit(n).cast("bigint").alias("n_before"), kept.alias("n_after"), pct.alias("reduction_pct"))


def lasso_coefficients(df: DataFrame, features: list[str], label: str, reg: float | None = None, keep: float = 0.01,
                       n_folds: int = 5, n_alphas: int = 100, seed: int = 42) -> DataFrame:
    """L1-regularised linear regression coefficients, |coef| > keep selected.

    Without ``reg`` the penalty is the one of ``n_alphas`` on the path with the
    smallest mean squared error over ``n_folds`` folds.  One scan (``operators.lasso``);
    rows with a null are left out.
    """
    folds = lasso.fold_moments(df, features, label, 1 if reg is not None else n_folds, seed)
    coef, _ = lasso.solve(lasso.total(folds), reg) if reg is not None else lasso.cross_validated(folds, n_alphas)[:2]
    rows = [(f, float(c)) for f, c in zip(features, coef, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double") \
        .withColumn("selected", F.abs("coefficient") > keep)


def recursive_elimination(df: DataFrame, features: list[str], label: str, min_features: int = 1) -> DataFrame:
    """Logistic-regression RFE: drop the weakest |coef| (summed over classes) one at a
    time; every size from all features down to ``min_features`` is scored by training macro F1.

    ``best`` marks the subset that the selection returns: the best score among the
    sizes below all features, the smallest size on a tie.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from tabsmith.operators.models import macro_metrics
    from tabsmith.session import spread
    spark = df.sparkSession
    cur = list(features)
    rows = []
    d = spread(df.select(*features, col(label).cast("double").alias("_y"))).cache()
    while len(cur) >= min_features:
        v = VectorAssembler(inputCols=cur, outputCol="features", handleInvalid="skip").transform(d)
        m = LogisticRegression(featuresCol="features", labelCol="_y").fit(v)
        pred = m.transform(v).select(F.col("_y").cast("int").alias("true_label"),
                                     F.col("prediction").cast("int").alias("predicted_label"))
        f1 = macro_metrics(pred).first()["f1_macro"]
        rows.append((len(cur), list(cur), float(f1)))
        if len(cur) == min_features:
            break
        coef = m.coefficientMatrix.toArray()
        weight = [float(sum(abs(coef[r][i]) for r in range(coef.shape[0]))) for i in range(len(cur))]
        cur.pop(min(range(len(cur)), key=lambda i: (weight[i], cur[i])))
    d.unpersist()
    smaller = [r for r in rows if r[0] < len(features)] or rows
    best = max(smaller, key=lambda r: (r[2], -r[0]))[0]
    return spark.createDataFrame([(*r, r[0] == best) for r in rows],
                                 "n_features int, features array<string>, f1_macro double, best boolean")


def tree_importance(df: DataFrame, features: list[str], label: str, max_depth: int = 5,
                    min_leaf: int = 10) -> DataFrame:
    """Balanced decision-tree importances."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from tabsmith.session import spread
    w = spread(with_class_weights(df, label).select(*[col(c) for c in dict.fromkeys([*features, label, "class_weight"])]))
    dt = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=min_leaf, labelCol=label,
                                weightCol="class_weight", seed=42)
    m = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), dt]).fit(w)
    from tabsmith.operators.models import importances
    return importances(m, features)


def boosted_importance(df: DataFrame, features: list[str], label: str, params: dict | None = None, keep: int = 99) -> DataFrame:
    """Class-weighted boosting of trees grown leaf by leaf: (feature, importance, splits, keep) by share of
    the gain; ``keep`` or more splits are kept.  ``params`` as of ``boosting.train``."""
    p = {"rounds": 100, "max_leaves": 31, "max_depth": 64, "learning_rate": 0.1, "leaf_wise": True, **(params or {})}
    m = boosting.train(with_class_weights(df, label), features, label, weight_col="class_weight", **p)
    rows = [(f, float(g), int(n)) for f, g, n in zip(features, m.gains(), m.split_counts(), strict=True)]
    return (df.sparkSession.createDataFrame(rows, "feature string, importance double, splits int")
            .withColumn("keep", F.col("splits") >= keep).orderBy(F.desc("importance"), "feature"))


def split_counts(model, features: list[str], keep: int = 99) -> DataFrame:
    """Splits on each feature over all trees of a boosted model; ``keep`` or more are kept."""
    import re

    from pyspark.sql import SparkSession
    last = model.stages[-1] if hasattr(model, "stages") else model
    counts = dict.fromkeys(range(len(features)), 0)
    if isinstance(last, boosting.BoostedModel):
        counts = dict(enumerate(last.split_counts().tolist()))
    else:
        for m in getattr(last, "models", [last]):
            for at in re.findall(r"If \(feature (\d+) ", m.toDebugString):
                counts[int(at)] += 1
    rows = [(f, counts[i]) for i, f in enumerate(features)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, splits int").withColumn(
        "keep", F.col("splits") >= keep).orderBy(F.desc("splits"), "feature")


def vote_table(votes: dict[str, DataFrame], categorical: list[str] | None = None) -> DataFrame:
    """Per-method keep(1)/drop(0) tables (feature, keep) -> total votes and a band."""
    parts = [t.select("feature", F.col("keep").cast("int").alias("keep"), F.lit(m).alias("method"))
             for m, t in votes.items()]
    allv = reduce(lambda a, b: a.unionByName(b), parts)
    g = allv.groupBy("feature").agg(F.sum("keep").alias("votes"), F.count(F.lit(1)).alias("methods"))
    cat = F.col("feature").isin(list(categorical or []))

    def band(bands):
        e = None
        for ub, lab in bands:
            e = F.when(F.col("votes") <= ub, F.lit(lab)) if e is None else e.when(F.col("votes") <= ub, F.lit(lab))
        return e.otherwise(F.lit(bands[-1][1]))

    return g.withColumn("decision", F.when(cat, band(VOTE_BANDS_CATEGORICAL)).otherwise(band(VOTE_BANDS_NUMERIC)))


def fixed_subset(df: DataFrame, name: str, keep: list[str] = ()) -> DataFrame:
    """Project a named feature subset (plus e.g. key and target)."""
    cols = [c for c in FEATURE_SUBSETS[name] if c in df.columns] + [c for c in keep if c in df.columns]
    return df.select(*[col(c) for c in cols])


def correlation_importance(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Filter-method importance: |Pearson r| of each feature with the (encoded) label,
    all features in one aggregate."""
    row = df.agg(*[F.abs(F.corr(col(f).cast("double"), col(label).cast("double"))).alias(f"i{i}")
                   for i, f in enumerate(features)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"i{i}").alias("importance"))
                                          for i, f in enumerate(features)])).alias("s")).select("s.*")
