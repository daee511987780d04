"""Multiclass models, metrics, predictions and permutation importance.

Models are ``pyspark.ml`` pipelines (assembler + classifier), trained on a
frame that keeps the target as a column.  Metrics are computed from a
confusion table built with ``groupBy`` (no ``collect`` of predictions), and
the macro averages are aggregates over that table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col
from tabsmith.operators import boosting, forest
from tabsmith.operators.boosting import BoostedModel
from tabsmith.operators.forest import ForestModel
from tabsmith.session import materialize, spread, stored

# Default hyper-parameters of the two model families.
BOOSTED_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
                  "colsample_bytree": 0.8, "random_state": 42}
FOREST_PARAMS = {"n_estimators": 100, "max_depth": 10, "random_state": 42}
#: Rows from which a forest is grown by ``operators.forest``.
FOREST_ROWS = 1 << 18


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def _subset_strategy(frac: float) -> str:
    return "all" if frac >= 1.0 else str(frac)


def train_boosted(df: DataFrame, features: list[str], label: str, params: dict | None = None,
                  weight_col: str | None = None, n_classes: int | None = None) -> BoostedModel:
    """K1: gradient-boosted trees with a softmax over all classes (``operators.boosting``)."""
    p = {**BOOSTED_PARAMS, **(params or {})}
    return boosting.train(df, features, label, n_classes, weight_col, rounds=int(p["n_estimators"]), max_depth=int(p["max_depth"]),
                          learning_rate=float(p["learning_rate"]), subsample=float(p["subsample"]),
                          colsample=float(p["colsample_bytree"]), seed=int(p["random_state"]))


def train_boosted_ovr(df: DataFrame, features: list[str], label: str, params: dict | None = None,
                      weight_col: str | None = None):
    """One-vs-rest of Spark's binary gradient-boosted trees, the classes fitted apart."""
    p = {**BOOSTED_PARAMS, **(params or {})}
    gbt = GBTClassifier(maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                        stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
                        featureSubsetStrategy=_subset_strategy(float(p["colsample_bytree"])),
                        seed=int(p["random_state"]), labelCol=label)
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    ovr = OneVsRest(classifier=gbt, labelCol=label, predictionCol="prediction", rawPredictionCol="rawPrediction")
    if weight_col:
        ovr = ovr.setWeightCol(weight_col)
    return Pipeline(stages=[_assembler(features), ovr]).fit(df)


def train_forest(df: DataFrame, features: list[str], label: str, params: dict | None = None,
                 weight_col: str | None = None):
    """K2: random forest.

    Every level of the trees is a pass over the rows, on all cores (``spread``); each row's
    nodes are kept, so a pass does not walk the trees again.  Spark's forest counts row by row for all
    trees, in tables that no processor cache holds; from ``FOREST_ROWS`` rows on ``operators.forest`` grows
    one of the same settings, with draws of its own, tree after tree.
    """
    p = {**FOREST_PARAMS, **(params or {})}
    rf = RandomForestClassifier(numTrees=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                                seed=int(p["random_state"]), labelCol=label, cacheNodeIds=True)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    narrow = df.select(*[col(c) for c in dict.fromkeys([*features, label, *([weight_col] if weight_col else [])])])
    if int(p["max_depth"]) <= forest.MOST_DEPTH and _forest_rows(narrow, features, label, weight_col) >= FOREST_ROWS:
        return forest.train(narrow, features, label, int(p["n_estimators"]), int(p["max_depth"]), weight_col, int(p["random_state"]))
    return Pipeline(stages=[_assembler(features), rf]).fit(spread(narrow))


def _forest_rows(df: DataFrame, features: list[str], label: str, weight_col: str | None) -> int:
    """Number of rows; 0 where a value is one that Spark's forest refuses, which is then left to say so."""
    def odd(c):
        v = col(c).cast("double")
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    y = col(label).cast("double")
    refused = reduce(lambda a, b: a | b, [odd(c) for c in features], odd(label) | (y < 0) | (y != F.floor(y)))
    if weight_col:
        refused = refused | odd(weight_col) | (col(weight_col) < 0)
    n, bad = df.agg(F.count(F.lit(1)), F.count_if(refused)).first()
    return 0 if bad else n


def train_all(df: DataFrame, features: list[str], label: str, boosted: dict | None = None,
              forest: dict | None = None) -> dict:
    """K3: both model families on one cached input."""
    d = df.select(*features, label).cache()
    try:
        return {"boosted": train_boosted(d, features, label, boosted),
                "forest": train_forest(d, features, label, forest)}
    finally:
        d.unpersist()


def importances(model, features: list[str]) -> DataFrame:
    """K4: (feature, importance) sorted desc; OvR averages its binary models."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if isinstance(last, (BoostedModel, ForestModel)):
        vals = last.gains().tolist()
    elif hasattr(last, "models"):
        vecs = [m.featureImportances.toArray() for m in last.models]
        vals = [float(sum(v[i] for v in vecs) / len(vecs)) for i in range(len(features))]
    else:
        vals = [float(x) for x in last.featureImportances.toArray()]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(features, vals)), "feature string, importance double") \
                .orderBy(F.desc("importance"), "feature")


def _probabilities(out: DataFrame) -> DataFrame:
    """Probability array per row; OvR margins become normalised sigmoids (GBT: 1/(1+e^-2m))."""
    if dict(out.dtypes).get("probability") == "array<double>":
        return out.withColumn("_p", F.col("probability"))
    if "probability" in out.columns:
        return out.withColumn("_p", vector_to_array("probability"))
    raw = vector_to_array("rawPrediction")
    sig = F.transform(raw, lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    total = F.aggregate(sig, F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("_p", F.transform(sig, lambda x: x / total))


def predictions(model, df: DataFrame, label: str, n_classes: int, key: str | None = None) -> DataFrame:
    """true_label, predicted_label, prediction_confidence, prob_class_i (+ key)."""
    out = _probabilities(model.transform(df))
    sel = ([col(key)] if key else []) + [
        col(label).cast("int").alias("true_label"), F.col("prediction").cast("int").alias("predicted_label"),
        F.array_max("_p").alias("prediction_confidence")]
    sel += [F.col("_p")[i].alias(f"prob_class_{i}") for i in range(n_classes)]
    return out.select(*sel)


def confusion(pred: DataFrame, true: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """(true_label, predicted_label, count, row_rate) - row-normalised rate included."""
    g = pred.groupBy(col(true).alias("true_label"), col(predicted).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("count"))
    return g.withColumn("row_rate", F.col("count") / F.sum("count").over(Window.partitionBy("true_label")))


def per_class(pred: DataFrame, true: str = "true_label", predicted: str = "predicted_label", by: tuple[str, ...] = ()) -> DataFrame:
    """Per class (of each group ``by``): support, predicted, true positives, precision, recall, f1 (0 when undefined).

    The predictions are read once, into a (true, predicted) count table.
    """
    by = [col(b) for b in by]
    cells = pred.groupBy(*by, col(true).alias("t"), col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    sides = F.explode(F.array(
        F.struct(F.col("t").cast("int").alias("c"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(zero).alias("hit"),
                 F.col("n").alias("is_true"), zero.alias("is_pred")),
        F.struct(F.col("p").cast("int").alias("c"), zero.alias("hit"), zero.alias("is_true"), F.col("n").alias("is_pred"))))
    g = cells.select(*by, sides.alias("s")).select(*by, "s.*").groupBy(*by, "c").agg(
        F.sum("is_true").alias("support"), F.sum("is_pred").alias("predicted"), F.sum("hit").alias("tp"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return g.select(*by, F.col("c").alias("class"), "support", "predicted", "tp", prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def macro_metrics(pred: DataFrame, true: str = "true_label", predicted: str = "predicted_label", by: tuple[str, ...] = ()) -> DataFrame:
    """K8: one row (for each group ``by``): accuracy and macro precision / recall / F1 over the union of labels."""
    return _macro(per_class(pred, true, predicted, by), by)


def _macro(pc: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return pc.groupBy(*[col(b) for b in by]).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"))


def classification_report(pred: DataFrame, true: str = "true_label",
                          predicted: str = "predicted_label") -> DataFrame:
    """K9: per class rows plus 'macro avg' and 'weighted avg' rows."""
    return _report(per_class(pred, true, predicted))


def _report(pc: DataFrame) -> DataFrame:
    """Class rows and both averages from one rollup of the per-class table."""
    names = ("precision", "recall", "f1")
    r = pc.rollup("class").agg(F.grouping("class").alias("g"), F.sum("support").alias("support"),
                               *[F.avg(m).alias(m) for m in names],
                               *[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"w_{m}") for m in names])

    def line(label, prefix=""):
        return F.struct(label.alias("label"), *[F.col(prefix + m).alias(m) for m in names], F.col("support").alias("support"))
    lines = F.when(F.col("g") == 0, F.array(line(F.col("class").cast("string")))).otherwise(
        F.array(line(F.lit("macro avg")), line(F.lit("weighted avg"), "w_")))
    return r.select(F.explode(lines).alias("s")).select("s.*")


def pick_best(metrics: DataFrame, score: str = "f1_macro", order: str = "position") -> DataFrame:
    """The model with the highest score; ties go to the first listed (strict >)."""
    return metrics.orderBy(F.desc(score), F.asc(order)).limit(1)


def evaluate(model, df: DataFrame, label: str, n_classes: int) -> tuple[DataFrame, DataFrame]:
    """(macro metrics row, classification report)."""
    pc = materialize(per_class(predictions(model, df, label, n_classes)))   # one row per class; scored once
    return _macro(pc), _report(pc)


def train_and_evaluate(df: DataFrame, features: list[str], label: str, n_classes: int,
                       split_col: str = "split", boosted: dict | None = None, forest: dict | None = None):
    """Train both families on ``train``, score on ``val``; returns (models, metrics, best)."""
    models = train_all(df.where(col(split_col) == "train"), features, label, boosted, forest)
    both = df.where(col(split_col).isin("train", "val"))
    spark = df.sparkSession
    rows = []
    for i, (name, m) in enumerate(models.items()):
        # both parts are scored in one pass: a row for each
        got = {r[split_col]: r for r in macro_metrics(predictions(m, both, label, n_classes, key=split_col), by=(split_col,)).collect()}
        tm, vm = got["train"], got["val"]
        rows.append((name, i, float(tm["f1_macro"]), float(vm["f1_macro"]), float(vm["accuracy"])))
    metrics = spark.createDataFrame(rows, "model string, position int, f1_train double, f1_macro double, "
                                          "accuracy double")
    return models, metrics, pick_best(metrics)


def model_features(model, default: list[str]) -> list[str]:
    """Input columns of a boosted model, a forest of blocks or of a pipeline's assembler."""
    if isinstance(model, (BoostedModel, ForestModel)):
        return model.features
    stages = [s for s in getattr(model, "stages", []) if isinstance(s, VectorAssembler)]
    return stages[0].getInputCols() if stages else list(default)


def _permuted_accuracy(model, rows: DataFrame, n: int, used: list[str], features: list[str], n_repeats: int, seed: int) -> DataFrame:
    """``(slot, acc)`` of any model: a row is scored for each slot."""
    from tabsmith.operators.permute import dealt_values
    # a row's own values are one more message to its number: a single exchange
    sent = dealt_values(rows, n, "_id", features, n_repeats, seed).select("id", F.struct("slot", "value").alias("got"), F.lit(None).alias("own"))
    own = rows.select(F.col("_id").alias("id"), F.lit(None).alias("got"), F.struct("_label", *[col(f) for f in used]).alias("own"))
    met = sent.unionByName(own).groupBy("id").agg(F.first("own", ignorenulls=True).alias("own"), F.collect_list("got").alias("got"))
    each = met.select("own.*", F.explode("got").alias("got"))
    which = F.floor(F.col("got.slot") / n_repeats)
    tried = each.select("_label", "got.slot", *[
        (F.when(which == features.index(f), F.col("got.value")).otherwise(col(f)) if f in features else col(f)).alias(f) for f in used])
    return model.transform(tried).groupBy("slot").agg(F.avg((F.col("prediction") == F.col("_label")).cast("double")).alias("acc"))


def _forest_accuracy(model, rows: DataFrame, n: int, features: list[str], n_repeats: int, seed: int) -> DataFrame | None:
    """``(slot, acc)`` of a random forest with numeric cuts; None for other models."""
    from tabsmith.operators import permuted_votes
    found = permuted_votes.forest_of(model)
    made = permuted_votes.arrays(rows.sparkSession, found[1]) if found else None
    if made is None or n_repeats < 1 or len(features) * n_repeats >= 1 << 16:
        return None
    counts = permuted_votes.slot_counts(rows, n, "_id", "_label", found[0], features, n_repeats, seed, *made)
    return counts.groupBy("slot").agg(F.try_divide(F.sum("right"), F.sum("seen")).alias("acc"))


def permutation_importance(model, df: DataFrame, features: list[str], label: str, key: str,
                           n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """mean/std (ddof 0) drop of accuracy when one feature's values are permuted.

    Row i of repeat r takes a feature's value from its partner in a seeded
    permutation (``operators.permute``), so values are sent, not ranked: one
    exchange by row number brings every row its values of all features and
    repeats, and all of them are scored in one job.  Values are compared as doubles.
    A forest scores a row's values together (``operators.permuted_votes``), any other
    model as rows of their own.
    """
    from tabsmith.operators.permute import numbered
    used = list(dict.fromkeys([*model_features(model, features), *features]))
    rows, n = numbered(df.select(*[col(f).cast("double").alias(f) for f in used], col(label).alias("_label")), "_id")
    baseline = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("_label")).cast("double")).alias("a")).first()["a"]
    if not n:
        return df.sparkSession.createDataFrame([], "feature string, importance_mean double, importance_std double")
    acc = _forest_accuracy(model, rows, n, features, n_repeats, seed)
    if acc is None:
        acc = _permuted_accuracy(model, rows, n, used, features, n_repeats, seed)
    drop = F.lit(baseline) - F.col("acc")
    names = F.array(*[F.lit(f) for f in features])
    out = acc.groupBy(F.element_at(names, (F.floor(F.col("slot") / n_repeats) + 1).cast("int")).alias("feature")).agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
    return out.orderBy(F.desc("importance_mean"), "feature")


def fold_preprocessing(train: DataFrame, others: list[DataFrame], outliers=None, frequency: list[str] = (),
                       medians: list[str] = (), features=None, scale: list[str] = ()) -> list[DataFrame]:
    """Preprocess one fold: everything is fitted on its training part alone.

    ``outliers``: a keep condition for the training rows; ``frequency`` columns
    get ``Enc <col>``; ``medians`` fill nulls; ``features(df)`` derives
    columns; ``scale`` standardises.  Returns the training part and ``others``.
    """
    from tabsmith.operators import encode, impute
    from tabsmith.operators.features import fit_standard, standard_params, standardize
    parts = [train.where(outliers) if outliers is not None else train, *others]
    if frequency:
        m = encode.fit_frequency(parts[0], list(frequency))
        parts = [encode.frequency(p, m, list(frequency)) for p in parts]
    if medians:
        fitted = impute.fit_medians(parts[0], list(medians))
        parts = [impute.fill_from(p, fitted) for p in parts]
    if features is not None:
        parts = [features(p) for p in parts]
    if scale:
        params = standard_params(fit_standard(parts[0], list(scale)))
        parts = [standardize(p, params) for p in parts]
    return parts


def cv_performance(df: DataFrame, features: list[str], label: str, key: str, n_folds: int = 5,
                   seed: int = 69, scale: list[str] | None = None, trainer=None, **preprocessing) -> DataFrame:
    """Stratified K-fold; preprocessing (see ``fold_preprocessing``) fitted on the training
    folds only; macro F1 of both parts per fold."""
    from tabsmith.operators.split import kfold
    trainer = trainer or (lambda d: train_forest(d, features, label))
    folded = stored(spread(kfold(df, key, label, n_folds, seed)), "folds")   # ranked once
    spark = df.sparkSession
    rows = []
    for k in range(n_folds):
        tr, te = fold_preprocessing(folded.where(F.col("fold") != k), [folded.where(F.col("fold") == k)],
                                    scale=scale or (), **preprocessing)
        m = trainer(tr)
        scores = []
        for part in (tr, te):
            pred = m.transform(part).select(col(label).cast("int").alias("true_label"),
                                            F.col("prediction").cast("int").alias("predicted_label"))
            scores.append(macro_metrics(pred).first())
        rows.append((k, float(scores[0]["f1_macro"]), float(scores[1]["f1_macro"]), float(scores[1]["accuracy"])))
    return spark.createDataFrame(rows, "fold int, f1_train double, f1_macro double, accuracy double")


def fold_ensemble(df: DataFrame, test: DataFrame, features: list[str], label: str, key: str,
                  n_classes: int, n_folds: int = 6, seed: int = 69, trainer=None, **preprocessing) -> DataFrame:
    """One model per fold; class probabilities summed over folds on ``test`` -> argmax.
    Preprocessing (see ``fold_preprocessing``) is fitted on each fold's training part."""
    from tabsmith.operators.split import kfold
    trainer = trainer or (lambda d: train_forest(d, features, label))
    folded = stored(spread(kfold(df, key, label, n_folds, seed)), "folds")   # ranked once, not for each fold
    scores = None
    for k in range(n_folds):
        part, scored = fold_preprocessing(folded.where(F.col("fold") != k), [test], **preprocessing)
        m = trainer(part)
        p = predictions(m, scored, label, n_classes, key=key).select(
            key, *[f"prob_class_{i}" for i in range(n_classes)])
        scores = p if scores is None else scores.unionByName(p)
    summed = scores.groupBy(key).agg(*[F.sum(f"prob_class_{i}").alias(f"prob_class_{i}") for i in range(n_classes)])
    arr = F.array(*[F.struct(F.col(f"prob_class_{i}").alias("p"), F.lit(-i).alias("neg")) for i in range(n_classes)])
    best = F.array_max(arr)
    return summed.select(key, (-best["neg"]).cast("int").alias("predicted_label"),
                         *[f"prob_class_{i}" for i in range(n_classes)])
