"""Models, tuning and prediction on Spark ML.

Parameter mapping from the reference's grids:
* `max_depth=None` -> 30 (the Spark ceiling); `min_samples_leaf` ->
  `minInstancesPerNode`; `min_samples_split` has no Spark equivalent and
  is ignored; splits are binned (`maxBins`) rather than exact.
* logistic `C` -> `regParam = 1 / (C * n)` with `standardization=False`,
  which is the same L2-penalised multinomial objective.
Fits run on executors; cross-validation is `CrossValidator` with an
explicit stratified fold column and parallel candidate fits.
"""

from __future__ import annotations

import itertools
from typing import Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import half_even_class

MAX_DEPTH = 30
DEFAULT_SEED = 42
# node ids cached per row (fewer passes for deep trees; checkpointed every 10
# iterations into the shared checkpoint folder) and a larger per-pass node budget
TREE_TUNING = {"cacheNodeIds": True, "maxMemoryInMB": 1024, "checkpointInterval": 10}


def _depth(d):
    """None (no bound) is the deepest tree that Spark grows; deeper ones are refused."""
    if d is not None and int(d) > MAX_DEPTH:
        raise ValueError(f"trees of depth {d} are beyond Spark's limit of {MAX_DEPTH}")
    return MAX_DEPTH if d is None else int(d)


def decision_tree(max_depth=None, min_samples_leaf: int = 1, criterion: str = "gini", seed: int = DEFAULT_SEED,
                  features: str = "features", label: str = "label", weight: str | None = None,
                  max_bins: int = 64) -> DecisionTreeClassifier:
    """M01."""
    est = DecisionTreeClassifier(featuresCol=features, labelCol=label, impurity=criterion,
                                 maxDepth=_depth(max_depth), minInstancesPerNode=min_samples_leaf,
                                 maxBins=max_bins, seed=seed, **TREE_TUNING)
    if weight:
        est.setWeightCol(weight)
    return est


def logistic(C: float = 1.0, n: int = 1, features: str = "features", label: str = "label",
             max_iter: int = 1000, weight: str | None = None) -> LogisticRegression:
    """Multinomial L2 logistic regression with the reference's C."""
    est = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                             regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0, standardization=False,
                             maxIter=max_iter, tol=1e-6)
    if weight:
        est.setWeightCol(weight)
    return est


def random_forest(n_estimators: int = 100, max_depth=None, min_samples_leaf: int = 1,
                  max_features: str = "sqrt", seed: int = DEFAULT_SEED, features: str = "features",
                  label: str = "label", weight: str | None = None, max_bins: int = 64) -> RandomForestClassifier:
    """Per-split feature subsets (`sqrt` / `log2`)."""
    est = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=n_estimators,
                                 maxDepth=_depth(max_depth), minInstancesPerNode=min_samples_leaf,
                                 featureSubsetStrategy=max_features, maxBins=max_bins, seed=seed, **TREE_TUNING)
    if weight:
        est.setWeightCol(weight)
    return est


def random_forest_regressor(n_estimators: int = 100, max_depth=None, min_samples_leaf: int = 1,
                            max_features: str = "sqrt", seed: int = DEFAULT_SEED, features: str = "features",
                            label: str = "label", max_bins: int = 64) -> RandomForestRegressor:
    """Regression on class codes; `to_class` maps outputs back."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=n_estimators,
                                 maxDepth=_depth(max_depth), minInstancesPerNode=min_samples_leaf,
                                 featureSubsetStrategy=max_features, maxBins=max_bins, seed=seed, **TREE_TUNING)


def to_class(df: DataFrame, pred: str = "prediction", out: str = "class_prediction", lo: int = 0,
             hi: int = 2) -> DataFrame:
    """Round half to even and clip to [lo, hi]."""
    return df.withColumn(out, half_even_class(pred, lo, hi).cast("double"))


def f1_evaluator(label: str = "label", prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="f1")


def mse_evaluator(label: str = "label", prediction: str = "prediction") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="mse")


def grid(estimator, **params) -> list:
    """Exhaustive parameter grid from keyword lists (Spark Param names)."""
    b = ParamGridBuilder()
    for name, values in params.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()


def grid_search(estimator, param_grid: list, df: DataFrame, fold_col: str = "fold",
                metric: str = "f1", label: str = "label", parallelism: int = 4, seed: int = DEFAULT_SEED):
    """Exhaustive k-fold search on an explicit fold column, refit on all
    rows. Returns (fitted CrossValidatorModel, table of candidates)."""
    evaluator = f1_evaluator(label) if metric == "f1" else mse_evaluator(label)
    folds = int(df.agg(F.max(fold_col)).first()[0]) + 1
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_grid, evaluator=evaluator,
                        numFolds=folds, foldCol=fold_col, parallelism=parallelism, seed=seed, collectSubModels=False)
    model = cv.fit(df)
    rows = []
    sign = 1.0 if metric == "f1" else -1.0
    for i, (pm, m, s) in enumerate(zip(param_grid, model.avgMetrics, model.stdMetrics)):
        rows.append((i, ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)),
                     sign * float(m), float(s)))
    table = df.sparkSession.createDataFrame(rows, "candidate int, params string, mean_score double, std_score double")
    return model, table


def cv_scores(estimator, df: DataFrame, folds: int = 5, fold_col: str = "fold", label: str = "label") -> DataFrame:
    """Score per fold (weighted F1), then mean and population std.

    The trees of all folds grow together in the same passes; any other
    estimator is one distributed fit on the other folds for each. The scores
    are a k-row table.
    """
    from cohortlens.operators import search

    if search.grows(estimator, df, estimator.getFeaturesCol() if estimator.hasParam("featuresCol") else "") and estimator.getLabelCol() == label:
        [scores] = search.cv_trees(estimator, df, [[None] * folds], estimator.getFeaturesCol(), label, fold_col)
        return df.sparkSession.createDataFrame([(f, float(s)) for f, s in enumerate(scores)], "fold int, score double")
    ev = f1_evaluator(label)
    rows = []
    for f in range(folds):
        train = df.where(F.col(fold_col) != f)
        valid = df.where(F.col(fold_col) == f)
        model = estimator.fit(train)
        rows.append((f, float(ev.evaluate(model.transform(valid)))))
    scores = df.sparkSession.createDataFrame(rows, "fold int, score double")
    return scores


def summarize_scores(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


def learning_curve(estimator, df: DataFrame, sizes: Sequence[float], id_col: str, folds: int = 5,
                   fold_col: str = "fold", label: str = "label", seed: int = DEFAULT_SEED) -> DataFrame:
    """For each fold and training size, fit on the first `size` share of
    the other folds (md5 order of the id, so sizes are nested prefixes)
    and score train and validation weighted F1.
    Returns (size, fold, train_rows, train_score, valid_score).

    The prefix is selected with the bucketed exact top-n plan, never by
    sorting the training rows into one task.
    """
    from cohortlens.functions.columns import hash_order_key
    from cohortlens.operators.prep import smallest_per_group

    ev = f1_evaluator(label)
    spark = df.sparkSession
    rows = []
    for f in range(folds):
        pool = df.where(F.col(fold_col) != f).withColumn("__all", F.lit(1))
        valid = df.where(F.col(fold_col) == f)
        n = pool.count()
        for s in sizes:
            m = max(1, int(round(n * s)))
            quota = spark.createDataFrame([(1, m)], "__all int, quota long")
            train = smallest_per_group(pool, "__all", hash_order_key(F.col(id_col), seed), id_col, quota) \
                .where("__selected").drop("__selected", "__key", "__all")
            model = estimator.fit(train)
            rows.append((float(s), f, int(m), float(ev.evaluate(model.transform(train))),
                         float(ev.evaluate(model.transform(valid)))))
    return spark.createDataFrame(
        rows, "size double, fold int, train_rows int, train_score double, valid_score double")


def importances(model, names: Sequence[str], n: int | None = None, spark=None) -> DataFrame:
    """Feature importances joined with names, largest first."""
    imp = model.featureImportances.toArray()
    rows = sorted(((names[i], float(v)) for i, v in enumerate(imp)), key=lambda t: (-t[1], t[0]))
    if n is not None:
        rows = rows[:n]
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame([(i + 1, a, b) for i, (a, b) in enumerate(rows)],
                                 "rank int, feature string, importance double")


def predict(model, df: DataFrame) -> DataFrame:
    """Class index prediction."""
    return model.transform(df)


def predict_proba(scored: DataFrame, classes: Sequence[str], prob_col: str = "probability",
                  prefix: str = "p_") -> DataFrame:
    """One probability column per class (alphabetical class order)."""
    arr = vector_to_array(F.col(prob_col))
    return scored.withColumns({f"{prefix}{c}": arr[i] for i, c in enumerate(classes)})


def param_grid_size(**grid_lists) -> int:
    return len(list(itertools.product(*grid_lists.values())))


def compare_models(train: DataFrame, test: DataFrame, candidates: dict, classes: Sequence[str],
                   fold_col: str = "fold", label: str = "label", id_col: str = "id", parallelism: int = 4,
                   variant: str | None = None) -> DataFrame:
    """For each named (estimator, param grid), k-fold grid search on
    the training rows (best mean weighted F1 = CV F1), refit on all training
    rows, then test accuracy and weighted F1. One row per model."""
    from cohortlens.operators.metrics import results_table

    spark = train.sparkSession
    preds, cv_rows = None, []
    names = F.array(*[F.lit(c) for c in classes])
    for name, (est, param_grid) in candidates.items():
        model, table = grid_search(est, param_grid, train, fold_col=fold_col, label=label, parallelism=parallelism)
        cv_rows.append((name, float(max(model.avgMetrics))))
        scored = model.bestModel.transform(test).select(
            F.lit(name).alias("model"), F.col(id_col).alias("row_id"),
            F.element_at(names, F.col(label).cast("int") + 1).alias("label"),
            F.element_at(names, F.col("prediction").cast("int") + 1).alias("prediction"))
        preds = scored if preds is None else preds.unionByName(scored)
    cv = spark.createDataFrame(cv_rows, "model string, cv_f1 double")
    out = results_table(preds, ["model"], cv=cv)
    if variant is not None:
        out = out.withColumn("variant", F.lit(variant))
    return out


def promote_best(results: DataFrame, fitted: dict, path: str, metric: str = "cv_f1", key: str = "model") -> str:
    """E15 + A08: pick the arg-max row of a result table (ties by name) and
    save that model; every winner is promoted, whatever its kind."""
    from cohortlens.operators.metrics import best_model
    name = best_model(results, metric, key).first()[key]
    fitted[name].write().overwrite().save(path)
    return name
