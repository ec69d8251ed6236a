"""Queries for the custom ensembles (M04, M05, M09, M10, M11); rows-only."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import ensemble, metrics
from cohortlens.plans.q_models import prepared, _decoded
from cohortlens.plans.registry import query


def _results(model, test, name):
    return metrics.results_table(_decoded(model.transform(test), name), ["model"])


@query("bagging_classifier_results", operators=["M04"])
def q_bagging_classifier_results(spark, sf):
    train, test, *_ = prepared(spark, sf)
    model = ensemble.BaggingClassifier(numTrees=50, maxSamples=0.7, maxFeatures=0.7,
                                       bootstrapFeatures=True, maxDepth=10, idCol="id").fit(train)
    return _results(model, test, "Bagging")


@query("bagging_regressor_mse", operators=["M05", "E06", "M06"])
def q_bagging_regressor_mse(spark, sf):
    train, test, *_ = prepared(spark, sf)
    model = ensemble.BaggingClassifier(numTrees=50, maxSamples=0.7, maxFeatures=0.7, regression=True,
                                       maxDepth=10, idCol="id").fit(train)
    return metrics.mse(model.transform(test).withColumn("model", F.lit("Bagging Regressor")), "label", "prediction")


@query("samme_results", operators=["M09"])
def q_samme_results(spark, sf):
    train, test, *_ = prepared(spark, sf)
    model = ensemble.SammeClassifier(numTrees=200, learningRate=0.5, maxDepth=3).fit(train)
    return _results(model, test, "AdaBoost")


@query("softmax_boost_results", operators=["M10"])
def q_softmax_boost_results(spark, sf):
    train, test, *_ = prepared(spark, sf)
    model = ensemble.SoftmaxBoostClassifier(numTrees=100, learningRate=0.1, maxDepth=5, subsample=0.8, idCol="id").fit(train)
    return _results(model, test, "Gradient Boosting")


@query("softmax_boost_colsample_results", operators=["M11"])
def q_softmax_boost_colsample_results(spark, sf):
    train, test, *_ = prepared(spark, sf)
    model = ensemble.SoftmaxBoostClassifier(numTrees=100, learningRate=0.1, maxDepth=5, subsample=0.8,
                                            colsample=0.8, l2=1.0, secondOrder=True,
                                            idCol="id").fit(train)
    return _results(model, test, "Boosted Trees (colsample)")
