"""Queries for scoring (C01-C05, A08, A09); rows-only (model outputs)."""

from __future__ import annotations

from pyspark.ml import Pipeline

from cohortlens.operators import models, prep, score, select
from cohortlens.operators.features import ENGINEERED
from cohortlens.plans.registry import query
from cohortlens.session import materialize, scratch_path, spread
from cohortlens.sources.files import load_first, load_model, save_model
from cohortlens.sources.tables import CLASSES, FIXTURE_CATEGORICAL, FIXTURE_NUMERIC, outcomes

_MEMO: dict = {}


def scoring_fixture(spark, sf):
    """Fit engineer -> preprocess -> select -> logistic regression on the
    train split; return (PipelineModel, test rows without the label)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MEMO:
        base = outcomes(spark, sf).persist()
        sp = materialize(prep.stratified_split(base, "outcome", "id"))
        base.unpersist()
        train, test = prep.split_frames(sp)
        fe = score.FeatureEngineer()
        label_model = prep.label_indexer("outcome", "label").fit(train)
        pre = prep.build_preprocessor(FIXTURE_NUMERIC + ENGINEERED, FIXTURE_CATEGORICAL)
        staged = Pipeline(stages=[fe, *pre.getStages()]).fit(label_model.transform(train))
        prepared = materialize(spread(staged.transform(label_model.transform(train)).select("id", "label", "features"), rows=train.count()))
        sel = select.FScoreSelector(featuresCol="features", labelCol="label", outputCol="selected", k=20).fit(prepared)
        clf = models.logistic(C=1.0, n=prepared.count(), features="selected", max_iter=200) \
            .fit(sel.transform(prepared))
        model = score.scoring_model(list(staged.stages) + [sel, clf], label_model.labels)
        _MEMO[key] = (model, test.drop("outcome", "score"))
    return _MEMO[key]


@query("score_batch", operators=["C02", "C04", "M17"])
def q_score_batch(spark, sf):
    model, test = scoring_fixture(spark, sf)
    return score.score_batch(model, test, CLASSES, "id", with_text=True)


@query("score_reloaded_model", operators=["A08", "A09", "C01"])
def q_score_reloaded_model(spark, sf):
    model, test = scoring_fixture(spark, sf)
    path = scratch_path(spark, "scoring-model")
    save_model(model, path)
    reloaded = load_first([scratch_path(spark, "missing-model"), path], load_model)
    return score.score_batch(reloaded, test, CLASSES, "id")


@query("score_stream", operators=["C03", "C05", "A10"])
def q_score_stream(spark, sf):
    from cohortlens.streaming import score_stream
    model, test = scoring_fixture(spark, sf)
    src = scratch_path(spark, "arriving")
    test.repartition(4).write.parquet(src)
    sink, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "scored-ckpt")
    q = score_stream(spark, model, src, test.schema, sink, ckpt, CLASSES, "id", max_files_per_trigger=2)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    csv_path = scratch_path(spark, "scored-csv")
    score.export_scores(out, csv_path)
    return spark.read.option("header", True).schema(out.schema).csv(csv_path)
