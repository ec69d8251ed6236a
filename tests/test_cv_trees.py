"""Cross-validated trees grow together and are those of Spark ML on each fold."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlens.operators import histtrees, models, search, select


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(21)
    rows = []
    for i in range(900):
        x = [rng.normal(), rng.random() * 50, float(rng.integers(0, 2)), float(rng.integers(0, 9)), 3.0, rng.exponential()]
        y = 0.0 if x[0] + 0.3 * rng.normal() < -0.4 else (1.0 if x[1] + x[3] + 5 * rng.normal() < 25 else 2.0)
        rows.append((i, Vectors.dense(x), y, i % 3))
    df = spark.createDataFrame(rows, ["id", "features", "label", "fold"])
    return df.withColumn("fold", F.col("fold").cast("int")).persist()


def _spark_scores(estimator, df, folds):
    out, ev = [], models.f1_evaluator()
    for f in range(folds):
        out.append(ev.evaluate(estimator.fit(df.where(F.col("fold") != f)).transform(df.where(F.col("fold") == f))))
    return out


def _blocks(monkeypatch, rows):
    init = histtrees.Table.__init__
    monkeypatch.setattr(histtrees.Table, "__init__", lambda self, *args, **more: init(self, *args, **more | {"block_rows": rows}))


@pytest.fixture
def no_fit(monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier

    def refused(self, *args, **kwargs):
        raise AssertionError("a fit for each fold reads the rows again and again")

    return lambda: monkeypatch.setattr(DecisionTreeClassifier, "_fit", refused)


@pytest.mark.parametrize("rows", [32_768, 200])
def test_fold_scores_are_those_of_spark_trees(folded, monkeypatch, no_fit, rows):
    made = [models.decision_tree(max_depth=6), models.decision_tree(max_depth=4, min_samples_leaf=7, criterion="entropy", max_bins=20)]
    want = [_spark_scores(est, folded, 3) for est in made]
    no_fit()
    _blocks(monkeypatch, rows)
    for est, one in zip(made, want, strict=True):
        assert [r["score"] for r in models.cv_scores(est, folded, folds=3).orderBy("fold").collect()] == pytest.approx(one, abs=1e-12)


@pytest.mark.parametrize("leaky", [False, True])
def test_sweep_is_that_of_a_selector_and_a_tree_for_each_k_and_fold(folded, monkeypatch, no_fit, leaky):
    from pyspark.ml import Pipeline
    ks, want = [1, 2, 4], {}
    for k in ks:
        selector = select.FScoreSelector(featuresCol="features", labelCol="label", outputCol="__sel", k=k)
        tree = models.decision_tree(max_depth=5, features="__sel")
        want[k] = np.mean(_spark_scores(tree, selector.fit(folded).transform(folded), 3) if leaky else _spark_scores(Pipeline(stages=[selector, tree]), folded, 3))
    no_fit()
    _blocks(monkeypatch, 200)
    summary, best = select.sweep_k(folded, ks, lambda c: models.decision_tree(max_depth=5, features=c), folds=3, leaky=leaky)
    got = {r["k"]: r["mean"] for r in summary.collect()}
    assert got == pytest.approx(want, abs=1e-12) and best.first()["best_k"] == max(ks, key=lambda k: (want[k], -k))


def test_scores_of_all_folds_come_from_one_pass(folded):
    together = select.fold_f_scores(folded, "features", "label", "fold", 3)
    for f, got in enumerate(together):
        assert got == pytest.approx(select.vector_f_scores(folded.where(F.col("fold") != f), "features", "label"), rel=1e-9, nan_ok=True)


def test_other_estimators_are_fitted(folded):
    weighted = models.decision_tree(max_depth=2, weight="w")
    assert not search.grows(weighted, folded, "features") and not search.grows(models.logistic(), folded, "features")
    assert search.grows(models.decision_tree(max_depth=2), folded, "features")
    assert models.cv_scores(models.logistic(max_iter=3), folded, folds=3).count() == 3


@pytest.mark.parametrize("columns", [["id", "features", "label", "fold"], ["features", "label", "fold"]])
def test_few_distinct_rows_of_a_large_table_are_all_cut(spark, monkeypatch, columns):
    """More rows than the sample takes, but four distinct vectors: a hash of the vector would leave out most of them."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        a, b = int(rng.random() < 0.5), int(rng.random() < 0.1)
        rows.append((i, Vectors.dense(a, b), float((2 if a else b) if rng.random() < 0.8 else rng.integers(0, 3)), int(rng.integers(0, 3))))
    df = spark.createDataFrame(rows, ["id", "features", "label", "fold"]).withColumn("fold", F.col("fold").cast("int")).select(*columns)
    want = _spark_scores(models.decision_tree(max_depth=2), df, 3)
    monkeypatch.setattr(histtrees, "SAMPLE_ROWS", 100)
    assert [r["score"] for r in models.cv_scores(models.decision_tree(max_depth=2), df, folds=3).orderBy("fold").collect()] == pytest.approx(want, abs=1e-12)
    summary, _ = select.sweep_k(df, [1, 2], lambda c: models.decision_tree(max_depth=2, features=c), folds=3)
    assert summary.where("k = 2").first()["mean"] == pytest.approx(np.mean(want), abs=1e-12)


def test_sampled_rows_count_as_often_as_they_stand_there(spark, monkeypatch):
    monkeypatch.setattr(histtrees, "SAMPLE_ROWS", 20)
    df = spark.createDataFrame([([float(min(i, 6))], 0.0) for i in range(40)], "features array<double>, label double")
    rows = []
    table = histtrees.Table(df, rule=lambda sample: (rows.append(sample), histtrees.fold_cuts(sample, 1, 32))[1])
    table.release()
    [sample] = rows
    assert sample.rows == 40 and dict(zip(sample.values[:, 0].tolist(), sample.weight.tolist(), strict=True)) == {**dict.fromkeys(range(6), 1.0), 6.0: 34.0}
    assert histtrees.cuts_of(np.array([[1.0], [2.0], [3.0]]), 2, np.array([6, 1, 1])).points[0].tolist() == histtrees.cuts_of(np.array([[1.0]] * 6 + [[2.0], [3.0]]), 2).points[0].tolist()
