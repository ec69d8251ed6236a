"""The model queries try the whole grids on five folds and fill all rows."""

from cohortlens.operators import grids, models, search
from cohortlens.plans import q_models
from conftest import SF_SMALL


def test_baseline_results_from_the_whole_grids(spark, monkeypatch):
    seen = {}
    for name in ("search_trees", "search_neighbours", "search_fits"):
        def noted(*args, _one=getattr(search, name), _name=name, **more):
            seen[_name] = _one(*args, **more)
            return seen[_name]
        monkeypatch.setattr(search, name, noted)
    out = q_models.q_baseline_results(spark, SF_SMALL).collect()
    assert {r["model"] for r in out} == {"Decision Tree", "Logistic Regression", "KNN"}
    assert all(0 < r[c] <= 1 for r in out for c in ("cv_f1", "test_accuracy", "test_f1"))
    # the second solver of logistic regression minimises the same loss
    assert {n: f.scores.shape for n, f in seen.items()} == {"search_trees": (90, 5), "search_neighbours": (20, 5), "search_fits": (4, 5)}
    assert len(grids.candidates(grids.DECISION_TREE)) == 90


def test_search_on_five_folds(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(float(i % 2), i % 5, Vectors.dense([i % 2 + 0.1 * i])) for i in range(40)]
    df = spark.createDataFrame(rows, ["label", "fold", "features"])
    est = models.decision_tree(max_depth=2)
    _, table = models.grid_search(est, models.grid(est, maxDepth=[1, 2]), df.withColumn("fold", df["fold"].cast("int")))
    assert table.count() == 2
