import numpy as np
from pyspark.sql import functions as F

from cohortlens.functions.columns import half_even_class
from cohortlens.operators import metrics


def _preds(spark):
    rows = [("m", 1, "a", "a"), ("m", 2, "a", "b"), ("m", 3, "b", "b"), ("m", 4, "b", "b"),
            ("m", 5, "c", "b"), ("m", 6, "a", "a")]
    return spark.createDataFrame(rows, "model string, row_id long, label string, prediction string")


def test_f1_by_hand(spark):
    pc = {r["class"]: r for r in metrics.per_class(_preds(spark)).collect()}
    # a: tp2 pred2 sup3 -> p1 r2/3 ; b: tp2 pred4 sup2 -> p.5 r1 ; c: tp0 pred0 sup1 -> 0
    assert np.isclose(pc["a"]["f1"], 2 * 1 * (2 / 3) / (1 + 2 / 3))
    assert np.isclose(pc["b"]["f1"], 2 * 0.5 * 1 / 1.5)
    assert pc["c"]["f1"] == 0.0 and pc["c"]["precision"] == 0.0
    wf = metrics.weighted_f1(_preds(spark)).first()["weighted_f1"]
    assert np.isclose(wf, (3 * pc["a"]["f1"] + 2 * pc["b"]["f1"]) / 6)
    assert np.isclose(metrics.accuracy(_preds(spark)).first()["accuracy"], 4 / 6)


def test_confusion_matrix_includes_zero_rows(spark):
    cm = {r["label"]: r for r in metrics.confusion_matrix(_preds(spark), ["a", "b", "c", "d"]).collect()}
    assert cm["d"]["a"] == 0 and cm["c"]["b"] == 1 and cm["a"]["a"] == 2 and cm["a"]["b"] == 1


def test_roc_ties_and_auc(spark):
    # scores with a tie at 0.5 (one positive, one negative)
    rows = [("m", i, "k", y, s) for i, (y, s) in enumerate([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.2), (1, 0.1)])]
    b = spark.createDataFrame(rows, "model string, row_id long, class string, y int, score double")
    roc = metrics.roc_curve(b, drop_intermediate=False).orderBy("point").collect()
    pts = [(r["fpr"], r["tpr"]) for r in roc]
    assert pts == [(0.0, 0.0), (0.0, 1 / 3), (0.5, 2 / 3), (1.0, 2 / 3), (1.0, 1.0)]
    a = metrics.auc(metrics.roc_curve(b)).first()["auc"]
    # rank-sum AUC with ties counted half
    pos, neg = [0.9, 0.5, 0.1], [0.5, 0.2]
    exp = np.mean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])
    assert np.isclose(a, exp)


def test_half_even_and_clip(spark):
    df = spark.createDataFrame([(v,) for v in [0.5, 1.5, 2.5, -0.7, 3.2, 1.49]], "p double")
    got = [r[0] for r in df.select(half_even_class("p")).collect()]
    assert got == [0, 2, 2, 0, 2, 1]


def test_rank_and_best(spark):
    res = spark.createDataFrame([("x", 0.7), ("y", 0.9), ("z", 0.9)], "model string, test_f1 double")
    ranked = {r["model"]: r["rank"] for r in metrics.rank_models(res).collect()}
    assert ranked == {"y": 1, "z": 2, "x": 3}
    assert metrics.best_model(res, "test_f1").first()["model"] == "y"


def _roc_reference(y, s, drop=True):
    """sklearn-style roc_curve written out: distinct thresholds descending,
    cumulative tps/fps, optional collinear drop, origin prepended."""
    order = np.argsort(-s, kind="stable")
    y, s = y[order], s[order]
    idx = np.r_[np.nonzero(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    if drop and len(tps) > 2:
        keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
        tps, fps = tps[keep], fps[keep]
    tps, fps = np.r_[0, tps], np.r_[0, fps]
    return list(zip(fps / fps[-1], tps / tps[-1]))


def test_roc_two_level_matches_reference_across_range_borders(spark):
    rng = np.random.default_rng(7)
    s = np.round(rng.random(400), 2)                  # many ties
    y = (rng.random(400) < s).astype(int)
    rows = [("m", i, "k", int(y[i]), float(s[i])) for i in range(400)]
    b = spark.createDataFrame(rows, "model string, row_id long, class string, y int, score double")
    exp = _roc_reference(y, s)
    for buckets in (1, 3, 17):
        got = [(r["fpr"], r["tpr"]) for r in metrics.roc_curve(b, buckets=buckets).orderBy("point").collect()]
        assert np.allclose(got, exp), buckets
    auc_exp = sum((exp[i][0] - exp[i - 1][0]) * (exp[i][1] + exp[i - 1][1]) / 2 for i in range(1, len(exp)))
    assert np.isclose(metrics.auc_from_scores(b).first()["auc"], auc_exp)


def test_promote_best_saves_the_argmax_model(spark, tmp_path):
    from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors
    from cohortlens.operators.models import promote_best
    df = spark.createDataFrame([(Vectors.dense([float(i % 3)]), float(i % 3)) for i in range(30)], ["features", "label"])
    a = DecisionTreeClassifier(maxDepth=1).fit(df)
    b = DecisionTreeClassifier(maxDepth=3).fit(df)
    res = spark.createDataFrame([("a", 0.5), ("b", 0.9)], "model string, cv_f1 double")
    name = promote_best(res, {"a": a, "b": b}, str(tmp_path / "best"))
    assert name == "b" and DecisionTreeClassificationModel.load(str(tmp_path / "best")).depth == b.depth


def test_score_ranges_follow_the_distinct_scores(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=4000)], "s double")
    ranges = metrics._score_ranges(df, "s", 4, target=100).groupBy("__b").count().collect()
    assert len(ranges) > 40 and max(r["count"] for r in ranges) <= 110
    assert metrics._score_ranges(df, "s", 4).select("__b").distinct().count() == 4
    assert metrics._score_ranges(df.limit(0), "s", 4).count() == 0
