import pytest
from pyspark.sql import functions as F

from cohortlens.operators import eda, prep, select


def test_pearson_uses_rows_with_both_values(spark):
    df = spark.createDataFrame([(float(i), float(i) if i % 20 == 0 else (None if i % 2 else float("nan"))) for i in range(100)],
                               "x double, y double")
    assert eda.corr_with(df, ["x"], "y").first()["corr"] == pytest.approx(1.0)


def test_anova_counts_each_feature_and_keeps_digits(spark):
    rows = [(i % 3, float(i % 7 + i % 3), None if i % 2 else float(i % 7 + i % 3), 1e9 + i % 7 + i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "c int, a double, h double, o double")
    got = {r["feature"]: r["f_score"] for r in select.anova_f(df, ["a", "h", "o"], "c").collect()}
    assert got["o"] == pytest.approx(got["a"], rel=1e-4)
    half = {r["feature"]: r["f_score"] for r in select.anova_f(df.where("h is not null"), ["a"], "c").collect()}
    assert got["h"] == pytest.approx(half["a"])


def test_nan_is_missing_in_box_histogram_and_density(spark):
    rows = [("a", float(i)) for i in range(101)] + [("a", float("nan")), ("a", None), (None, 5.0), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    box = {r["g"]: r for r in eda.box_stats(df, "g", ["x"]).collect()}
    assert (box["a"]["n"], box["a"]["median"], box["a"]["outliers"]) == (101, 50.0, 0)
    assert (box[None]["n"], box[None]["median"]) == (2, 6.0)
    hist = eda.histogram(df, "x", bins=10).collect()
    assert sum(r["count"] for r in hist) == 103 and max(r["bin_hi"] for r in hist) == 100.0
    dense = eda.kde(df, "x", "g", points=5).where("g = 'a'").collect()
    assert len(dense) == 5 and all(r["density"] > 0 for r in dense)


def test_quota_above_the_group_takes_all_and_null_is_a_class(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, "a").when(F.col("id") < 80, "b").alias("c"))
    quota = spark.createDataFrame([("a", 999), ("b", 7), (None, 3)], "c string, quota long")
    out = prep.smallest_per_group(df, "c", F.md5(F.col("id").cast("string")), "id", quota)
    got = {r["c"]: r["n"] for r in out.where("__selected").groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 50, "b": 7, None: 3} and out.count() == 100
    split = prep.stratified_split(df, "c", "id").where("split = 'test'").groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in split} == {"a": 10, "b": 6, None: 4}


def test_samme_votes_take_from_the_other_classes(spark):
    """Two learners with alpha 1 and 3 and three classes, by hand."""
    import math

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    from cohortlens.operators.ensemble import SammeBoost

    def tree(pairs):
        df = spark.createDataFrame([(Vectors.dense(float(x)), float(y)) for x, y in pairs], ["features", "label"])
        return DecisionTreeClassifier(maxDepth=3, seed=1).fit(df)

    boost = SammeBoost()
    boost.num_classes = 3
    boost.trees = [tree([(0, 0), (1, 1), (2, 2)]), tree([(0, 0), (1, 2), (2, 2)])]
    boost.alphas = [1.0, 3.0]
    row = boost.transform(spark.createDataFrame([(Vectors.dense(1.0),)], ["features"])).first()
    decision = [(-0.5 - 1.5) / 4, (1.0 - 1.5) / 4, (-0.5 + 3.0) / 4]
    want = [math.exp(d / 2) for d in decision]
    assert list(row["probability"]) == pytest.approx([w / sum(want) for w in want])
    assert row["prediction"] == 2.0


def test_functions_reach_workers_elsewhere(tmp_path):
    """From another working directory, without PYTHONPATH."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from cohortlens.session import get_session
from cohortlens.plans.registry import all_queries
spark = get_session(master="local[2]")
print("rows", all_queries()["knn_neighbors"].run(spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout, out.stderr[-2000:]
