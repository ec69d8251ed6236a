from pyspark.sql import functions as F

from cohortlens.operators.features import ENGINEERED, engineer_features, new_columns


def test_age_bins_right_closed_and_guards(spark):
    rows = [(1, 20, 0, 0, 0, 0, 10.0, 12.0, 1, 2, 0, 1), (2, 21, 3, 4, 2, 3, 11.0, 9.0, 0, 0, 1, 1),
            (3, 25, 1, 0, 1, 0, 0.0, 0.0, 0, 0, 0, 0), (4, 26, 2, 2, 2, 2, 20.0, 20.0, 0, 0, 0, 0),
            (5, 30, 0, 0, 0, 0, 0.0, 0.0, 0, 0, 0, 0), (6, 31, 1, 1, 1, 1, 5.0, 5.0, 0, 0, 0, 0),
            (7, 0, 0, 0, 0, 0, 0.0, 0.0, 0, 0, 0, 0), (8, 101, 0, 0, 0, 0, 0.0, 0.0, 0, 0, 0, 0),
            (9, None, 0, 0, 0, 0, 0.0, 0.0, 0, 0, 0, 0)]
    schema = ("id long, age int, p1_enrolled long, p2_enrolled long, p1_approved long, p2_approved long, "
              "p1_grade double, p2_grade double, p1_credited long, p2_credited long, "
              "p1_without_eval long, p2_without_eval long")
    df = engineer_features(spark.createDataFrame(rows, schema))
    got = {r["id"]: r for r in df.collect()}
    assert [got[i]["age_group"] for i in range(1, 10)] == [0, 1, 1, 2, 2, 3, None, None, None]
    assert got[1]["approval_rate"] == 0.0            # nothing enrolled: zero guard
    assert got[2]["approval_rate"] == 5 / 7
    assert got[2]["total_approved"] == 5 and got[2]["total_enrolled"] == 7
    assert got[2]["avg_grade"] == 10.0 and got[2]["grade_improvement"] == -2.0
    assert got[2]["approval_improvement"] == 1
    assert got[1]["total_credited"] == 3 and got[1]["total_without_eval"] == 1
    assert new_columns(spark.createDataFrame(rows, schema), df) == ENGINEERED


def test_one_projection_no_shuffle(spark):
    df = spark.range(10).select(F.col("id"), *[F.lit(1).cast("long").alias(c) for c in [
        "p1_enrolled", "p2_enrolled", "p1_approved", "p2_approved", "p1_credited", "p2_credited",
        "p1_without_eval", "p2_without_eval"]], F.lit(2.0).alias("p1_grade"), F.lit(3.0).alias("p2_grade"),
        F.lit(22).alias("age"))
    plan = engineer_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
