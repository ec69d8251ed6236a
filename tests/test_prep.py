import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import prep


def _labelled(spark, n=997):
    rows = [(i, ["A", "B", "C"][(i * 7) % 10 % 3] if i % 11 else "D") for i in range(n)]
    return spark.createDataFrame(rows, "id long, y string")


def test_stratified_split_exact_disjoint_complete(spark):
    df = _labelled(spark)
    sp = prep.stratified_split(df, "y", "id", test=0.2, seed=42)
    rows = sp.collect()
    assert len(rows) == df.count() and len({r["id"] for r in rows}) == len(rows)
    counts = {}
    for r in rows:
        counts.setdefault(r["y"], [0, 0])[r["split"] == "test"] += 1
    for y, (tr, te) in counts.items():
        assert te == round((tr + te) * 0.2)


def test_split_keeps_a_large_class_in_many_tasks(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") < 10, "A").otherwise("B").alias("y")).repartition(6).persist()
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sp = prep.stratified_split(df, "y", "id")
        tasks = sp.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        assert sum(r["n"] for r in tasks) == 20_000 and max(r["n"] for r in tasks) < 5_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        df.unpersist()


def test_spread_bounds_the_rows_of_a_partition(spark):
    from cohortlens.session import spread
    rows = 50 * 100_000
    assert spread(spark.range(rows)).rdd.getNumPartitions() >= 50
    assert spread(spark.range(10), rows=10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_split_is_md5_order_and_stable_under_repartition(spark):
    import hashlib
    df = _labelled(spark, 300)
    a = {r["id"]: r["split"] for r in prep.stratified_split(df, "y", "id").collect()}
    b = {r["id"]: r["split"] for r in prep.stratified_split(df.repartition(7), "y", "id").collect()}
    assert a == b
    by = {}
    for r in df.collect():
        by.setdefault(r["y"], []).append(r["id"])
    for y, ids in by.items():
        ids.sort(key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))
        k = round(len(ids) * 0.2)
        assert {i for i in ids[:k]} == {i for i in ids if a[i] == "test"}


def test_fold_column_balanced(spark):
    df = _labelled(spark)
    f = prep.fold_column(df, "y", "id", folds=5)
    cnt = {}
    for r in f.collect():
        cnt.setdefault(r["y"], []).append(r["fold"])
    for y, folds in cnt.items():
        c = np.bincount(folds, minlength=5)
        assert c.max() - c.min() <= 1


def test_population_scaler_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "a double, c double")
    m = prep.PopulationScaler(inputCols=["a", "c"], outputCols=["a_s", "c_s"]).fit(df)
    got = [r["a_s"] for r in m.transform(df).orderBy("a").collect()]
    v = np.array([1, 2, 3, 4.0])
    assert np.allclose(got, (v - v.mean()) / v.std())
    assert all(r["c_s"] == 0.0 for r in m.transform(df).collect())


def test_one_hot_unseen_is_all_zero_and_text_order(spark):
    train = spark.createDataFrame([("1",), ("10",), ("2",)], "c string")
    test = spark.createDataFrame([("2",), ("7",)], "c string")
    model = Pipeline(stages=prep.one_hot_stages(["c"])).fit(train)
    rows = model.transform(test).select("c", vector_to_array("c__ohe").alias("v")).collect()
    got = {r["c"]: r["v"] for r in rows}
    assert got["2"] == [0.0, 0.0, 1.0]          # order '1', '10', '2'
    assert got["7"] == [0.0, 0.0, 0.0]          # unseen -> zeros


def test_label_encoding_alphabetical(spark):
    df = spark.createDataFrame([("Graduate",), ("Dropout",), ("Enrolled",)], "t string")
    out, labels = prep.encode_label(df, "t", "label")
    assert labels == ["Dropout", "Enrolled", "Graduate"]
    assert {r["t"]: r["label"] for r in out.collect()} == {"Dropout": 0.0, "Enrolled": 1.0, "Graduate": 2.0}


def test_preprocessor_persists(spark, tmp_path):
    from pyspark.ml import PipelineModel
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, c string")
    model = prep.build_preprocessor(["x"], ["c"]).fit(df)
    path = str(tmp_path / "pre")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = [r["features"].toArray().tolist() for r in model.transform(df).collect()]
    b = [r["features"].toArray().tolist() for r in back.transform(df).collect()]
    assert a == b and len(a[0]) == 3


def test_fold_column_keeps_null_labels(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "a") for i in range(50)], "id long, y string")
    f = prep.fold_column(df, "y", "id", folds=5)
    assert f.count() == 50 and f.where("fold IS NULL").count() == 0
