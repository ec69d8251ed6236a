import math

import numpy as np
from pyspark.sql import functions as F

from cohortlens.operators import eda, prep, profile


def _frame(spark):
    rows = [(1, "a", 1.0, 10), (2, "b", None, 10), (3, "a", float("nan"), 20), (4, None, 4.0, 20),
            (5, "c", 5.0, 20)]
    return spark.createDataFrame(rows, "id long, cat string, x double, k int")


def test_nulls_nan_and_patterns(spark):
    df = _frame(spark)
    nulls = {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()}
    assert nulls == {"id": 0, "cat": 1, "x": 2, "k": 0, "__total__": 3}
    pats = {r["pattern"]: r["rows"] for r in profile.missing_patterns(df).collect()}
    assert pats == {"1111": 2, "1101": 2, "1011": 1}      # NaN counts as missing, as NULL does


def test_nunique_info_and_roles(spark):
    df = _frame(spark)
    nu = {r["column"]: r["nunique"] for r in profile.nunique(df).collect()}
    assert nu["cat"] == 3 and nu["k"] == 2 and nu["id"] == 5
    info = {r["column"]: (r["non_null"], r["dtype"], r["rows"]) for r in profile.info(df).collect()}
    assert info["x"] == (4, "double", 5) and info["cat"] == (4, "string", 5)
    roles = {r["column"]: r["role"] for r in profile.infer_roles(df, "cat", threshold=2).collect()}
    assert roles == {"id": "numeric", "x": "numeric", "k": "categorical"}


def test_value_counts_percent_and_order(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "v string")
    rows = profile.value_counts(df, "v").collect()
    assert [(r["value"], r["count"]) for r in rows] == [("a", 2), ("b", 2), ("c", 1)]
    assert math.isclose(rows[0]["percent"], 40.0)


def test_mode_imputer_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b", 3), ("a", 1), ("b", 1), ("a", 3), (None, None)], "s string, n int")
    m = prep.ModeImputer(inputCols=["s", "n"], outputCols=["s2", "n2"]).fit(df)
    last = m.transform(df).where(F.col("s").isNull()).first()
    assert last["s2"] == "a" and last["n2"] == 1


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "c double, y double")
    r = eda.corr_with(df, ["c"], "y").first()
    assert r["corr"] is None


def test_box_stats_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(0, 1, 200), [8.0, -9.0]])
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, x double")
    r = eda.box_stats(df, "g", ["x"]).first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    iqr = q3 - q1
    inside = vals[(vals >= q1 - 1.5 * iqr) & (vals <= q3 + 1.5 * iqr)]
    assert np.allclose([r["q1"], r["median"], r["q3"]], [q1, med, q3])
    assert r["whisker_lo"] == inside.min() and r["whisker_hi"] == inside.max()
    assert r["outliers"] == len(vals) - len(inside)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    bins = {r["bin"]: r["count"] for r in eda.histogram(df, "x", bins=5).collect()}
    assert bins == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}     # the maximum falls in the last bin


def test_crosstab_normalized_rows_sum_to_100(spark):
    df = spark.createDataFrame([("m", "A"), ("m", "B"), ("f", "A"), ("f", "A")], "g string, y string")
    rows = {r["g"]: r for r in eda.crosstab(df, "g", "y", normalize="index").collect()}
    assert rows["f"]["A"] == 100.0 and rows["f"]["B"] == 0.0
    assert rows["m"]["A"] + rows["m"]["B"] == 100.0


def test_vector_correlation_matches_column_correlation(spark):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(3)
    rows = [(float(a), float(a * 0.5 + b), float(b), 1.0) for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "x double, y double, z double, c double")
    vec = VectorAssembler(inputCols=["x", "y", "z", "c"], outputCol="v").transform(df)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in eda.corr_matrix_vector(vec, "v", ["x", "y", "z", "c"]).collect()}
    exp = {(r["col_a"], r["col_b"]): r["corr"] for r in eda.corr_matrix(df, ["x", "y", "z", "c"]).collect()}
    for k, v in exp.items():
        if v is None:
            assert got[k] is None
        else:
            assert abs(got[k] - v) < 1e-9


def test_anova_single_class_is_null(spark):
    from cohortlens.operators.select import anova_f
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "y string, x double")
    assert anova_f(df, ["x"], "y").first()["f_score"] is None


def test_kde_constant_class_gives_null_density(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 2.0), ("b", 3.0)], "g string, x double")
    rows = eda.kde(df, "x", "g", points=5).collect()
    assert all(r["density"] is None for r in rows if r["g"] == "a")
    assert all(r["density"] is not None and r["density"] > 0 for r in rows if r["g"] == "b")


def test_nunique_of_every_type_agrees_with_distinct(spark):
    """Narrow cells give what the grouping holds equal: -0.0 and 0.0, NaN, NULL, instants of a repeated hour, collated text."""
    df = spark.sql("""
        SELECT CAST(n AS double) AS d, CAST(n AS float) AS f, CAST(n AS decimal(9, 2)) AS m, n > 1 AS b, CAST(n AS tinyint) AS t,
               CAST(CAST(n AS string) AS binary) AS raw, array(n) AS arr, date_add(DATE'2020-01-01', CAST(n AS int)) AS day,
               timestamp_seconds(n * 3600 + 1603584000) AS ts, s, collate(s, 'UTF8_LCASE') AS folded, NULL AS void
        FROM VALUES (0, 'a'), (1, 'A'), (2, ''), (2, NULL), (NULL, 'a') AS x(n, s)
        UNION ALL SELECT -0.0D, CAST('NaN' AS float), NULL, NULL, NULL, NULL, NULL, NULL, NULL, ' a', collate('B', 'UTF8_LCASE'), NULL
        UNION ALL SELECT CAST('NaN' AS double), CAST('NaN' AS float), 1.00, NULL, 1, NULL, array(1), NULL, NULL, 'a', collate('b', 'UTF8_LCASE'), NULL""")
    want = df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    assert {r["column"]: r["nunique"] for r in profile.nunique(df).collect()} == want
    assert {r["column"]: r["nunique"] for r in profile.nunique(df.limit(0)).collect()} == dict.fromkeys(df.columns, 0)
    assert profile.nunique(df, []).count() == 0
    plan = profile.nunique(df.drop("arr", "folded", "void"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_nunique_of_clashing_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "__at int, `__te.xt` int")
    assert [tuple(r) for r in profile.nunique(df).collect()] == [(0, "__at", 1), (1, "__te.xt", 2)]


def test_crowded_ranges_are_cut_again(spark):
    """90 % of the rows in one of four ranges, a value held by a third of all, infinities: exact, and no range above the target."""
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(0, 1e-6, 1500), np.full(1000, 5.0), rng.normal(50, 20, 300), [np.inf, -np.inf]])
    rows = [("ab"[i % 2], float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, x double")
    seen = []
    real = eda._recut

    def watched(df, cols, splits, located, buckets, accuracy, target):
        out = real(df, cols, splits, located, buckets, accuracy, target)
        if out is None:
            left = located(splits).groupBy("column", "__b").agg(F.sum("__n").alias("n")).collect()
            seen.extend((r["n"], splits[0][r["__b"]], splits[0][r["__b"] + 1]) for r in left)
        return out

    eda._recut = watched
    try:
        got = eda.exact_percentiles(df, "g", ["x"], [0.1, 0.5, 0.62, 0.9], buckets=4, target=60).collect()
    finally:
        eda._recut = real
    assert seen and all(n <= 60 or hi == math.nextafter(lo, math.inf) for n, lo, hi in seen)
    for r in got:
        mine = np.array([v for g, v in rows if g == r["g"]])
        assert np.isclose(r["value"], np.quantile(mine, r["p"]), rtol=1e-12, atol=0)
    assert len(got) == 8


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], float(v)) for i, v in enumerate(np.concatenate([rng.normal(0, 1, 300), rng.exponential(30, 100)]))]
    df = spark.createDataFrame([*rows, ("c", 1.0), ("c", 1.0), ("a", None), ("b", float("nan"))], "g string, x double")
    exact = {(r["g"], r["point"]): r for r in eda.kde(df, "x", "g", points=40).collect()}
    worst = {}
    for s in (1, 4, 64):
        for r in eda.kde(df, "x", "g", points=40, bins_per_bandwidth=s).collect():
            true = exact[r["g"], r["point"]]
            assert true["x"] == r["x"]
            if r["g"] == "c":
                assert r["density"] is None and true["density"] is None
                continue
            values = np.array([v for g, v in rows if g == r["g"]])
            bound = 1 / (8 * s * s * math.sqrt(2 * math.pi) * values.std(ddof=1) * len(values) ** -0.2)
            assert abs(r["density"] - true["density"]) <= bound * (1 + 1e-9) + 1e-15
            worst[s] = max(worst.get(s, 0), abs(r["density"] - true["density"]))
    assert worst[1] > worst[4] > worst[64]
    assert eda.kde(df.limit(0), "x", "g", points=4, bins_per_bandwidth=4).count() == 0
