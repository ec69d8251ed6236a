"""Model, scoring and attribution queries whose answers have a closed form.

Two 0/1 features of the fixture (`a`: at least three approved units, `b`: mean
grade of at least 10) make three groups of rows with different majority
classes. On them a tree of depth 2 has the three groups as leaves, so that
fitted predictions, probabilities, importances, fold scores, base values and
Shapley values are sums over class counts, which the SQL twins compute from
the tables. The attribution summaries run on a fixed linear rule
(phi = weight x (value - centre)) over eight features and all rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from cohortlens.operators import explain, models, prep, score, select, treeshap
from cohortlens.plans.oracle import with_outcomes
from cohortlens.plans.registry import query
from cohortlens.session import materialize, scratch_path, spread
from cohortlens.sources.files import load_first, load_model, save_model
from cohortlens.sources.tables import CLASSES, outcomes

MIN_APPROVED, MIN_GRADE = 3, 10.0
P_COLUMNS = [f"p_{c}" for c in CLASSES]
NAMES = ["a", "b", "c"]
#: the 0/1 features; `c` (parity of the id) tells nothing about the class
FLAGS = {"a": f"CASE WHEN p1_approved + p2_approved >= {MIN_APPROVED} THEN 1 ELSE 0 END",
         "b": f"CASE WHEN (p1_grade + p2_grade) / 2 >= {MIN_GRADE} THEN 1 ELSE 0 END",
         "c": "CASE WHEN id % 2 = 1 THEN 1 ELSE 0 END"}
FLAG_SQL = ", ".join(f"{sql} AS {name}" for name, sql in FLAGS.items())

LEAVES = f"""fl AS (SELECT id, outcome, CASE outcome WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 ELSE 2 END AS y, {FLAG_SQL} FROM outcomes),
lf AS (SELECT *, CASE WHEN a = 1 THEN 2 WHEN b = 1 THEN 1 ELSE 0 END AS leaf FROM fl),
sh AS (SELECT leaf, count(*) AS n, {', '.join(f"avg(CASE WHEN outcome = '{c}' THEN 1.0 ELSE 0.0 END) AS p_{c}" for c in CLASSES)} FROM lf GROUP BY leaf)"""


def _sql(body: str, *ctes: str) -> str:
    return with_outcomes("WITH " + ",\n".join([LEAVES, *ctes]) + "\n" + body)


def flagged(spark, sf, names=("a", "b")):
    """Fixture rows with the 0/1 features as a vector and the class code."""
    code = F.when(F.col("outcome") == "Dropout", 0.0).when(F.col("outcome") == "Enrolled", 1.0).otherwise(2.0)
    flags = outcomes(spark, sf).select("id", "outcome", code.alias("label"),
                                       *[F.expr(FLAGS[n]).cast("double").alias(n) for n in names])
    vectors = VectorAssembler(inputCols=list(names), outputCol="features").transform(flags)
    return materialize(spread(vectors))


def _class_of(index):
    return F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col(index).cast("int") + 1)


def _scored(model, df):
    scored = models.predict_proba(models.predict(model, df), CLASSES)
    return scored.select("id", _class_of("prediction").alias("predicted"), *P_COLUMNS)


_CLASS_CASE = "CASE leaf WHEN 0 THEN 'Dropout' WHEN 1 THEN 'Enrolled' ELSE 'Graduate' END"
_SHARES_SQL = _sql(f"SELECT id, {_CLASS_CASE} AS predicted, {', '.join(P_COLUMNS)} FROM lf JOIN sh USING (leaf)")


# ---------------------------------------------------------------- M01, M02, M07, M08, M15-M17
@query("closed_tree", _SHARES_SQL, round_cols=P_COLUMNS, operators=["M01", "M16", "M17"])
def q_closed_tree(spark, sf):
    df = flagged(spark, sf)
    return _scored(models.decision_tree(max_depth=2).fit(df), df)


@query("closed_forest", _SHARES_SQL, round_cols=P_COLUMNS, operators=["M07", "M16", "M17"])
def q_closed_forest(spark, sf):
    """Without row draws and with all features at each split, every tree of a
    forest is the same one."""
    df = flagged(spark, sf)
    forest = models.random_forest(n_estimators=5, max_depth=2, max_features="all").setBootstrap(False)
    return _scored(forest.fit(df), df)


@query("closed_logistic", _sql(
    "SELECT leaf, " + ", ".join(f"round({p}, 4) AS {p}" for p in P_COLUMNS) + " FROM sh"), operators=["M02", "M17"])
def q_closed_logistic(spark, sf):
    """A group indicator each and next to no penalty: the fitted probabilities
    are the groups' class shares (to the solver's precision)."""
    df = flagged(spark, sf).withColumn("leaf", F.when(F.col("a") == 1, 2).when(F.col("b") == 1, 1).otherwise(0))
    groups = df.withColumns({f"g{k}": (F.col("leaf") == k).cast("double") for k in (1, 2)})
    data = VectorAssembler(inputCols=["g1", "g2"], outputCol="groups").transform(groups)
    est = models.logistic(C=1e9, n=data.count(), features="groups").setTol(1e-12)
    scored = models.predict_proba(models.predict(est.fit(data), data), CLASSES)
    return scored.groupBy("leaf").agg(*[F.round(F.avg(p), 4).alias(p) for p in P_COLUMNS])


@query("closed_forest_regressor", _sql(
    "SELECT id, m AS prediction, CAST(round_even(m, 0) AS DOUBLE) AS class_prediction FROM lf JOIN cell USING (a, b)",
    "cell AS (SELECT a, b, avg(CAST(y AS DOUBLE)) AS m FROM lf GROUP BY a, b)"),
    round_cols=["prediction"], operators=["M08", "M06"])
def q_closed_forest_regressor(spark, sf):
    df = flagged(spark, sf)
    est = models.random_forest_regressor(n_estimators=5, max_depth=2, max_features="all").setBootstrap(False)
    return models.to_class(models.predict(est.fit(df), df)).select("id", "prediction", "class_prediction")


def _gini(rows: str) -> str:
    squares = " + ".join(f"pow(avg(CASE WHEN y = {k} THEN 1.0 ELSE 0.0 END) FILTER ({rows}), 2)" for k in range(3))
    return f"count(*) FILTER ({rows}) * (1 - ({squares}))"


@query("closed_importances", _sql(
    """SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INT) AS rank, feature, importance FROM (
  SELECT 'a' AS feature, (al - a0 - a1) / (al - a0 - a1 + a0 - b0 - b1) AS importance FROM im
  UNION ALL SELECT 'b', (a0 - b0 - b1) / (al - a0 - a1 + a0 - b0 - b1) FROM im UNION ALL SELECT 'c', 0.0)""",
    f"""im AS (SELECT {_gini('WHERE TRUE')} AS al, {_gini('WHERE a = 0')} AS a0, {_gini('WHERE a = 1')} AS a1,
  {_gini('WHERE a = 0 AND b = 0')} AS b0, {_gini('WHERE a = 0 AND b = 1')} AS b1 FROM lf)"""),
    round_cols=["importance"], operators=["M15"])
def q_closed_importances(spark, sf):
    df = flagged(spark, sf, NAMES)
    return models.importances(models.decision_tree(max_depth=2).fit(df), NAMES, spark=spark)


# ---------------------------------------------------------------- M13, L03, L04
def _fold_scores(cell: str) -> str:
    """CTEs up to `sc` (fold, score): weighted F1 of the majority class that
    the other folds give each cell."""
    return f"""fo AS (SELECT *, {cell} AS cell, CAST((row_number() OVER (PARTITION BY outcome ORDER BY md5(CAST(id AS VARCHAR) || '|43'), id) - 1) % 5 AS INT) AS fold FROM lf),
ks AS (SELECT range AS held FROM range(5)),
mj AS (SELECT held, cell, arg_max(y, (n, -y)) AS prediction FROM (SELECT held, cell, y, count(*) AS n FROM fo JOIN ks ON fold <> held GROUP BY ALL) GROUP BY held, cell),
pr AS (SELECT fold, y, prediction, count(*) AS n FROM fo JOIN mj ON fold = held AND fo.cell = mj.cell GROUP BY ALL),
pc AS (SELECT fold, class, sum(CASE WHEN y = class THEN n ELSE 0 END) AS support, sum(CASE WHEN prediction = class THEN n ELSE 0 END) AS predicted,
  sum(CASE WHEN y = class AND prediction = class THEN n ELSE 0 END) AS tp FROM pr, (SELECT range AS class FROM range(3)) GROUP BY fold, class),
sc AS (SELECT fold, sum(2.0 * tp / (support + predicted) * support) / sum(support) AS score FROM pc WHERE support + predicted > 0 GROUP BY fold)"""


@query("closed_cv_scores", _sql("SELECT fold, CAST(score AS DOUBLE) AS score FROM sc", _fold_scores("leaf")),
       round_cols=["score"], operators=["M13"])
def q_closed_cv_scores(spark, sf):
    folded = materialize(prep.fold_column(flagged(spark, sf), "outcome", "id", folds=5))
    return models.cv_scores(models.decision_tree(max_depth=2), folded, folds=5).select(
        F.col("fold").cast("int").alias("fold"), "score")


def _sweep_sql() -> str:
    one = with_outcomes("WITH " + LEAVES + ",\n" + _fold_scores("a")
                        + "\nSELECT CAST(1 AS INT) AS k, CAST(avg(score) AS DOUBLE) AS mean, CAST(stddev_pop(score) AS DOUBLE) AS std FROM sc")
    two = with_outcomes("WITH " + LEAVES + ",\n" + _fold_scores("leaf")
                        + "\nSELECT CAST(2 AS INT) AS k, CAST(avg(score) AS DOUBLE) AS mean, CAST(stddev_pop(score) AS DOUBLE) AS std FROM sc")
    return (f"WITH s AS (SELECT * FROM ({one}) AS o UNION ALL SELECT * FROM ({two}) AS t)\n"
            "SELECT k, mean, std, k = (SELECT arg_max(k, mean) FROM s) AS is_best FROM s")


@query("closed_k_sweep", _sweep_sql(), round_cols=["mean", "std"], operators=["L03", "L04", "L05"])
def q_closed_k_sweep(spark, sf):
    """One feature of three (by F score) against two, five folds each."""
    folded = materialize(prep.fold_column(flagged(spark, sf, NAMES), "outcome", "id", folds=5))
    summary, best = select.sweep_k(folded, [1, 2], lambda f: models.decision_tree(max_depth=2, features=f), folds=5)
    return summary.withColumn("is_best", F.col("k") == best.first()["best_k"])


# ---------------------------------------------------------------- A08, A09, C01-C05
def _closed_pipeline(spark, sf):
    """Raw columns -> flags -> vector -> tree -> class name, as one model."""
    df = outcomes(spark, sf)
    staged = Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {FLAG_SQL} FROM __THIS__"),
                              VectorAssembler(inputCols=["a", "b"], outputCol="features")]).fit(df)
    tree = models.decision_tree(max_depth=2).fit(flagged(spark, sf))
    return score.scoring_model([*staged.stages, tree], CLASSES), df.drop("outcome", "score")


_SCORE_SQL = _sql(f"""SELECT id, {_CLASS_CASE} AS predicted, {', '.join(P_COLUMNS)},
  {_CLASS_CASE} || printf(': %.1f%%', greatest({', '.join(P_COLUMNS)}) * 100) AS confidence FROM lf JOIN sh USING (leaf)""")


@query("closed_score_batch", _SCORE_SQL, round_cols=P_COLUMNS, operators=["A08", "A09", "C02", "C04"])
def q_closed_score_batch(spark, sf):
    """Saved, loaded by the fallback list and scored in one projection."""
    model, rows = _closed_pipeline(spark, sf)
    path = scratch_path(spark, "closed-model")
    save_model(model, path)
    loaded = load_first([scratch_path(spark, "no-such-model"), path], load_model)
    return score.score_batch(loaded, rows, CLASSES, "id", with_text=True)


@query("closed_score_stream", _SCORE_SQL, round_cols=P_COLUMNS, operators=["C03", "C05", "A10"])
def q_closed_score_stream(spark, sf):
    """Files arrive, are scored by the stream, exported as CSV and read back."""
    from cohortlens.streaming import score_stream
    model, rows = _closed_pipeline(spark, sf)
    arriving, sink = scratch_path(spark, "closed-arriving"), scratch_path(spark, "closed-scored")
    rows.repartition(4).write.parquet(arriving)
    stream = score_stream(spark, model, arriving, rows.schema, sink, scratch_path(spark, "closed-progress"), CLASSES,
                          "id", max_files_per_trigger=2)
    stream.awaitTermination()
    scored = spark.read.parquet(sink)
    path = scratch_path(spark, "closed-csv")
    score.export_scores(scored, path)
    return spark.read.option("header", True).schema(scored.schema).csv(path)


# ---------------------------------------------------------------- X01, X02
_VALUES = """al AS (SELECT y, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lf) AS p FROM lf GROUP BY y),
ys AS (SELECT range AS k, ['Dropout', 'Enrolled', 'Graduate'][range + 1] AS class FROM range(3)),
lp AS (SELECT leaf, k, class, avg(CASE WHEN y = k THEN 1.0 ELSE 0.0 END) AS p FROM lf, ys GROUP BY ALL),
ap AS (SELECT a, k, avg(CASE WHEN y = k THEN 1.0 ELSE 0.0 END) AS p FROM lf, ys GROUP BY ALL),
wa AS (SELECT avg(CAST(a AS DOUBLE)) AS w FROM lf),
vs AS (SELECT cell.a, cell.b, ys.class, al.p AS v0, ap.p AS va, (1 - w) * lb.p + w * l2.p AS vb, le.p AS vab
  FROM (SELECT DISTINCT a, b, leaf FROM lf) AS cell, ys, wa, al, ap, lp AS lb, lp AS l2, lp AS le
  WHERE al.y = ys.k AND ap.a = cell.a AND ap.k = ys.k AND lb.leaf = cell.b AND lb.k = ys.k
    AND l2.leaf = 2 AND l2.k = ys.k AND le.leaf = cell.leaf AND le.k = ys.k),
sv AS (SELECT id AS row_id, class, unnest(['a', 'b']) AS feature, unnest([CAST(a AS DOUBLE), CAST(b AS DOUBLE)]) AS value,
  unnest([((va - v0) + (vab - vb)) / 2, ((vb - v0) + (vab - va)) / 2]) AS phi FROM lf JOIN vs USING (a, b))"""


def _closed_attributions(spark, sf):
    df = flagged(spark, sf)
    model = models.decision_tree(max_depth=2).fit(df)
    return treeshap.attributions(model, df, "features", "id", ["a", "b"], CLASSES), model


@query("closed_attributions", _sql("SELECT row_id, class, feature, value, phi FROM sv", _VALUES), round_cols=["phi"],
       operators=["X01"])
def q_closed_attributions(spark, sf):
    """Path-dependent Shapley values of two players, from class shares."""
    return _closed_attributions(spark, sf)[0]


@query("closed_base_values", _sql("SELECT class, p AS base FROM al JOIN ys ON y = k", _VALUES), round_cols=["base"],
       operators=["X02"])
def q_closed_base_values(spark, sf):
    base = treeshap.base_values(_closed_attributions(spark, sf)[1], CLASSES)
    return spark.createDataFrame(list(base.items()), "class string, base double")


# ---------------------------------------------------------------- X03-X10 on a linear rule
#: fixed rule: feature -> (centre, weight of Dropout, Enrolled, Graduate)
LINEAR = {
    "p1_approved": (1.5, -0.5, 0.125, 0.375), "p2_approved": (0.5, -0.375, 0.0, 0.375),
    "p1_grade": (10.0, -0.0625, 0.03125, 0.03125), "p2_grade": (5.0, -0.03125, 0.0, 0.03125),
    "p1_enrolled": (2.0, 0.25, -0.125, -0.125), "p2_enrolled": (1.0, 0.125, 0.0625, -0.1875),
    "p1_credited": (0.5, 0.0, 0.25, -0.25), "age": (40.0, 0.0078125, -0.00390625, -0.00390625),
}
BASES = {"Dropout": 0.25, "Enrolled": 0.25, "Graduate": 0.5}


def linear_attributions(spark, sf):
    entries = [F.struct(F.lit(c).alias("class"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                        (F.lit(w[k]) * (F.col(f).cast("double") - F.lit(centre))).alias("phi"))
               for f, (centre, *w) in LINEAR.items() for k, c in enumerate(CLASSES)]
    return outcomes(spark, sf).select(F.col("id").alias("row_id"), F.inline(F.array(*entries)))


def _linear_sql() -> str:
    rows = [f"SELECT id AS row_id, '{c}' AS class, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, "
            f"CAST({w[k]} AS DOUBLE) * (CAST({f} AS DOUBLE) - {centre}) AS phi FROM outcomes"
            for f, (centre, *w) in LINEAR.items() for k, c in enumerate(CLASSES)]
    return f"att AS ({' UNION ALL '.join(rows)}),\nma AS (SELECT class, feature, avg(abs(phi)) AS mean_abs FROM att GROUP BY ALL)"


_LINEAR = _linear_sql()
_GLOBAL = """gl AS (SELECT feature, avg(mean_abs) AS mean_abs FROM ma GROUP BY feature)"""
_RANKED = """rk AS (SELECT class, feature, mean_abs, CAST(row_number() OVER (PARTITION BY class ORDER BY mean_abs DESC, feature) AS INT) AS rank FROM ma)"""
_EXAMPLES = f"""ex AS (SELECT outcome AS class, coalesce(min(CASE WHEN outcome = {_CLASS_CASE} THEN id END), min(id)) AS row_id FROM lf GROUP BY outcome),
ch AS (SELECT att.* FROM att JOIN ex USING (row_id, class))"""


def _linear_examples(spark, sf):
    leaf = F.when(F.expr(FLAGS["a"]) == 1, "Graduate").when(F.expr(FLAGS["b"]) == 1, "Enrolled").otherwise("Dropout")
    preds = outcomes(spark, sf).select(F.col("id").alias("row_id"), F.col("outcome").alias("label"), leaf.alias("prediction"))
    return explain.pick_examples(preds).select("row_id", "class")


@query("linear_mean_abs_by_class", _sql("SELECT * FROM ma", _LINEAR), round_cols=["mean_abs"], operators=["X03"])
def q_linear_mean_abs_by_class(spark, sf):
    return explain.mean_abs_by_class(linear_attributions(spark, sf))


@query("linear_global_top", _sql("SELECT * FROM gl ORDER BY mean_abs DESC, feature LIMIT 5", _LINEAR, _GLOBAL),
       round_cols=["mean_abs"], operators=["X04"])
def q_linear_global_top(spark, sf):
    return explain.mean_abs_global(linear_attributions(spark, sf), 5)


@query("linear_top_features", _sql("SELECT class, feature, mean_abs, rank FROM rk WHERE rank <= 5", _LINEAR, _RANKED),
       round_cols=["mean_abs"], operators=["X05"])
def q_linear_top_features(spark, sf):
    return explain.top_features(linear_attributions(spark, sf), 5)


@query("linear_decompose", _sql(
    f"""SELECT row_id, class, rank, feature, phi, CASE class {' '.join(f"WHEN '{c}' THEN {v}" for c, v in BASES.items())} END
  + sum(phi) OVER (PARTITION BY row_id, class ORDER BY rank) AS cumulative FROM (
  SELECT row_id, class, CAST(least(r, 6) AS INT) AS rank, CASE WHEN r <= 5 THEN feature ELSE '(other features)' END AS feature, sum(phi) AS phi
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id, class ORDER BY abs(phi) DESC, feature) AS r FROM ch) GROUP BY ALL)""",
    _LINEAR, _EXAMPLES), round_cols=["phi", "cumulative"], operators=["X06", "X07"])
def q_linear_decompose(spark, sf):
    return explain.decompose_examples(linear_attributions(spark, sf), _linear_examples(spark, sf), BASES, 5)


@query("linear_force", _sql(
    """SELECT row_id, class, CASE WHEN phi >= 0 THEN 'positive' ELSE 'negative' END AS direction, sum(phi) AS total,
  count(*) AS features FROM ch GROUP BY ALL""", _LINEAR, _EXAMPLES), round_cols=["total"], operators=["X06", "X08"])
def q_linear_force(spark, sf):
    return explain.force_split_examples(linear_attributions(spark, sf), _linear_examples(spark, sf))


@query("linear_dependence", _sql(
    "SELECT class, feature, row_id, value, phi FROM att JOIN (SELECT class, feature FROM rk WHERE rank <= 3) USING (class, feature)",
    _LINEAR, _RANKED), round_cols=["value", "phi"], operators=["X09"])
def q_linear_dependence(spark, sf):
    return explain.dependence(linear_attributions(spark, sf), 3)


@query("linear_distribution", _sql(
    "SELECT feature, row_id, class, value, phi FROM att JOIN (SELECT feature FROM gl ORDER BY mean_abs DESC, feature LIMIT 2) USING (feature)",
    _LINEAR, _GLOBAL), round_cols=["value", "phi"], operators=["X10"])
def q_linear_distribution(spark, sf):
    return explain.distribution(linear_attributions(spark, sf), 2)


@query("linear_distribution_summary", _sql(
    """SELECT class, feature, count(*) AS rows, min(phi) AS phi_min, quantile_disc(phi, 0.25) AS phi_q25, quantile_disc(phi, 0.5) AS phi_q50,
  quantile_disc(phi, 0.75) AS phi_q75, max(phi) AS phi_max FROM att
  JOIN (SELECT feature FROM gl ORDER BY mean_abs DESC, feature LIMIT 4) USING (feature) GROUP BY class, feature""", _LINEAR, _GLOBAL),
    round_cols=["phi_min", "phi_q25", "phi_q50", "phi_q75", "phi_max"], operators=["X10"])
def q_linear_distribution_summary(spark, sf):
    return explain.distribution_summary(linear_attributions(spark, sf), 4, accuracy=1_000_000)
