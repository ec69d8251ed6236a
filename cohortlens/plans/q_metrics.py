"""Queries for evaluation and ranking on rule predictions (E, M06, D06-D08).

Metrics are checked before any model exists: a fixed family of scoring
rules on the fixture gives (model, variant, row, label, prediction,
class probabilities) rows that SQL reproduces exactly. Rule scores are
floored to three decimals, so ROC ties occur and are exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions.columns import half_even_class, safe_name
from cohortlens.operators import balance, explain, metrics, quality, prep
from cohortlens.operators.features import engineer_features
from cohortlens.plans.oracle import with_outcomes
from cohortlens.plans.registry import query
from cohortlens.sources.tables import CLASSES, outcomes

# fixed rule family: (model, variant, approved weight, grade weight, offset)
RULES = [
    ("rule_full", "baseline", 6.0, 1.0, 4.0),
    ("rule_full", "FE", 6.0, 1.0, 4.5),
    ("rule_approved", "baseline", 6.0, 0.0, 14.0),
    ("rule_approved", "FE", 6.5, 0.0, 13.0),
    ("rule_grade", "baseline", 0.0, 2.0, 6.0),
    ("rule_grade", "FE", 0.0, 2.2, 5.0),
]
CUT_DROPOUT, CUT_ENROLLED = 23.0, 28.5
PROBA_BASE, PROBA_SPAN, PROBA_GRID = 18.0, 16.0, 1000
REG_BASE, REG_SCALE = 18.0, 5.5


def rule_predictions(spark, sf):
    """Long prediction table: one row per (rule, fixture row), from one scan."""
    fe = engineer_features(outcomes(spark, sf))
    entries = []
    for model, variant, a, g, off in RULES:
        s = F.lit(a) * F.col("total_approved") + F.lit(g) * F.col("avg_grade") + F.lit(off)
        entries.append(F.struct(F.lit(model).alias("model"), F.lit(variant).alias("variant"), s.alias("s")))
    long = fe.select(F.col("id").alias("row_id"), F.col("outcome").alias("label"), F.inline(F.array(*entries)))
    s = F.col("s")
    gcol = F.floor(F.least(F.greatest((s - PROBA_BASE) / PROBA_SPAN, F.lit(0.0)), F.lit(1.0)) * PROBA_GRID) \
        / PROBA_GRID
    pred = F.when(s < CUT_DROPOUT, "Dropout").when(s < CUT_ENROLLED, "Enrolled").otherwise("Graduate")
    return long.select(
        "model", "variant", "row_id", "label", pred.alias("prediction"),
        ((F.lit(1.0) - gcol) * (F.lit(1.0) - gcol)).alias("p_Dropout"),
        (F.lit(2.0) * gcol * (F.lit(1.0) - gcol)).alias("p_Enrolled"),
        (gcol * gcol).alias("p_Graduate"), "s")


def _rules_sql() -> str:
    parts = []
    for model, variant, a, g, off in RULES:
        parts.append(f"SELECT '{model}' AS model, '{variant}' AS variant, id AS row_id, outcome AS label, "
                     f"CAST({a} AS DOUBLE) * total_approved + CAST({g} AS DOUBLE) * avg_grade "
                     f"+ CAST({off} AS DOUBLE) AS s FROM fe")
    return "\nUNION ALL\n".join(parts)


RP_CTE = f"""rs AS ({_rules_sql()}),
rg AS (SELECT *, floor(least(greatest((s - {PROBA_BASE}) / {PROBA_SPAN}, 0.0), 1.0) * {PROBA_GRID}) / {PROBA_GRID} AS g FROM rs),
rp AS (SELECT model, variant, row_id, label,
  CASE WHEN s < {CUT_DROPOUT} THEN 'Dropout' WHEN s < {CUT_ENROLLED} THEN 'Enrolled' ELSE 'Graduate' END AS prediction,
  (1.0 - g) * (1.0 - g) AS p_Dropout, 2.0 * g * (1.0 - g) AS p_Enrolled, g * g AS p_Graduate, s FROM rg)"""

PC_CTE = """cc AS (SELECT model, variant, label, prediction, count(*) AS n FROM rp GROUP BY ALL),
pt AS (SELECT model, variant, label AS class, CAST(sum(n) AS BIGINT) AS support,
         CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS tp FROM cc GROUP BY ALL),
pp AS (SELECT model, variant, prediction AS class, CAST(sum(n) AS BIGINT) AS predicted FROM cc GROUP BY ALL),
pj AS (SELECT coalesce(pt.model, pp.model) AS model, coalesce(pt.variant, pp.variant) AS variant,
         coalesce(pt.class, pp.class) AS class, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
         coalesce(predicted, 0) AS predicted
       FROM pt FULL JOIN pp ON pt.model = pp.model AND pt.variant = pp.variant AND pt.class = pp.class),
pq AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pj),
pc AS (SELECT model, variant, class, precision, recall,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
         support FROM pq)"""


def with_rules(body: str, per_class: bool = False) -> str:
    ctes = RP_CTE + (",\n" + PC_CTE if per_class else "")
    text = body.lstrip()
    if text[:5].upper() == "WITH ":
        return with_outcomes(f"WITH {ctes},\n{text[5:]}", features=True)
    return with_outcomes(f"WITH {ctes}\n{body}", features=True)


KEYS = ["model", "variant"]


@query("rule_accuracy", with_rules(
    "SELECT model, variant, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM rp GROUP BY ALL"),
    round_cols=["accuracy"], operators=["E01"])
def q_rule_accuracy(spark, sf):
    return metrics.accuracy(rule_predictions(spark, sf), KEYS)


@query("rule_weighted_f1", with_rules(
    "SELECT model, variant, sum(f1 * support) / sum(support) AS weighted_f1 FROM pc GROUP BY ALL", per_class=True),
    round_cols=["weighted_f1"], operators=["E02"])
def q_rule_weighted_f1(spark, sf):
    return metrics.weighted_f1(rule_predictions(spark, sf), KEYS)


@query("rule_per_class_f1", with_rules("SELECT * FROM pc", per_class=True),
       round_cols=["precision", "recall", "f1"], operators=["E03"])
def q_rule_per_class_f1(spark, sf):
    return metrics.per_class(rule_predictions(spark, sf), KEYS)


@query("rule_classification_report", with_rules("""
SELECT * FROM pc
UNION ALL SELECT model, variant, 'accuracy', NULL, NULL, sum(recall * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pc GROUP BY ALL
UNION ALL SELECT model, variant, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pc GROUP BY ALL
UNION ALL SELECT model, variant, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pc GROUP BY ALL""", per_class=True),
    round_cols=["precision", "recall", "f1"], operators=["E04"])
def q_rule_classification_report(spark, sf):
    return metrics.classification_report(rule_predictions(spark, sf), KEYS)


@query("rule_confusion_matrix", with_rules(
    "SELECT model, variant, label, " + ", ".join(
        f"CAST(count_if(prediction = '{c}') AS BIGINT) AS {c}" for c in CLASSES)
    + " FROM rp GROUP BY ALL"), operators=["E05"])
def q_rule_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(rule_predictions(spark, sf), CLASSES, KEYS)


_REG_VALUE = f"(s - {REG_BASE}) / {REG_SCALE}"


def _reg_frame(spark, sf):
    rp = rule_predictions(spark, sf).where((F.col("model") == "rule_full") & (F.col("variant") == "baseline"))
    code = F.when(F.col("label") == "Dropout", 0.0).when(F.col("label") == "Enrolled", 1.0).otherwise(2.0)
    return rp.select(F.lit("rule_reg").alias("model"), "row_id", "label", code.alias("code"),
                     ((F.col("s") - REG_BASE) / REG_SCALE).alias("value"))


_REG_SQL = (f"SELECT 'rule_reg' AS model, row_id, label, CASE label WHEN 'Dropout' THEN 0.0 WHEN 'Enrolled' THEN 1.0 "
            f"ELSE 2.0 END AS code, {_REG_VALUE} AS value FROM rp WHERE model = 'rule_full' AND variant = 'baseline'")


@query("rule_regression_mse", with_rules(
    f"SELECT model, avg((value - code) * (value - code)) AS mse FROM ({_REG_SQL}) GROUP BY model"),
    round_cols=["mse"], operators=["E06"])
def q_rule_regression_mse(spark, sf):
    return metrics.mse(_reg_frame(spark, sf), "code", "value")


@query("rule_regression_classes", with_rules(
    f"SELECT row_id, CAST(greatest(0, least(2, round_even(value, 0))) AS INT) AS class_code FROM ({_REG_SQL})"),
    operators=["M06"])
def q_rule_regression_classes(spark, sf):
    return _reg_frame(spark, sf).select("row_id", half_even_class("value", 0, 2).alias("class_code"))


def _binarized(spark, sf):
    rp = rule_predictions(spark, sf)
    return metrics.binarize(rp, CLASSES, "label", ["row_id"], KEYS,
                            score_cols={c: f"p_{c}" for c in CLASSES})


_BIN_SQL = "\nUNION ALL\n".join(
    f"SELECT model, variant, row_id, '{c}' AS class, CAST(label = '{c}' AS INT) AS y, p_{c} AS score FROM rp"
    for c in CLASSES)


@query("rule_binarized", with_rules(_BIN_SQL), round_cols=["score"], operators=["E07"])
def q_rule_binarized(spark, sf):
    return _binarized(spark, sf)


_ROC_SQL = f"""b AS ({_BIN_SQL}),
a AS (SELECT model, variant, class, score AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
        row_number() OVER (PARTITION BY model, variant, class ORDER BY threshold DESC) AS idx
      FROM a WINDOW w AS (PARTITION BY model, variant, class ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, lag(tps) OVER o AS ltps, lead(tps) OVER o AS ntps, lag(fps) OVER o AS lfps, lead(fps) OVER o AS nfps
      FROM c WINDOW o AS (PARTITION BY model, variant, class ORDER BY threshold DESC)),
k AS (SELECT model, variant, class, threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps, idx FROM d
      WHERE ltps IS NULL OR ntps IS NULL OR nfps - 2 * fps + lfps <> 0 OR ntps - 2 * tps + ltps <> 0
      UNION ALL
      SELECT model, variant, class, NULL, 0, 0, 0 FROM c WHERE idx = 1),
roc AS (SELECT model, variant, class, threshold,
          CASE WHEN max(fps) OVER p = 0 THEN NULL ELSE fps / max(fps) OVER p END AS fpr,
          CASE WHEN max(tps) OVER p = 0 THEN NULL ELSE tps / max(tps) OVER p END AS tpr,
          CAST(row_number() OVER (PARTITION BY model, variant, class ORDER BY idx) - 1 AS INTEGER) AS point
        FROM k WINDOW p AS (PARTITION BY model, variant, class))"""


@query("rule_roc_curve", with_rules(f"WITH {_ROC_SQL}\nSELECT * FROM roc"),
       round_cols=["threshold", "fpr", "tpr"], operators=["E08"])
def q_rule_roc_curve(spark, sf):
    return metrics.roc_curve(_binarized(spark, sf), KEYS)


@query("rule_auc", with_rules(f"""WITH {_ROC_SQL}
SELECT model, variant, class, sum(area) AS auc FROM (
  SELECT model, variant, class,
    (fpr - lag(fpr) OVER o) * (tpr + lag(tpr) OVER o) / 2 AS area
  FROM roc WINDOW o AS (PARTITION BY model, variant, class ORDER BY point)) GROUP BY ALL"""),
    round_cols=["auc"], operators=["E09"])
def q_rule_auc(spark, sf):
    return metrics.auc_from_scores(_binarized(spark, sf), KEYS)


def _results_sql(where: str = "", keys: str = "model, variant") -> str:
    return f"""acc AS (SELECT {keys}, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS test_accuracy FROM rp {where} GROUP BY ALL),
wf AS (SELECT {keys}, sum(f1 * support) / sum(support) AS test_f1 FROM pc {where} GROUP BY ALL),
res AS (SELECT {', '.join('acc.' + k.strip() for k in keys.split(','))}, CAST(NULL AS DOUBLE) AS cv_f1, test_accuracy, test_f1
        FROM acc JOIN wf USING ({keys}))"""


@query("results_baseline", with_rules(
    "WITH " + _results_sql("WHERE variant = 'baseline'") + "\nSELECT model, cv_f1, test_accuracy, test_f1 FROM res",
    per_class=True), round_cols=["test_accuracy", "test_f1"], operators=["E10"])
def q_results_baseline(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline")
    return metrics.results_table(rp, ["model"])


@query("results_by_variant", with_rules("WITH " + _results_sql() + "\nSELECT * FROM res", per_class=True),
       round_cols=["test_accuracy", "test_f1"], operators=["E11", "E12"])
def q_results_by_variant(spark, sf):
    return metrics.results_table(rule_predictions(spark, sf), KEYS)


@query("results_union", with_rules(
    "WITH " + _results_sql() + "\nSELECT model || CASE WHEN variant = 'FE' THEN ' (FE)' ELSE '' END AS model, "
    "test_accuracy, test_f1 FROM res", per_class=True),
    round_cols=["test_accuracy", "test_f1"], operators=["E13"])
def q_results_union(spark, sf):
    rp = rule_predictions(spark, sf)
    base = metrics.results_table(rp.where(F.col("variant") == "baseline"), ["model"])
    fe = metrics.results_table(rp.where(F.col("variant") == "FE"), ["model"]) \
        .withColumn("model", F.concat("model", F.lit(" (FE)")))
    return metrics.union_results(base, fe, columns=["model", "test_accuracy", "test_f1"])


@query("results_ranked", with_rules(
    "WITH " + _results_sql("WHERE variant = 'baseline'") +
    "\nSELECT model, cv_f1, test_accuracy, test_f1, CAST(row_number() OVER (ORDER BY test_f1 DESC NULLS LAST, model) AS INTEGER) AS rank FROM res",
    per_class=True), round_cols=["test_accuracy", "test_f1"], operators=["E14"])
def q_results_ranked(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline")
    return metrics.rank_models(metrics.results_table(rp, ["model"]), "test_f1")


def _cv_f1(rp):
    """Mean weighted F1 over 5 stratified folds, per model."""
    folds = prep.fold_column(rp.select("row_id", "label").distinct(), "label", "row_id", 5)
    withf = rp.join(folds.select("row_id", "fold"), "row_id")
    per_fold = metrics.weighted_f1(withf, ["model", "fold"])
    return per_fold.groupBy("model").agg(F.avg("weighted_f1").alias("cv_f1"))


_FOLD_SQL = """fo AS (SELECT id AS row_id, CAST((row_number() OVER (PARTITION BY outcome ORDER BY md5(CAST(id AS VARCHAR) || '|43'), id) - 1) % 5 AS INT) AS fold FROM outcomes),
fcc AS (SELECT model, fold, label, prediction, count(*) AS n FROM rp JOIN fo USING (row_id) WHERE variant = 'baseline' GROUP BY ALL),
fpt AS (SELECT model, fold, label AS class, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM fcc GROUP BY ALL),
fpp AS (SELECT model, fold, prediction AS class, sum(n) AS predicted FROM fcc GROUP BY ALL),
fpj AS (SELECT coalesce(fpt.model, fpp.model) AS model, coalesce(fpt.fold, fpp.fold) AS fold, coalesce(support, 0) AS support,
          coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
        FROM fpt FULL JOIN fpp ON fpt.model = fpp.model AND fpt.fold = fpp.fold AND fpt.class = fpp.class),
fpq AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM fpj),
fwf AS (SELECT model, fold, sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / sum(support) AS f FROM fpq GROUP BY ALL),
cv AS (SELECT model, avg(f) AS cv_f1 FROM fwf GROUP BY model)"""


@query("results_with_cv", with_rules(
    "WITH " + _FOLD_SQL + ",\n" + _results_sql("WHERE variant = 'baseline'") + """,
reg AS (SELECT row_id, label, CASE CAST(greatest(0, least(2, round_even(value, 0))) AS INT)
          WHEN 0 THEN 'Dropout' WHEN 1 THEN 'Enrolled' ELSE 'Graduate' END AS prediction FROM (""" + _REG_SQL + """)),
regc AS (SELECT label AS class, count(*) AS support, count_if(label = prediction) AS tp FROM reg GROUP BY label),
regp AS (SELECT prediction AS class, count(*) AS predicted FROM reg GROUP BY prediction),
regq AS (SELECT coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
         FROM regc FULL JOIN regp ON regc.class = regp.class),
regf AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM regq)
SELECT res.model, cv.cv_f1, test_accuracy, test_f1 FROM res LEFT JOIN cv ON cv.model = res.model
UNION ALL
SELECT 'rule_reg', NULL, (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM reg),
  sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / sum(support) FROM regf""",
    per_class=True), round_cols=["cv_f1", "test_accuracy", "test_f1"], operators=["E16", "M13"])
def q_results_with_cv(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline")
    cls = rp.select("model", "row_id", "label", "prediction")
    reg = _reg_frame(spark, sf).select(
        "model", "row_id", "label",
        F.element_at(F.array(*[F.lit(c) for c in CLASSES]), half_even_class("value") + 1).alias("prediction"))
    table = metrics.results_table(cls.unionByName(reg), ["model"], cv=_cv_f1(cls))
    return table


@query("best_rule_model", with_rules(
    "WITH " + _results_sql("WHERE variant = 'baseline'") +
    "\nSELECT model, cv_f1, test_accuracy, test_f1 FROM res ORDER BY test_f1 DESC, model LIMIT 1",
    per_class=True), round_cols=["test_accuracy", "test_f1"], operators=["E15"])
def q_best_rule_model(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline")
    return metrics.best_model(metrics.results_table(rp, ["model"]), "test_f1")


@query("quality_prediction_domain", with_rules(
    "SELECT 'predictions_outside_labels' AS \"check\", CAST(count_if(prediction NOT IN ('Dropout', 'Enrolled', 'Graduate') "
    "OR prediction IS NULL) AS DOUBLE) AS value, count_if(prediction NOT IN ('Dropout', 'Enrolled', 'Graduate') "
    "OR prediction IS NULL) = 0 AS passed FROM rp"), operators=["D06"])
def q_quality_prediction_domain(spark, sf):
    return quality.check_prediction_domain(rule_predictions(spark, sf), "prediction", CLASSES)


@query("quality_proba", with_rules("""
SELECT 'proba_out_of_range' AS "check", CAST(count_if(p_Dropout < 0 OR p_Dropout > 1 OR p_Enrolled < 0 OR p_Enrolled > 1
  OR p_Graduate < 0 OR p_Graduate > 1) AS DOUBLE) AS value, count_if(p_Dropout < 0 OR p_Dropout > 1 OR p_Enrolled < 0
  OR p_Enrolled > 1 OR p_Graduate < 0 OR p_Graduate > 1) = 0 AS passed FROM rp
UNION ALL
SELECT 'proba_sum_not_one', CAST(count_if(abs(0.0 + p_Dropout + p_Enrolled + p_Graduate - 1.0) > 1e-6) AS DOUBLE),
  count_if(abs(0.0 + p_Dropout + p_Enrolled + p_Graduate - 1.0) > 1e-6) = 0 FROM rp"""), operators=["D07"])
def q_quality_proba(spark, sf):
    return quality.check_proba(rule_predictions(spark, sf), [f"p_{c}" for c in CLASSES])


@query("quality_results", with_rules(
    "WITH " + _results_sql("WHERE variant = 'baseline'") + """
SELECT 'rows' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM res
UNION ALL SELECT 'min_accuracy', min(test_accuracy), min(test_accuracy) >= 0 AND min(test_accuracy) > 0.6 FROM res
UNION ALL SELECT 'max_accuracy', max(test_accuracy), max(test_accuracy) <= 1 FROM res""", per_class=True),
    round_cols=["value"], operators=["D08"])
def q_quality_results(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline")
    res = metrics.results_table(rp, ["model"]).withColumnsRenamed(
        {"model": "Model", "test_accuracy": "Test Accuracy", "test_f1": "Test F1"})
    return quality.check_results(res)


# ------------------------------------------------------------------- balancing weights


@query("class_weights", with_outcomes(
    "SELECT outcome, count(*) AS count, (SELECT count(*) FROM outcomes) / "
    "((SELECT count(DISTINCT outcome) FROM outcomes) * count(*)) AS weight FROM outcomes GROUP BY outcome"),
    round_cols=["weight"], operators=["B02"])
def q_class_weights(spark, sf):
    return balance.class_weights(outcomes(spark, sf), "outcome")


@query("row_weights", with_outcomes(
    "SELECT id, outcome, (SELECT count(*) FROM outcomes) / ((SELECT count(DISTINCT outcome) FROM outcomes) "
    "* count(*) OVER (PARTITION BY outcome)) AS weight FROM outcomes"), round_cols=["weight"], operators=["B03"])
def q_row_weights(spark, sf):
    return balance.with_weights(outcomes(spark, sf), "outcome").select("id", "outcome", "weight")


# ------------------------------------------------------------------- examples, caps, names
@query("example_rows", with_rules(
    "SELECT label AS class, coalesce(min(CASE WHEN label = prediction THEN row_id END), min(row_id)) AS row_id "
    "FROM rp WHERE model = 'rule_full' AND variant = 'baseline' GROUP BY label"), operators=["X06"])
def q_example_rows(spark, sf):
    rp = rule_predictions(spark, sf).where((F.col("model") == "rule_full") & (F.col("variant") == "baseline"))
    return explain.pick_examples(rp)


@query("capped_test_rows", with_outcomes(
    "SELECT id, outcome FROM (" + __import__("cohortlens.plans.q_prep", fromlist=["SPLIT_SQL"]).SPLIT_SQL
    + ") WHERE split = 'test' ORDER BY id LIMIT 500"), operators=["X11"])
def q_capped_test_rows(spark, sf):
    from cohortlens.plans.q_prep import split_outcomes
    test = split_outcomes(spark, sf).where(F.col("split") == "test")
    return explain.cap_rows(test, 500, "id").select("id", "outcome")


@query("safe_part_names",
       "SELECT p_partkey, lower(substring(translate(p_name, '/ ', '__'), 1, 30)) AS safe_name FROM part",
       operators=["X12"])
def q_safe_part_names(spark, sf):
    from cohortlens.sources.tables import load_table
    return load_table(spark, sf, "part").select("p_partkey", safe_name("p_name").alias("safe_name"))
