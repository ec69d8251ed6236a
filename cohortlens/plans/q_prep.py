"""Queries for preprocessing, selection and data-quality checks (T, L, D, A12)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import eda, prep, quality, select
from cohortlens.operators.features import ENGINEERED, engineer_features
from cohortlens.plans.oracle import with_outcomes
from cohortlens.plans.q_profile import with_raw, DOUBLE_OUTCOME
from cohortlens.plans.registry import query
from cohortlens.sources.tables import CLASSES, FIXTURE_NUMERIC, outcomes, outcomes_raw

SPLIT_SQL = """
SELECT o.*, CASE WHEN row_number() OVER (PARTITION BY outcome ORDER BY md5(CAST(id AS VARCHAR) || '|42'), id)
                      <= round(count(*) OVER (PARTITION BY outcome) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM outcomes o
"""


def with_split(body: str, features: bool = False) -> str:
    text = body.lstrip()
    if text[:5].upper() == "WITH ":
        return with_outcomes(f"WITH sp AS ({SPLIT_SQL}),\n{text[5:]}", features=features)
    return with_outcomes(f"WITH sp AS ({SPLIT_SQL})\n{body}", features=features)


def split_outcomes(spark, sf):
    return prep.stratified_split(outcomes(spark, sf), "outcome", "id")


# ------------------------------------------------------------------- T01, T02
@query("features_target", with_outcomes("SELECT * EXCLUDE (outcome) FROM outcomes"),
       round_cols=DOUBLE_OUTCOME, operators=["T01"])
def q_features_target(spark, sf):
    x, _ = prep.features_target(outcomes(spark, sf), "outcome", keep=["id"])
    return x


@query("stratified_split", with_split("SELECT id, outcome, split FROM sp"), operators=["T02"])
def q_stratified_split(spark, sf):
    return split_outcomes(spark, sf).select("id", "outcome", "split")


@query("stratified_folds", with_outcomes(
    "SELECT id, outcome, CAST((row_number() OVER (PARTITION BY outcome ORDER BY md5(CAST(id AS VARCHAR) || '|43'), id)"
    " - 1) % 5 AS INTEGER) AS fold FROM outcomes"), operators=["M12", "M13"])
def q_stratified_folds(spark, sf):
    return prep.fold_column(outcomes(spark, sf), "outcome", "id", folds=5).select("id", "outcome", "fold")


@query("split_class_counts", with_split(
    "SELECT split AS stage, outcome AS value, count(*) AS count FROM sp GROUP BY ALL"),
    operators=["P20", "B04"])
def q_split_class_counts(spark, sf):
    train, test = prep.split_frames(split_outcomes(spark, sf))
    return eda.compare_counts({"train": train, "test": test}, "outcome")


# ------------------------------------------------------------------- imputation
IMPUTE_MEAN_COLS = ["p1_enrolled", "p2_approved", "q1", "q2"]


@query("impute_mean_raw", with_raw(
    "SELECT id, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), avg(CAST({c} AS DOUBLE)) OVER ()) AS {c}__imp"
        for c in IMPUTE_MEAN_COLS) + " FROM raw"),
    round_cols=[f"{c}__imp" for c in IMPUTE_MEAN_COLS], operators=["T03"])
def q_impute_mean_raw(spark, sf):
    model = Pipeline(stages=prep.mean_imputer(IMPUTE_MEAN_COLS)).fit(outcomes_raw(spark, sf))
    out = model.transform(outcomes_raw(spark, sf))
    return out.select("id", *[f"{c}__imp" for c in IMPUTE_MEAN_COLS])


IMPUTE_MODE_COLS = ["priority", "p1_enrolled", "p2_approved", "p1_credited"]


@query("impute_mode_raw", with_raw(
    "SELECT id, " + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)) AS {c}__mode" for c in IMPUTE_MODE_COLS)
    + " FROM raw"), operators=["T05"])
def q_impute_mode_raw(spark, sf):
    df = outcomes_raw(spark, sf)
    model = prep.ModeImputer(inputCols=IMPUTE_MODE_COLS,
                             outputCols=[f"{c}__mode" for c in IMPUTE_MODE_COLS]).fit(df)
    return model.transform(df).select("id", *[f"{c}__mode" for c in IMPUTE_MODE_COLS])


# ------------------------------------------------------------------- scaling fitted on train
SCALE_COLS = ["age", "admission", "balance", "p1_grade", "p2_grade", "p1_approved"]


@query("scale_test_population", with_split(
    "SELECT id, " + ", ".join(
        f"(CAST(t.{c} AS DOUBLE) - m.m_{c}) / CASE WHEN m.s_{c} > 0 THEN m.s_{c} ELSE 1.0 END AS {c}__scl"
        for c in SCALE_COLS)
    + " FROM (SELECT * FROM sp WHERE split = 'test') t, (SELECT "
    + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in SCALE_COLS)
    + " FROM sp WHERE split = 'train') m"),
    round_cols=[f"{c}__scl" for c in SCALE_COLS], operators=["T04", "T08"])
def q_scale_test_population(spark, sf):
    train, test = prep.split_frames(split_outcomes(spark, sf))
    scaler = prep.PopulationScaler(inputCols=SCALE_COLS, outputCols=[f"{c}__scl" for c in SCALE_COLS])
    _, _, test_t = prep.fit_apply(Pipeline(stages=[scaler]), train, test)
    return test_t.select("id", *[f"{c}__scl" for c in SCALE_COLS])


# ------------------------------------------------------------------- one-hot
OHE_COLS = ["priority", "segment", "nation"]


def _ohe_sql() -> str:
    ctes = ", ".join(
        f"v_{c} AS (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM sp WHERE split = 'train' AND {c} IS NOT NULL), "
        f"r_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS slot FROM v_{c})"
        for c in OHE_COLS)
    cols = ", ".join(f"coalesce(r_{c}.slot, -1) AS {c}__slot" for c in OHE_COLS)
    joins = " ".join(f"LEFT JOIN r_{c} ON r_{c}.v = CAST(t.{c} AS VARCHAR)" for c in OHE_COLS)
    return with_split(f"WITH {ctes}\nSELECT t.id, {cols} FROM (SELECT * FROM sp WHERE split = 'test') t {joins}")


@query("one_hot_test_slots", _ohe_sql(), operators=["T06"])
def q_one_hot_test_slots(spark, sf):
    train, test = prep.split_frames(split_outcomes(spark, sf))
    model = Pipeline(stages=prep.one_hot_stages(OHE_COLS)).fit(train)
    out = model.transform(test)
    return out.select("id", *[
        (F.array_position(vector_to_array(F.col(f"{c}__ohe")), 1.0) - 1).cast("int").alias(f"{c}__slot")
        for c in OHE_COLS])


# ------------------------------------------------------------------- label encoding
@query("label_encoding", with_outcomes(
    "SELECT id, outcome, CAST(dense_rank() OVER (ORDER BY outcome) - 1 AS DOUBLE) AS label FROM outcomes"),
    operators=["T09"])
def q_label_encoding(spark, sf):
    df, _ = prep.encode_label(outcomes(spark, sf), "outcome", "label")
    return df.select("id", "outcome", "label")


# ------------------------------------------------------------------- selection
ANOVA_FEATURES = FIXTURE_NUMERIC + ENGINEERED


def _anova_sql() -> str:
    per = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, var_pop(CAST({c} AS DOUBLE)) AS v{i}"
                    for i, c in enumerate(ANOVA_FEATURES))
    parts = []
    for i, c in enumerate(ANOVA_FEATURES):
        parts.append(
            f"SELECT {i} AS position, '{c}' AS feature, "
            f"CASE WHEN sum(n * v{i}) = 0 THEN NULL ELSE "
            f"(greatest(sum(n * m{i} * m{i}) - sum(n * m{i}) * sum(n * m{i}) / sum(n), 0.0) / (count(*) - 1)) "
            f"/ (sum(n * v{i}) / (sum(n) - count(*))) END AS f_score FROM pc")
    return with_outcomes(f"WITH pc AS (SELECT outcome, count(*) AS n, {per} FROM fe GROUP BY outcome)\n"
                         + "\nUNION ALL\n".join(parts), features=True)


ANOVA_SQL = _anova_sql()


def _anova_spark(spark, sf):
    return select.anova_f(engineer_features(outcomes(spark, sf)), ANOVA_FEATURES, "outcome")


@query("anova_f_scores", ANOVA_SQL, round_cols=["f_score"], operators=["L01"])
def q_anova_f_scores(spark, sf):
    return _anova_spark(spark, sf)


@query("select_k_best", f"""
WITH s AS ({ANOVA_SQL})
SELECT * FROM (SELECT s.*, CAST(row_number() OVER (ORDER BY f_score DESC NULLS LAST, position) AS INTEGER) AS rank FROM s)
WHERE rank <= 10""", round_cols=["f_score"], operators=["L02", "L05"])
def q_select_k_best(spark, sf):
    return select.select_k_best(_anova_spark(spark, sf), 10)


# ------------------------------------------------------------------- quality checks
QUALITY_COLS = FIXTURE_NUMERIC + ["priority", "status", "segment", "nation"]


@query("quality_no_null", with_outcomes(
    "SELECT 'rows_with_missing' AS \"check\", CAST(count_if(" + " OR ".join(
        f"{c} IS NULL" + (f" OR isnan({c})" if c in ("admission", "balance", "p1_grade", "p2_grade") else "")
        for c in QUALITY_COLS) + ") AS DOUBLE) AS value, count_if(" + " OR ".join(
        f"{c} IS NULL" for c in QUALITY_COLS) + ") = 0 AS passed FROM outcomes"), operators=["D01"])
def q_quality_no_null(spark, sf):
    return quality.check_no_null(outcomes(spark, sf), QUALITY_COLS)


@query("quality_split", with_split("""
SELECT 'train_rows' AS "check", CAST(count_if(split = 'train') AS DOUBLE) AS value, count_if(split = 'train') > 0 AS passed FROM sp
UNION ALL SELECT 'test_rows', CAST(count_if(split = 'test') AS DOUBLE), count_if(split = 'test') > 0 FROM sp
UNION ALL SELECT 'train_share', count_if(split = 'train') / count(*), count_if(split = 'train') / count(*) > 0.75
  AND count_if(split = 'train') / count(*) < 0.85 FROM sp"""), round_cols=["value"], operators=["D02"])
def q_quality_split(spark, sf):
    train, test = prep.split_frames(split_outcomes(spark, sf))
    return quality.check_split(train, test)


@query("quality_class_share", with_outcomes("\nUNION ALL\n".join(
    f"SELECT 'share_{c}' AS \"check\", count_if(outcome = '{c}') / count(*) AS value, "
    f"count_if(outcome = '{c}') / count(*) > 0.1 AS passed FROM outcomes" for c in CLASSES)),
    round_cols=["value"], operators=["D04"])
def q_quality_class_share(spark, sf):
    return quality.check_class_share(outcomes(spark, sf), "outcome", CLASSES)


@query("quality_classes", with_outcomes(
    "SELECT 'classes_match' AS \"check\", CAST(count(DISTINCT outcome) AS DOUBLE) AS value, "
    "list_sort(list_distinct(list(outcome))) = ['Dropout', 'Enrolled', 'Graduate'] AS passed FROM outcomes"),
    operators=["D05"])
def q_quality_classes(spark, sf):
    return quality.check_classes(outcomes(spark, sf), "outcome", CLASSES)


# The fixture's field domains (fixed values)
DOMAIN_RULES = [
    quality.Rule("age", 17, 70),
    quality.Rule("p1_grade", 0, 20),
    quality.Rule("p2_grade", 0, 20),
    quality.Rule("nation", 0, 24),
    quality.Rule("priority", allowed=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
    quality.Rule("status", allowed=["F", "O", "P"]),
    quality.Rule("p1_enrolled", 0, 3),
    quality.Rule("balance", -1000, 10000),
]


def _domain_sql() -> str:
    parts = []
    for r in DOMAIN_RULES:
        conds = []
        if r.min is not None:
            conds.append(f"{r.column} < {r.min}")
        if r.max is not None:
            conds.append(f"{r.column} > {r.max}")
        if r.allowed is not None:
            conds.append(f"{r.column} NOT IN (" + ", ".join(f"'{v}'" for v in r.allowed) + ")")
        cond = f"{r.column} IS NOT NULL AND (" + " OR ".join(conds) + ")"
        parts.append(f"SELECT '{r.column}' AS \"column\", CAST(count_if({cond}) AS BIGINT) AS violations, "
                     f"count_if({cond}) = 0 AS passed FROM outcomes")
    return with_outcomes("\nUNION ALL\n".join(parts))


@query("quality_domains", _domain_sql(), operators=["A12"])
def q_quality_domains(spark, sf):
    return quality.check_domains(outcomes(spark, sf), DOMAIN_RULES)
