"""Queries for features, profiling and EDA aggregates (F, P, A12 rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import eda, features, profile
from cohortlens.plans.oracle import with_outcomes
from cohortlens.plans.registry import query
from cohortlens.sources.tables import CLASSES, outcomes, outcomes_raw

OUTCOME_COLUMNS = [
    "id", "priority", "status", "segment", "nation", "age", "admission", "balance",
    "p1_enrolled", "p2_enrolled", "p1_approved", "p2_approved", "p1_credited", "p2_credited",
    "p1_evaluations", "p2_evaluations", "p1_without_eval", "p2_without_eval", "p1_grade",
    "p2_grade", "score", "outcome",
]
RAW_COLUMNS = ["id", "priority", "status", "admission", "p1_enrolled", "p2_enrolled",
               "p1_approved", "p2_approved", "p1_credited", "p2_credited", "p1_evaluations",
               "p2_evaluations", "p1_without_eval", "p2_without_eval", "q1", "q2"]
DOUBLE_OUTCOME = ["admission", "balance", "p1_grade", "p2_grade", "score"]
# numeric inputs for correlations: every numeric column except the row id and the label leak
CORR_COLUMNS = [
    "nation", "age", "admission", "balance", "p1_enrolled", "p2_enrolled", "p1_approved",
    "p2_approved", "p1_credited", "p2_credited", "p1_evaluations", "p2_evaluations",
    "p1_without_eval", "p2_without_eval", "p1_grade", "p2_grade",
]
# the 13 key columns of the heat map
KEY_COLUMNS = [
    "age", "admission", "balance", "p1_approved", "p1_grade", "p2_approved", "p2_grade",
    "p1_enrolled", "p2_enrolled", "p1_credited", "p2_credited", "p1_evaluations", "nation",
]
BOX_COLUMNS = ["p1_grade", "p2_grade", "p1_approved", "p2_approved"]

RAW_SQL = """
WITH li AS (
  SELECT l_orderkey AS k,
    CAST(SUM(CASE WHEN l_linenumber <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS p1_enrolled,
    CAST(SUM(CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END) AS BIGINT) AS p2_enrolled,
    CAST(SUM(CASE WHEN l_linenumber <= 3 AND l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS p1_approved,
    CAST(SUM(CASE WHEN l_linenumber > 3 AND l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS p2_approved,
    CAST(SUM(CASE WHEN l_linenumber <= 3 AND l_discount >= 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS p1_credited,
    CAST(SUM(CASE WHEN l_linenumber > 3 AND l_discount >= 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS p2_credited,
    CAST(SUM(CASE WHEN l_linenumber <= 3 AND l_tax > 0.01 THEN 1 ELSE 0 END) AS BIGINT) AS p1_evaluations,
    CAST(SUM(CASE WHEN l_linenumber > 3 AND l_tax > 0.01 THEN 1 ELSE 0 END) AS BIGINT) AS p2_evaluations,
    CAST(SUM(CASE WHEN l_linenumber <= 3 AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS p1_without_eval,
    CAST(SUM(CASE WHEN l_linenumber > 3 AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS p2_without_eval,
    SUM(CASE WHEN l_linenumber <= 3 THEN l_quantity ELSE 0.0 END) AS q1,
    SUM(CASE WHEN l_linenumber > 3 THEN l_quantity ELSE 0.0 END) AS q2
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS id, o_orderpriority AS priority, o_orderstatus AS status,
  o_totalprice AS admission, li.* EXCLUDE (k)
FROM orders LEFT JOIN li ON k = o_orderkey
"""


def with_raw(body: str) -> str:
    return f"WITH raw AS ({RAW_SQL})\n{body}"


def _typeof(c: str) -> str:
    return (f"CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
            f"WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof(any_value({c}))) END")


def _fe(spark, sf):
    return features.engineer_features(outcomes(spark, sf))


# ---------------------------------------------------------------- features
ENG_DOUBLE = ["approval_rate", "avg_grade", "grade_improvement"]


@query("engineered_features", with_outcomes(
    "SELECT id, total_approved, total_enrolled, approval_rate, avg_grade, grade_improvement, "
    "approval_improvement, total_credited, total_without_eval, age_group FROM fe", features=True),
    round_cols=ENG_DOUBLE, operators=["F01", "F02", "F03", "F04", "F05", "F06", "F07", "F08", "F09"])
def q_engineered_features(spark, sf):
    return _fe(spark, sf).select("id", *features.ENGINEERED)


@query("outcome_share_by_age_group", with_outcomes(
    "SELECT age_group, "
    "100.0 * count_if(outcome = 'Dropout') / count(*) AS Dropout, "
    "100.0 * count_if(outcome = 'Enrolled') / count(*) AS Enrolled, "
    "100.0 * count_if(outcome = 'Graduate') / count(*) AS Graduate "
    "FROM fe GROUP BY age_group", features=True),
    round_cols=CLASSES, operators=["F09", "P14"])
def q_outcome_share_by_age_group(spark, sf):
    return eda.crosstab(_fe(spark, sf), "age_group", "outcome", normalize="index", values=CLASSES)


# ---------------------------------------------------------------- profile
@query("head_rows", with_outcomes("SELECT * FROM outcomes ORDER BY id LIMIT 5"),
       round_cols=DOUBLE_OUTCOME, operators=["P01"])
def q_head_rows(spark, sf):
    return profile.head(outcomes(spark, sf), 5, "id")


@query("table_info", with_outcomes("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count({c}) AS non_null, {_typeof(c)} AS dtype, "
    f"count(*) AS \"rows\" FROM outcomes" for i, c in enumerate(OUTCOME_COLUMNS))),
    operators=["P02", "P04"])
def q_table_info(spark, sf):
    return profile.info(outcomes(spark, sf))


@query("nunique_columns", with_outcomes("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count(DISTINCT {c}) AS nunique FROM outcomes"
    for i, c in enumerate(OUTCOME_COLUMNS))), operators=["P03"])
def q_nunique_columns(spark, sf):
    return profile.nunique(outcomes(spark, sf))


@query("column_summary", with_outcomes("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", {_typeof(c)} AS dtype, "
    f"count(DISTINCT {c}) AS nunique FROM outcomes" for i, c in enumerate(OUTCOME_COLUMNS))),
    operators=["P05"])
def q_column_summary(spark, sf):
    return profile.column_summary(outcomes(spark, sf))


_ROLE_COLS = [c for c in OUTCOME_COLUMNS if c not in ("id", "score", "outcome")]


@query("infer_roles", with_outcomes("\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count(DISTINCT {c}) AS nunique, "
    f"CASE WHEN count(DISTINCT {c}) <= 15 THEN 'categorical' ELSE 'numeric' END AS role FROM outcomes"
    for i, c in enumerate(_ROLE_COLS))), operators=["P06"])
def q_infer_roles(spark, sf):
    return profile.infer_roles(outcomes(spark, sf), "outcome", exclude=["id", "score"])


@query("null_counts_raw", with_raw("\nUNION ALL\n".join(
    [f"SELECT {i} AS position, '{c}' AS \"column\", CAST(count_if({c} IS NULL"
     f"{' OR isnan(' + c + ')' if c in ('admission', 'q1', 'q2') else ''}) AS BIGINT) AS nulls FROM raw"
     for i, c in enumerate(RAW_COLUMNS)]
    + [f"SELECT {len(RAW_COLUMNS)} AS position, '__total__' AS \"column\", CAST("
       + " + ".join(f"count_if({c} IS NULL)" for c in RAW_COLUMNS) + " AS BIGINT) AS nulls FROM raw"])),
    operators=["P08"])
def q_null_counts_raw(spark, sf):
    return profile.null_counts(outcomes_raw(spark, sf))


def _absent(c: str) -> str:
    return f"{c} IS NULL OR isnan({c})" if c in ("admission", "q1", "q2") else f"{c} IS NULL"


@query("missing_patterns_raw", with_raw(
    "SELECT " + " || ".join(f"CASE WHEN {_absent(c)} THEN '0' ELSE '1' END" for c in RAW_COLUMNS)
    + " AS pattern, " + " + ".join(f"CASE WHEN {_absent(c)} THEN 1 ELSE 0 END" for c in RAW_COLUMNS)
    + " AS n_missing, count(*) AS \"rows\" FROM raw GROUP BY ALL"), operators=["P09"])
def q_missing_patterns_raw(spark, sf):
    return profile.missing_patterns(outcomes_raw(spark, sf))


@query("missing_matrix_raw", with_raw(
    "SELECT id, " + ", ".join(f"CAST(NOT ({_absent(c)}) AS INTEGER) AS {c}" for c in RAW_COLUMNS if c != "id")
    + " FROM raw"), operators=["P09"])
def q_missing_matrix_raw(spark, sf):
    return profile.missing_matrix(outcomes_raw(spark, sf), "id")


@query("outcome_value_counts", with_outcomes(
    "SELECT outcome AS value, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS percent "
    "FROM outcomes GROUP BY outcome"), round_cols=["percent"], operators=["P10"])
def q_outcome_value_counts(spark, sf):
    return profile.value_counts(outcomes(spark, sf), "outcome")


@query("segment_values", with_outcomes("SELECT DISTINCT segment AS value FROM outcomes"),
       operators=["P11"])
def q_segment_values(spark, sf):
    return profile.distinct_values(outcomes(spark, sf), "segment")


def _box_sql() -> str:
    parts = []
    for c in BOX_COLUMNS:
        parts.append(f"""SELECT s.outcome, '{c}' AS "column", q1, median, q3,
  min(CASE WHEN x >= lo AND x <= hi THEN x END) AS whisker_lo,
  max(CASE WHEN x >= lo AND x <= hi THEN x END) AS whisker_hi,
  CAST(count_if(x < lo OR x > hi) AS BIGINT) AS outliers, count(x) AS n
FROM (SELECT outcome, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
        quantile_cont(CAST({c} AS DOUBLE), 0.25) - 1.5 * (quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25)) AS lo,
        quantile_cont(CAST({c} AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25)) AS hi
      FROM outcomes GROUP BY outcome) s
JOIN (SELECT outcome, CAST({c} AS DOUBLE) AS x FROM outcomes) d ON d.outcome = s.outcome
GROUP BY s.outcome, q1, median, q3""")
    return with_outcomes("\nUNION ALL\n".join(parts))


@query("grade_box_stats", _box_sql(), round_cols=["q1", "median", "q3", "whisker_lo", "whisker_hi"],
       operators=["P12"])
def q_grade_box_stats(spark, sf):
    return eda.box_stats(outcomes(spark, sf), "outcome", BOX_COLUMNS)


DECILE_COLUMNS = ["p1_grade", "admission", "balance"]


@query("exact_deciles", with_outcomes("\nUNION ALL\n".join(
    f"SELECT outcome, '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, quantile_cont(CAST({c} AS DOUBLE), {p}) AS value "
    f"FROM outcomes WHERE {c} IS NOT NULL GROUP BY outcome" for c in DECILE_COLUMNS for p in (0.1, 0.5, 0.9))),
    round_cols=["value"], operators=["P12"])
def q_exact_deciles(spark, sf):
    return eda.exact_percentiles(outcomes(spark, sf), "outcome", DECILE_COLUMNS, [0.1, 0.5, 0.9])


@query("age_histogram", with_outcomes("""
SELECT outcome, bin, count(*) AS count, lo + bin * w AS bin_lo,
  CASE WHEN bin = 19 THEN hi ELSE lo + (bin + 1) * w END AS bin_hi
FROM (SELECT outcome, lo, hi, w,
        CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((CAST(age AS DOUBLE) - lo) / w), 19) END AS INT) AS bin
      FROM outcomes, (SELECT CAST(min(age) AS DOUBLE) AS lo, CAST(max(age) AS DOUBLE) AS hi,
                             (CAST(max(age) AS DOUBLE) - CAST(min(age) AS DOUBLE)) / 20 AS w FROM outcomes) m
      WHERE age IS NOT NULL) t
GROUP BY outcome, bin, lo, hi, w"""), round_cols=["bin_lo", "bin_hi"], operators=["P13"])
def q_age_histogram(spark, sf):
    return eda.histogram(outcomes(spark, sf), "age", "outcome", bins=20)


@query("priority_outcome_counts", with_outcomes(
    "SELECT priority, CAST(count_if(outcome = 'Dropout') AS BIGINT) AS Dropout, "
    "CAST(count_if(outcome = 'Enrolled') AS BIGINT) AS Enrolled, "
    "CAST(count_if(outcome = 'Graduate') AS BIGINT) AS Graduate FROM outcomes GROUP BY priority"), operators=["P15"])
def q_priority_outcome_counts(spark, sf):
    return eda.crosstab(outcomes(spark, sf), "priority", "outcome", values=CLASSES)


@query("status_segment_outcome_counts", with_outcomes(
    "SELECT status, segment, CAST(count_if(outcome = 'Dropout') AS BIGINT) AS Dropout, "
    "CAST(count_if(outcome = 'Enrolled') AS BIGINT) AS Enrolled, "
    "CAST(count_if(outcome = 'Graduate') AS BIGINT) AS Graduate "
    "FROM outcomes GROUP BY status, segment"), operators=["P16"])
def q_status_segment_outcome_counts(spark, sf):
    return eda.crosstab(outcomes(spark, sf), ["status", "segment"], "outcome", values=CLASSES)


@query("grade_density", with_outcomes("""
WITH st AS (
  SELECT outcome, count(*) AS n, stddev_samp(p1_grade) AS sd, min(p1_grade) AS lo, max(p1_grade) AS hi
  FROM outcomes WHERE p1_grade IS NOT NULL GROUP BY outcome),
g AS (
  SELECT outcome, n, sd * pow(n, -0.2) AS bw, lo - 2.0 * sd * pow(n, -0.2) AS glo,
         hi + 2.0 * sd * pow(n, -0.2) AS ghi FROM st),
grid AS (
  SELECT outcome, n, bw, CAST(i AS INT) AS point, glo + i * ((ghi - glo) / 99) AS x
  FROM g, range(100) r(i)),
c AS (SELECT outcome, p1_grade AS v, count(*) AS cnt FROM outcomes WHERE p1_grade IS NOT NULL GROUP BY ALL)
SELECT grid.outcome, point, x,
  sum(cnt * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (n * bw * sqrt(2 * pi())) AS density
FROM grid JOIN c ON c.outcome = grid.outcome
GROUP BY grid.outcome, point, x, n, bw"""), round_cols=["x", "density"], operators=["P17"])
def q_grade_density(spark, sf):
    return eda.kde(outcomes(spark, sf), "p1_grade", "outcome", points=100)


BINS_PER_BANDWIDTH = 16


@query("grade_density_binned", with_outcomes(f"""
WITH st AS (
  SELECT outcome, count(*) AS n, stddev_samp(p1_grade) * pow(count(*), -0.2) AS bw, min(p1_grade) AS lo, max(p1_grade) AS hi
  FROM outcomes WHERE p1_grade IS NOT NULL GROUP BY outcome),
grid AS (SELECT outcome, CAST(i AS INT) AS point, lo - 2.0 * bw + i * ((hi - lo + 4.0 * bw) / 99) AS x FROM st, range(100) r(i)),
c AS (SELECT outcome, p1_grade AS v, count(*) AS cnt FROM outcomes WHERE p1_grade IS NOT NULL GROUP BY ALL),
placed AS (SELECT outcome, cnt, v, (v - lo) * {BINS_PER_BANDWIDTH} / bw AS place FROM c JOIN st USING (outcome)),
bins AS (
  SELECT outcome, bin, sum(w) AS w FROM (
    SELECT outcome, floor(place) AS bin, cnt * (1 - (place - floor(place))) AS w FROM placed
    UNION ALL SELECT outcome, floor(place) + 1, cnt * (place - floor(place)) FROM placed) GROUP BY ALL),
binned AS (
  SELECT outcome, point, x, sum(w * exp(-0.5 * pow((x - lo - bin * bw / {BINS_PER_BANDWIDTH}) / bw, 2))) / (any_value(n * bw) * sqrt(2 * pi())) AS density
  FROM grid JOIN st USING (outcome) JOIN bins USING (outcome) GROUP BY ALL),
exact AS (
  SELECT outcome, point, sum(cnt * exp(-0.5 * pow((x - v) / bw, 2))) / (any_value(n * bw) * sqrt(2 * pi())) AS density
  FROM grid JOIN st USING (outcome) JOIN c USING (outcome) GROUP BY ALL)
SELECT outcome, point, x, b.density, abs(b.density - e.density) <= 1.0 / (8 * {BINS_PER_BANDWIDTH**2} * sqrt(2 * pi()) * bw) AS within_bound
FROM binned b JOIN exact e USING (outcome, point) JOIN st USING (outcome)"""), round_cols=["x", "density"], operators=["P17"])
def q_grade_density_binned(spark, sf):
    """Binned densities, and whether each lies within the stated bound of the exact one."""
    df = outcomes(spark, sf)
    value = F.col("p1_grade")
    width = df.where(value.isNotNull()).groupBy("outcome").agg(
        (F.stddev_samp(value) * F.pow(F.count(value), F.lit(-0.2))).alias("bw"))
    exact = eda.kde(df, "p1_grade", "outcome").select("outcome", "point", F.col("density").alias("exact"))
    binned = eda.kde(df, "p1_grade", "outcome", bins_per_bandwidth=BINS_PER_BANDWIDTH)
    within = F.abs(F.col("density") - F.col("exact")) <= eda.kde_error_bound(F.col("bw"), BINS_PER_BANDWIDTH)
    return binned.join(exact, ["outcome", "point"]).join(width, "outcome").select("outcome", "point", "x", "density", within.alias("within_bound"))


@query("admission_grade_scatter", with_outcomes(
    "SELECT id, outcome, admission, p1_grade FROM outcomes "
    "WHERE admission IS NOT NULL AND p1_grade IS NOT NULL"),
    round_cols=["admission", "p1_grade"], operators=["P18"])
def q_admission_grade_scatter(spark, sf):
    return eda.scatter(outcomes(spark, sf), "admission", "p1_grade", "outcome", id_col="id")


@query("admission_grade_bins", with_outcomes("""
WITH m AS (SELECT min(admission) AS xlo, max(admission) AS xhi, min(p1_grade) AS ylo, max(p1_grade) AS yhi FROM outcomes)
SELECT outcome,
  CAST(CASE WHEN xhi = xlo THEN 0 ELSE least(floor((admission - xlo) * 50 / (xhi - xlo)), 49) END AS INT) AS x_bin,
  CAST(CASE WHEN yhi = ylo THEN 0 ELSE least(floor((p1_grade - ylo) * 50 / (yhi - ylo)), 49) END AS INT) AS y_bin,
  count(*) AS count
FROM outcomes, m WHERE admission IS NOT NULL AND p1_grade IS NOT NULL GROUP BY ALL"""),
    operators=["P18"])
def q_admission_grade_bins(spark, sf):
    return eda.scatter(outcomes(spark, sf), "admission", "p1_grade", "outcome", bins=50)


_LABEL_CODE_SQL = "CASE outcome WHEN 'Dropout' THEN 0.0 WHEN 'Enrolled' THEN 1.0 WHEN 'Graduate' THEN 2.0 END"


def _corr_with_spark(spark, sf):
    from cohortlens.operators.prep import encode_label
    df, _ = encode_label(outcomes(spark, sf), "outcome", "target")
    return eda.corr_with(df, CORR_COLUMNS, "target")


_CORR_WITH_SQL = with_outcomes("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", corr(CAST({c} AS DOUBLE), {_LABEL_CODE_SQL}) AS corr FROM outcomes"
    for c in CORR_COLUMNS))


@query("corr_with_target", _CORR_WITH_SQL, round_cols=["corr"], operators=["P21", "T09"])
def q_corr_with_target(spark, sf):
    return _corr_with_spark(spark, sf)


@query("ranked_correlations", f"""
WITH c AS ({_CORR_WITH_SQL})
SELECT * FROM (
  SELECT "column", corr, 'top' AS side, CAST(row_number() OVER (ORDER BY corr DESC, "column") AS INTEGER) AS rank FROM c WHERE corr IS NOT NULL
) WHERE rank <= 5
UNION ALL
SELECT * FROM (
  SELECT "column", corr, 'bottom' AS side, CAST(row_number() OVER (ORDER BY corr ASC, "column") AS INTEGER) AS rank FROM c WHERE corr IS NOT NULL
) WHERE rank <= 5""", round_cols=["corr"], operators=["P22"])
def q_ranked_correlations(spark, sf):
    return eda.rank_corr(_corr_with_spark(spark, sf), 5)


@query("key_corr_matrix", with_outcomes("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM outcomes"
    for a in KEY_COLUMNS for b in KEY_COLUMNS)), round_cols=["corr"], operators=["P23"])
def q_key_corr_matrix(spark, sf):
    return eda.corr_matrix(outcomes(spark, sf), KEY_COLUMNS)


@query("vector_corr_matrix", with_outcomes("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM outcomes"
    for a in KEY_COLUMNS for b in KEY_COLUMNS)), round_cols=["corr"], operators=["P23"])
def q_vector_corr_matrix(spark, sf):
    """The same matrix from one tree aggregation of assembled vectors."""
    from pyspark.ml.feature import VectorAssembler
    assembled = VectorAssembler(inputCols=KEY_COLUMNS, outputCol="v").transform(outcomes(spark, sf))
    return eda.corr_matrix_vector(assembled, "v", KEY_COLUMNS)


@query("table_shape", with_outcomes("SELECT count(*) AS \"rows\", 22 AS columns FROM outcomes"),
       operators=["P24"])
def q_table_shape(spark, sf):
    return profile.shape(outcomes(spark, sf))
