"""Profile and selection operators on columns with NULL, NaN and an offset.

`gappy` is derived from `lineitem`: x has NULLs and NaNs, y has NULLs, z has
neither but a large offset, and some rows have no class. The twins are written
from the definitions (pairs with both values, deviations from the grand mean).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import eda, prep, select
from cohortlens.plans.registry import query
from cohortlens.sources.tables import load_table

GAPPY_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS id,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag END AS grp,
  CASE WHEN l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS x,
  CASE WHEN l_linenumber <> 2 THEN CAST(l_extendedprice AS DOUBLE) + 2 * CAST(l_quantity AS DOUBLE) END AS y,
  1e9 + CAST(l_quantity AS DOUBLE) + CASE WHEN l_returnflag = 'R' THEN 3 ELSE 0 END AS z
FROM lineitem
"""
COLUMNS = ["x", "y", "z"]


def gappy(spark, sf):
    """As GAPPY_SQL, but with NaN in x where the order key is a multiple of 11."""
    li = load_table(spark, sf, "lineitem")
    key, qty = F.col("l_orderkey"), F.col("l_quantity").cast("double")
    return li.select(
        (key * 10 + F.col("l_linenumber")).alias("id"),
        F.when(key % 13 != 0, F.col("l_returnflag")).alias("grp"),
        F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, F.lit(float("nan"))).otherwise(qty).alias("x"),
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice").cast("double") + 2 * qty).alias("y"),
        (F.lit(1e9) + qty + F.when(F.col("l_returnflag") == "R", 3).otherwise(0)).alias("z"))


def with_gappy(body: str) -> str:
    return f"WITH gappy AS ({GAPPY_SQL}){body}"


def _pairs(a: str, b: str) -> str:
    return f"(SELECT corr({a}, {b}) FROM gappy WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


@query("missing_corr_with_target", with_gappy("\nUNION ALL\n".join(
    f" SELECT '{c}' AS \"column\", {_pairs(c, 'y')} AS corr" for c in ("x", "z"))), round_cols=["corr"], operators=["P21"])
def q_missing_corr(spark, sf):
    return eda.corr_with(gappy(spark, sf), ["x", "z"], "y")


@query("missing_corr_matrix", with_gappy("\nUNION ALL\n".join(
    f" SELECT '{a}' AS col_a, '{b}' AS col_b, {_pairs(a, b)} AS corr" for a in COLUMNS for b in COLUMNS)),
    round_cols=["corr"], operators=["P23"])
def q_missing_corr_matrix(spark, sf):
    return eda.corr_matrix(gappy(spark, sf), COLUMNS)


def _anova() -> str:
    long = "\nUNION ALL\n".join(f"SELECT {i} AS position, '{c}' AS feature, grp, {c} AS v FROM gappy"
                                f" WHERE grp IS NOT NULL AND {c} IS NOT NULL" for i, c in enumerate(COLUMNS))
    return with_gappy(f""",
l AS ({long}),
a AS (SELECT position, feature, avg(v) AS grand, count(*) AS n, count(DISTINCT grp) AS k FROM l GROUP BY ALL),
c AS (SELECT position, grp, avg(v) AS m, count(*) AS n FROM l GROUP BY ALL),
b AS (SELECT position, sum(c.n * (m - grand) * (m - grand)) AS ssb FROM c JOIN a USING (position) GROUP BY position),
w AS (SELECT position, sum((v - m) * (v - m)) AS ssw FROM l JOIN c USING (position, grp) GROUP BY position)
SELECT position, feature, round((ssb / (k - 1)) / (ssw / (n - k)), 2) AS f_score
FROM a JOIN b USING (position) JOIN w USING (position)""")


@query("missing_anova_f", _anova(), operators=["L01"])
def q_missing_anova(spark, sf):
    return select.anova_f(gappy(spark, sf), COLUMNS, "grp").withColumn("f_score", F.round("f_score", 2))


def _box() -> str:
    parts = []
    for c in ("x", "y"):
        parts.append(f"""
SELECT s.grp, '{c}' AS "column", q1, median, q3, min(CASE WHEN {c} BETWEEN lo AND hi THEN {c} END) AS whisker_lo,
  max(CASE WHEN {c} BETWEEN lo AND hi THEN {c} END) AS whisker_hi,
  CAST(count_if({c} < lo OR {c} > hi) AS BIGINT) AS outliers, count({c}) AS n
FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
        SELECT grp, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3
        FROM gappy GROUP BY grp)) s
JOIN gappy g ON g.grp IS NOT DISTINCT FROM s.grp
GROUP BY s.grp, q1, median, q3""")
    return with_gappy("\nUNION ALL\n".join(parts))


@query("missing_box_stats", _box(), round_cols=["q1", "median", "q3", "whisker_lo", "whisker_hi"], operators=["P12"])
def q_missing_box(spark, sf):
    return eda.box_stats(gappy(spark, sf), "grp", ["x", "y"])


@query("missing_histogram", with_gappy("""
SELECT grp, bin, count(*) AS count, lo + bin * w AS bin_lo, CASE WHEN bin = 19 THEN hi ELSE lo + (bin + 1) * w END AS bin_hi
FROM (SELECT grp, lo, hi, w, CAST(least(floor((x - lo) / w), 19) AS INT) AS bin
      FROM gappy, (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 20 AS w FROM gappy) WHERE x IS NOT NULL)
GROUP BY grp, bin, lo, hi, w"""), round_cols=["bin_lo", "bin_hi"], operators=["P13"])
def q_missing_histogram(spark, sf):
    return eda.histogram(gappy(spark, sf), "x", "grp", bins=20)


@query("missing_stratified_split", with_gappy("""
SELECT id, grp, CASE WHEN row_number() OVER (PARTITION BY grp ORDER BY md5(CAST(id AS VARCHAR) || '|42'), id)
                      <= round(count(*) OVER (PARTITION BY grp) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM gappy"""), operators=["T02"])
def q_missing_split(spark, sf):
    return prep.stratified_split(gappy(spark, sf).select("id", "grp"), "grp", "id")
