"""DuckDB twins of the registered queries (the correctness oracle).

`OUTCOMES_SQL` defines the working fixture exactly as FIXTURES.md does;
each oracle wraps it in a CTE. Integer sums are cast to BIGINT because
DuckDB types them HUGEINT.
"""

from __future__ import annotations

OUTCOMES_SQL = """
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
  FROM lineitem GROUP BY l_orderkey),
f AS (
  SELECT o_orderkey AS id, o_orderpriority AS priority, o_orderstatus AS status,
    c_mktsegment AS segment, c_nationkey AS nation,
    CAST(17 + (o_custkey % 50) AS INT) AS age, o_totalprice AS admission, c_acctbal AS balance,
    COALESCE(p1_enrolled,0) AS p1_enrolled, COALESCE(p2_enrolled,0) AS p2_enrolled,
    COALESCE(p1_approved,0) AS p1_approved, COALESCE(p2_approved,0) AS p2_approved,
    COALESCE(p1_credited,0) AS p1_credited, COALESCE(p2_credited,0) AS p2_credited,
    COALESCE(p1_evaluations,0) AS p1_evaluations, COALESCE(p2_evaluations,0) AS p2_evaluations,
    COALESCE(p1_without_eval,0) AS p1_without_eval, COALESCE(p2_without_eval,0) AS p2_without_eval,
    CASE WHEN p1_enrolled > 0 THEN q1 / p1_enrolled / 2.5 ELSE 0.0 END AS p1_grade,
    CASE WHEN p2_enrolled > 0 THEN q2 / p2_enrolled / 2.5 ELSE 0.0 END AS p2_grade
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON k = o_orderkey),
s AS (
  SELECT f.*, CAST(6 * (p1_approved + p2_approved) AS DOUBLE) + (p1_grade + p2_grade) / 2
    + CAST((id * 7919) % 1000 AS DOUBLE) / 125 AS score FROM f)
SELECT s.*, CASE WHEN score < 23.0 THEN 'Dropout' WHEN score < 28.5 THEN 'Enrolled' ELSE 'Graduate' END AS outcome FROM s
"""

FEATURES_SQL = """
SELECT o.*,
  p1_approved + p2_approved AS total_approved,
  p1_enrolled + p2_enrolled AS total_enrolled,
  CASE WHEN p1_enrolled + p2_enrolled > 0
       THEN (p1_approved + p2_approved) / (p1_enrolled + p2_enrolled) ELSE 0.0 END AS approval_rate,
  (p1_grade + p2_grade) / 2 AS avg_grade,
  p2_grade - p1_grade AS grade_improvement,
  p2_approved - p1_approved AS approval_improvement,
  p1_credited + p2_credited AS total_credited,
  p1_without_eval + p2_without_eval AS total_without_eval,
  CASE WHEN age > 0 AND age <= 20 THEN 0 WHEN age > 20 AND age <= 25 THEN 1
       WHEN age > 25 AND age <= 30 THEN 2 WHEN age > 30 AND age <= 100 THEN 3 END AS age_group
FROM outcomes o
"""


def with_outcomes(body: str, features: bool = False) -> str:
    """Wrap a statement over `outcomes` (and optionally `fe`, the fixture
    with engineered features) in the fixture CTEs."""
    ctes = f"outcomes AS ({OUTCOMES_SQL})"
    if features:
        ctes += f", fe AS ({FEATURES_SQL})"
    text = body.lstrip()
    if text[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{body}"
