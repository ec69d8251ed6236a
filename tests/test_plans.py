"""Plan checks: pruned scans, no all-pairs joins, no single-partition
windows over row data."""

from cohortlens.operators import eda, prep
from cohortlens.plans.registry import all_queries
from cohortlens.sources.tables import outcomes

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture_scan_is_pruned(spark):
    plan = _plan(outcomes(spark, SF_SMALL))
    # lineitem is read with only the columns the fixture uses
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan
    assert "ReadSchema" in plan


def test_no_cartesian_products_in_sql_backed_queries(spark):
    for name, q in all_queries().items():
        if q.sql is None:
            continue
        plan = _plan(q.run(spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name


def test_split_window_is_partitioned(spark):
    sp = prep.stratified_split(outcomes(spark, SF_SMALL), "outcome", "id")
    plan = sp._jdf.queryExecution().optimizedPlan().toString()
    # every window of the split is partitioned (by class or bucket), never global
    for line in plan.splitlines():
        if "Window [" in line:
            assert "__g" in line, line


def test_crosstab_with_values_is_one_aggregation(spark):
    df = outcomes(spark, SF_SMALL)
    ct = eda.crosstab(df, "priority", "outcome", values=["Dropout", "Enrolled", "Graduate"])
    plan = _plan(ct)
    assert "pivotfirst" in plan.lower() or "PivotFirst" in plan or "HashAggregate" in plan


def test_prediction_filter_prunes_partitions(spark):
    plan = _plan(all_queries()["predictions_partitioned"].run(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(model" in plan and "= rule_full)" in plan
    assert "ReadSchema: struct<row_id:bigint,prediction:string>" in plan
