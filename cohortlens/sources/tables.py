"""Test tables and the `outcomes` working fixture.

`outcomes` turns the order tables into one row per entity with coded
categoricals, two-period unit counts and grades, and a three-class
outcome (see FIXTURES.md). It is declared with the DataFrame API so
Catalyst prunes the parquet scans to the columns used and plans the
lineitem aggregate and the two joins:

* lineitem is aggregated by order key with partial (map-side)
  aggregation, so only one row per order and map task is shuffled;
* the aggregate is already hash-partitioned on the order key, so the
  order side is the only one exchanged for that join;
* customer is joined on its key; AQE turns it into a broadcast join only
  when the runtime size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the fixture definition (FIXTURES.md part B)
FIRST_PERIOD_MAX_LINE = 3
CREDIT_DISCOUNT = 0.08
EVALUATION_TAX = 0.01
GRADE_DIVISOR = 2.5
AGE_BASE, AGE_SPAN = 17, 50
SCORE_APPROVED_WEIGHT = 6
SCORE_NOISE_MULT, SCORE_NOISE_MOD, SCORE_NOISE_DIV = 7919, 1000, 125
DROPOUT_BELOW, ENROLLED_BELOW = 23.0, 28.5

PERIOD_COUNT_COLUMNS = [
    "p1_enrolled", "p2_enrolled", "p1_approved", "p2_approved", "p1_credited",
    "p2_credited", "p1_evaluations", "p2_evaluations", "p1_without_eval", "p2_without_eval",
]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def period_counts(lineitem: DataFrame) -> DataFrame:
    """Per-order unit counts and quantities for the two periods."""
    p1 = F.col("l_linenumber") <= FIRST_PERIOD_MAX_LINE
    p2 = F.col("l_linenumber") > FIRST_PERIOD_MAX_LINE
    approved = F.col("l_returnflag") != "R"
    credited = F.col("l_discount") >= CREDIT_DISCOUNT
    evaluated = F.col("l_tax") > EVALUATION_TAX
    open_line = F.col("l_linestatus") == "O"
    return lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(
        _count_if(p1).alias("p1_enrolled"),
        _count_if(p2).alias("p2_enrolled"),
        _count_if(p1 & approved).alias("p1_approved"),
        _count_if(p2 & approved).alias("p2_approved"),
        _count_if(p1 & credited).alias("p1_credited"),
        _count_if(p2 & credited).alias("p2_credited"),
        _count_if(p1 & evaluated).alias("p1_evaluations"),
        _count_if(p2 & evaluated).alias("p2_evaluations"),
        _count_if(p1 & open_line).alias("p1_without_eval"),
        _count_if(p2 & open_line).alias("p2_without_eval"),
        F.sum(F.when(p1, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("q1"),
        F.sum(F.when(p2, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("q2"),
    )


def outcomes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left-joined to their period counts, nulls kept.

    Orders without line items carry NULL counts: this is the input for the
    null-profile and imputation operators.
    """
    orders = load_table(spark, sf_dir, "orders")
    li = period_counts(load_table(spark, sf_dir, "lineitem"))
    return (
        orders.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("admission"),
        )
        .join(li, F.col("k") == F.col("id"), "left")
        .drop("k")
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled working fixture (one row per order)."""
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    customer = load_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    li = period_counts(load_table(spark, sf_dir, "lineitem"))
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(li, F.col("k") == F.col("o_orderkey"), "left")
    )
    counts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in PERIOD_COUNT_COLUMNS]

    def grade(q: str, n: str) -> Column:
        return (F.when(F.col(n) > 0, F.col(q) / F.col(n) / F.lit(GRADE_DIVISOR))
                .otherwise(F.lit(0.0)))

    f = joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        (F.lit(AGE_BASE) + F.col("o_custkey") % AGE_SPAN).cast("int").alias("age"),
        F.col("o_totalprice").alias("admission"),
        F.col("c_acctbal").alias("balance"),
        *counts,
        grade("q1", "p1_enrolled").alias("p1_grade"),
        grade("q2", "p2_enrolled").alias("p2_grade"),
    )
    score = (
        (F.lit(SCORE_APPROVED_WEIGHT) * (F.col("p1_approved") + F.col("p2_approved"))).cast("double")
        + (F.col("p1_grade") + F.col("p2_grade")) / 2
        + ((F.col("id") * SCORE_NOISE_MULT) % SCORE_NOISE_MOD).cast("double") / SCORE_NOISE_DIV
    )
    s = f.withColumn("score", score)
    return s.withColumn(
        "outcome",
        F.when(F.col("score") < DROPOUT_BELOW, "Dropout")
        .when(F.col("score") < ENROLLED_BELOW, "Enrolled")
        .otherwise("Graduate"),
    )


# column roles of the fixture
FIXTURE_CATEGORICAL = ["priority", "status", "segment", "nation"]
FIXTURE_NUMERIC = [
    "age", "admission", "balance", "p1_credited", "p1_enrolled", "p1_evaluations", "p1_approved",
    "p1_grade", "p1_without_eval", "p2_credited", "p2_enrolled", "p2_evaluations", "p2_approved",
    "p2_grade", "p2_without_eval",
]
FIXTURE_LABEL = "outcome"
FIXTURE_ID = "id"
CLASSES = ["Dropout", "Enrolled", "Graduate"]


def write_outcomes_table(spark: SparkSession, sf_dir: str, path: str, partition_by: str | None = "outcome") -> str:
    """Build the entity table once and write it (Parquet, partitioned by
    outcome) so that multi-pass analyses read it instead of re-aggregating
    lineitem each pass; at 100 TB this is the intended deployment."""
    w = outcomes(spark, sf_dir).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path
