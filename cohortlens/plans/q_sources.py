"""Queries for sources and sinks.

Each writes data Spark derived from the given tables to a fresh folder
under the shared checkpoint folder and reads it back through the
operator under test; the DuckDB twin computes the same rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.plans.oracle import with_outcomes
from cohortlens.plans.q_metrics import rule_predictions, with_rules
from cohortlens.plans.q_prep import split_outcomes, with_split
from cohortlens.plans.q_profile import DOUBLE_OUTCOME
from cohortlens.plans.registry import query
from cohortlens.session import scratch_path
from cohortlens.sources import files
from cohortlens.sources.tables import FIXTURE_NUMERIC, outcomes


@query("csv_roundtrip_sniffed", with_outcomes("SELECT * FROM outcomes"), round_cols=DOUBLE_OUTCOME,
       operators=["A01", "A02", "A10"])
def q_csv_roundtrip_sniffed(spark, sf):
    df = outcomes(spark, sf)
    path = scratch_path(spark, "outcomes-csv")
    files.write_table(df, path, "csv", sep=";")
    # delimiter sniffed from the first line, schema given (no inference pass)
    return files.read_table(spark, path, schema=df.schema, sep=None)


@query("feature_matrix_roundtrip", with_split("SELECT id, outcome FROM sp WHERE split = 'train'"),
       operators=["A03", "A05"])
def q_feature_matrix_roundtrip(spark, sf):
    from cohortlens.plans.q_models import prepared
    train, *_ = prepared(spark, sf)
    path = scratch_path(spark, "features")
    files.save_features(train, path)
    back = files.load_features(spark, path)
    return back.select("id", "outcome")


@query("predictions_partitioned", with_rules(
    "SELECT model, row_id, prediction FROM rp WHERE model = 'rule_full' AND variant = 'baseline'"),
    operators=["A06", "A07"])
def q_predictions_partitioned(spark, sf):
    rp = rule_predictions(spark, sf).where(F.col("variant") == "baseline") \
        .select("model", "row_id", "label", "prediction")
    path = scratch_path(spark, "predictions")
    files.save_predictions(rp, path)
    back = files.load_predictions(spark, path, models=["rule_full"])
    return back.select("model", "row_id", "prediction")


SLOTS = FIXTURE_NUMERIC[:4]


@query("feature_matrix_slots", with_split("SELECT id, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER () AS s{i}"
    for i, c in enumerate(SLOTS)) + " FROM sp WHERE split = 'train'"),
    round_cols=[f"s{i}" for i in range(len(SLOTS))], operators=["A05"])
def q_feature_matrix_slots(spark, sf):
    """The written vector column read back: its first slots are the scaled numerics."""
    from pyspark.ml.functions import vector_to_array
    from cohortlens.plans.q_models import prepared
    train, *_ = prepared(spark, sf)
    path = scratch_path(spark, "feature-slots")
    files.save_features(train, path)
    slots = vector_to_array(F.col("features"))
    return files.load_features(spark, path).select("id", *[slots[i].alias(f"s{i}") for i in range(len(SLOTS))])


@query("split_roundtrip", with_split("SELECT id, outcome, 'train' AS side FROM sp WHERE split = 'train'\n"
                                     "UNION ALL SELECT id, outcome, 'test' AS side FROM sp WHERE split = 'test'"),
       operators=["A03"])
def q_split_roundtrip(spark, sf):
    path = scratch_path(spark, "split")
    files.save_split(split_outcomes(spark, sf).select("id", "age", "admission", "outcome", "split"), path)
    x_train, x_test, y_train, y_test = files.load_split(spark, path, "outcome", "id")
    return (x_train.join(y_train, "id").select("id", "outcome", F.lit("train").alias("side"))
            .unionByName(x_test.join(y_test, "id").select("id", "outcome", F.lit("test").alias("side"))))
