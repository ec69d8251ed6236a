"""Data-quality checks.

Each check is one aggregation and returns rows of
(check, value, passed); nothing but the counts reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.profile import q

# fixed values of the reference's checks
TRAIN_SHARE_RANGE = (0.75, 0.85)
MIN_CLASS_SHARE = 0.10
MIN_ACCURACY = 0.6
PROBA_TOLERANCE = 1e-6


@dataclass(frozen=True)
class Rule:
    """A12 domain rule: bounds and/or an allowed list for one field."""

    column: str
    min: float | None = None
    max: float | None = None
    allowed: Sequence | None = None

    def violated(self) -> Column:
        x = q(self.column)
        bad = F.lit(False)
        if self.min is not None:
            bad = bad | (x < self.min)
        if self.max is not None:
            bad = bad | (x > self.max)
        if self.allowed is not None:
            bad = bad | ~x.isin(list(self.allowed))
        return x.isNotNull() & bad


def _checks(row: DataFrame, items: list[tuple[str, Column, Column]]) -> DataFrame:
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), ok.alias("passed"))
        for name, value, ok in items])))


def check_domains(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule, all rules in one aggregate."""
    row = df.agg(*[F.count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(rules)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(r.column).alias("column"), F.col(f"r{i}").alias("violations"),
                 (F.col(f"r{i}") == 0).alias("passed")) for i, r in enumerate(rules)])))


def check_no_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL or NaN in any of `cols`."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    miss = F.lit(False)
    for c in cols:
        m = q(c).isNull()
        if types.get(c) in ("double", "float"):
            m = m | F.isnan(q(c))
        miss = miss | m
    row = df.agg(F.count_if(miss).alias("n"))
    return _checks(row, [("rows_with_missing", F.col("n"), F.col("n") == 0)])


def check_split(train: DataFrame, test: DataFrame, lo: float = TRAIN_SHARE_RANGE[0],
                hi: float = TRAIN_SHARE_RANGE[1]) -> DataFrame:
    """Train share inside (lo, hi); both sides non-empty."""
    n_train = train.select(F.count(F.lit(1))).scalar()
    n_test = test.select(F.count(F.lit(1))).scalar()
    share = F.try_divide(n_train, n_train + n_test)
    row = train.sparkSession.range(1)
    return _checks(row, [("train_rows", n_train, n_train > 0), ("test_rows", n_test, n_test > 0),
                         ("train_share", share, F.coalesce((share > lo) & (share < hi), F.lit(False)))])


def check_width(df: DataFrame, features_col: str, n: int) -> DataFrame:
    """Every feature vector has exactly n slots."""
    from pyspark.ml.functions import vector_to_array
    size = F.size(vector_to_array(F.col(features_col)))
    row = df.agg(F.min(size).alias("lo"), F.max(size).alias("hi"))
    return _checks(row, [("min_width", F.col("lo"), F.col("lo") == n),
                         ("max_width", F.col("hi"), F.col("hi") == n)])


def check_class_share(df: DataFrame, label: str, classes: Sequence[str],
                      min_share: float = MIN_CLASS_SHARE) -> DataFrame:
    """Every expected class is present with more than `min_share` of rows."""
    total = F.count(F.lit(1))
    row = df.agg(total.alias("n"), *[F.count_if(q(label) == c).alias(f"c{i}") for i, c in enumerate(classes)])
    share = [F.try_divide(F.col(f"c{i}"), F.col("n")) for i in range(len(classes))]
    return _checks(row, [(f"share_{c}", share[i], F.coalesce(share[i] > min_share, F.lit(False)))
                         for i, c in enumerate(classes)])


def check_classes(df: DataFrame, label: str, expected: Sequence[str]) -> DataFrame:
    """The sorted distinct labels equal the expected class list."""
    got = F.array_sort(F.collect_set(q(label)))
    row = df.agg(got.alias("got"))
    exp = F.array(*[F.lit(c) for c in expected])
    return _checks(row, [("classes_match", F.size("got"), F.col("got") == exp)])


def check_prediction_domain(df: DataFrame, col: str, labels: Sequence) -> DataFrame:
    """Predictions outside the label set."""
    row = df.agg(F.count_if(~q(col).isin(list(labels)) | q(col).isNull()).alias("n"))
    return _checks(row, [("predictions_outside_labels", F.col("n"), F.col("n") == 0)])


def check_proba(df: DataFrame, cols: Sequence[str], tol: float = PROBA_TOLERANCE) -> DataFrame:
    """Each probability in [0, 1] and each row sums to 1."""
    out = F.lit(False)
    for c in cols:
        out = out | (q(c) < 0) | (q(c) > 1) | q(c).isNull()
    total = sum((q(c) for c in cols), F.lit(0.0))
    row = df.agg(F.count_if(out).alias("range"), F.count_if(F.abs(total - 1.0) > tol).alias("sum"))
    return _checks(row, [("proba_out_of_range", F.col("range"), F.col("range") == 0),
                         ("proba_sum_not_one", F.col("sum"), F.col("sum") == 0)])


def check_results(df: DataFrame, required: Sequence[str] = ("Model", "Test Accuracy", "Test F1"),
                  accuracy_col: str = "Test Accuracy", min_accuracy: float = MIN_ACCURACY) -> DataFrame:
    """Required columns present, table non-empty, accuracy in [0,1] and above the floor."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        row = df.sparkSession.range(1)
        return _checks(row, [("missing_columns", F.lit(len(missing)), F.lit(False))])
    a = q(accuracy_col)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(a).alias("lo"), F.max(a).alias("hi"))
    return _checks(row, [("rows", F.col("n"), F.col("n") > 0),
                         ("min_accuracy", F.col("lo"), (F.col("lo") >= 0) & (F.col("lo") > min_accuracy)),
                         ("max_accuracy", F.col("hi"), F.col("hi") <= 1)])
