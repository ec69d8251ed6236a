"""Period-over-period feature engineering.

Every feature is a native column expression; `engineer_features` adds
all nine in one projection, so the whole step is a single codegen stage
with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import rate, right_closed_bins

# fixed values: age bins (right-closed) and their labels
AGE_EDGES = [0, 20, 25, 30, 100]
AGE_LABELS = [0, 1, 2, 3]

ENGINEERED = [
    "total_approved", "total_enrolled", "approval_rate", "avg_grade", "grade_improvement",
    "approval_improvement", "total_credited", "total_without_eval", "age_group",
]


@dataclass(frozen=True)
class PeriodColumns:
    """Names of the two-period measures (period 1 and period 2)."""

    approved: tuple[str, str] = ("p1_approved", "p2_approved")
    enrolled: tuple[str, str] = ("p1_enrolled", "p2_enrolled")
    grade: tuple[str, str] = ("p1_grade", "p2_grade")
    credited: tuple[str, str] = ("p1_credited", "p2_credited")
    without_eval: tuple[str, str] = ("p1_without_eval", "p2_without_eval")


def add_total(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """a + b."""
    return df.withColumn(out, F.col(a) + F.col(b))


def add_rate(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """num/den when den > 0 else 0."""
    return df.withColumn(out, rate(num, den))


def add_mean(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """(a + b) / 2."""
    return df.withColumn(out, (F.col(a) + F.col(b)) / 2)


def add_delta(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """second - first."""
    return df.withColumn(out, F.col(second) - F.col(first))


def add_bins(df: DataFrame, col: str, edges=AGE_EDGES, labels=AGE_LABELS, out: str = "age_group") -> DataFrame:
    """right-closed bins; values outside the edges (or NULL) give NULL."""
    return df.withColumn(out, right_closed_bins(col, edges, labels))


def engineer_features(df: DataFrame, periods: PeriodColumns = PeriodColumns(),
                      age_col: str = "age") -> DataFrame:
    """Add the nine engineered columns in one projection."""
    a1, a2 = periods.approved
    e1, e2 = periods.enrolled
    g1, g2 = periods.grade
    c1, c2 = periods.credited
    w1, w2 = periods.without_eval
    total_approved = F.col(a1) + F.col(a2)
    total_enrolled = F.col(e1) + F.col(e2)
    return df.select(
        "*",
        total_approved.alias("total_approved"),
        total_enrolled.alias("total_enrolled"),
        F.when(total_enrolled > 0, total_approved / total_enrolled).otherwise(F.lit(0.0))
        .alias("approval_rate"),
        ((F.col(g1) + F.col(g2)) / 2).alias("avg_grade"),
        (F.col(g2) - F.col(g1)).alias("grade_improvement"),
        (F.col(a2) - F.col(a1)).alias("approval_improvement"),
        (F.col(c1) + F.col(c2)).alias("total_credited"),
        (F.col(w1) + F.col(w2)).alias("total_without_eval"),
        right_closed_bins(age_col, AGE_EDGES, AGE_LABELS).alias("age_group"),
    )


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """columns added by a step, in output order (schema only)."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]
