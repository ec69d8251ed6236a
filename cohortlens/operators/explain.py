"""Attribution summaries and helpers.

Tree attributions (X01) are computed by `treeshap.attributions`; the
summaries here are plain aggregates over its long table
(row_id, class, feature, value, phi).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.columns import safe_name  # noqa: F401  (X12, re-exported)
from cohortlens.operators.profile import q
from cohortlens.session import materialize

# fixed values of the reference's summaries
TOP_FEATURES = 5
DECOMPOSE_TOP = 15
EXAMPLE_CAP = 500
SKETCH_ACCURACY = 10_000


def cap_rows(df: DataFrame, n: int = EXAMPLE_CAP, id_col: str = "id") -> DataFrame:
    """X11: the first n rows by id (TakeOrderedAndProject; no full sort)."""
    return df.orderBy(q(id_col)).limit(n)


def pick_examples(preds: DataFrame, label: str = "label", prediction: str = "prediction",
                  id_col: str = "row_id", keys: Sequence[str] = ()) -> DataFrame:
    """Per class, the first correctly predicted row, else the first row."""
    keys = list(keys)
    return preds.groupBy(*keys, q(label).alias("class")).agg(
        F.coalesce(F.min(F.when(q(label) == q(prediction), q(id_col))), F.min(q(id_col))).alias("row_id"))


def mean_abs_by_class(attr: DataFrame) -> DataFrame:
    """Mean |phi| per (class, feature)."""
    return attr.groupBy("class", "feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))


def mean_abs_global(attr: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Mean over classes of the per-class mean |phi|, top n."""
    per = mean_abs_by_class(attr)
    return (per.groupBy("feature").agg(F.avg("mean_abs").alias("mean_abs"))
            .orderBy(F.desc("mean_abs"), "feature").limit(n))


def top_features(attr: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Top n features per class by mean |phi|, with rank."""
    per = mean_abs_by_class(attr)
    w = Window.partitionBy("class").orderBy(F.desc("mean_abs"), "feature")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def decompose(attr: DataFrame, row_id, cls, n: int = DECOMPOSE_TOP, base: float | None = None) -> DataFrame:
    """One prediction: top-n contributions by |phi|, the remainder as
    one row, and the running total (starting at the base value)."""
    one = attr.where((F.col("row_id") == row_id) & (F.col("class") == cls))
    w = Window.partitionBy("row_id", "class").orderBy(F.desc(F.abs("phi")), "feature")
    ranked = one.withColumn("rank", F.row_number().over(w))
    top = ranked.where(F.col("rank") <= n).select("row_id", "class", "rank", "feature", "phi")
    rest = (ranked.where(F.col("rank") > n).groupBy("row_id", "class")
            .agg(F.lit(n + 1).alias("rank"), F.lit("(other features)").alias("feature"), F.sum("phi").alias("phi")))
    out = top.unionByName(rest)
    run = Window.partitionBy("row_id", "class").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("cumulative", F.lit(base or 0.0) + F.sum("phi").over(run))


def force_split(attr: DataFrame, row_id, cls) -> DataFrame:
    """Positive and negative pushes of one prediction."""
    one = attr.where((F.col("row_id") == row_id) & (F.col("class") == cls))
    return one.groupBy(F.when(F.col("phi") >= 0, "positive").otherwise("negative").alias("direction")) \
        .agg(F.sum("phi").alias("total"), F.count(F.lit(1)).alias("features"))


def decompose_examples(attr: DataFrame, examples: DataFrame, bases: dict[str, float],
                       n: int = DECOMPOSE_TOP) -> DataFrame:
    """X07 for several predictions at once: `examples` (row_id, class) names
    the rows and the class explained for each, `bases` the base values."""
    chosen = attr.join(F.broadcast(examples.select("row_id", "class")), ["row_id", "class"])
    w = Window.partitionBy("row_id", "class").orderBy(F.desc(F.abs("phi")), "feature")
    ranked = chosen.withColumn("rank", F.row_number().over(w))
    top = ranked.where(F.col("rank") <= n).select("row_id", "class", "rank", "feature", "phi")
    rest = (ranked.where(F.col("rank") > n).groupBy("row_id", "class")
            .agg(F.lit(n + 1).alias("rank"), F.lit("(other features)").alias("feature"), F.sum("phi").alias("phi")))
    base = F.create_map(*[x for c, v in bases.items() for x in (F.lit(c), F.lit(v))])[F.col("class")]
    run = Window.partitionBy("row_id", "class").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return top.unionByName(rest).withColumn("cumulative", base + F.sum("phi").over(run))


def force_split_examples(attr: DataFrame, examples: DataFrame) -> DataFrame:
    """X08 for several predictions at once (see `decompose_examples`)."""
    chosen = attr.join(F.broadcast(examples.select("row_id", "class")), ["row_id", "class"])
    direction = F.when(F.col("phi") >= 0, "positive").otherwise("negative").alias("direction")
    return chosen.groupBy("row_id", "class", direction).agg(F.sum("phi").alias("total"),
                                                            F.count(F.lit(1)).alias("features"))


def dependence(attr: DataFrame, n: int = 3) -> DataFrame:
    """(value, phi) pairs of the top n features of each class."""
    tops = top_features(attr, n).select("class", "feature")
    return attr.join(F.broadcast(tops), ["class", "feature"]).select("class", "feature", "row_id", "value", "phi")


def distribution(attr: DataFrame, n: int = DECOMPOSE_TOP) -> DataFrame:
    """Per-row attributions with values for the top n features
    (by global mean |phi|); the broadcast side has n rows."""
    tops = mean_abs_global(attr, n).select("feature")
    return attr.join(F.broadcast(tops), "feature")


def distribution_summary(attr: DataFrame, n: int = DECOMPOSE_TOP, quantiles: Sequence[int] = (25, 50, 75),
                         accuracy: int = 10_000) -> DataFrame:
    """X10 where one row per (row, class, feature) is too much to draw: rows,
    least, greatest and quantiles (in percent) of phi per class for the top n
    features. The quantiles are exact (the least phi that a share of the rows
    does not exceed): sketches of bounded size, of `accuracy` and at most
    `SKETCH_ACCURACY`, give a narrow range for each, and a second pass counts
    the rows below the range and each value inside it."""
    attr = attr.join(F.broadcast(mean_abs_global(attr, n).select("feature")), "feature")
    bound = min(accuracy, SKETCH_ACCURACY)
    around = [F.percentile_approx("phi", [max(0.0, p / 100 - 2 / bound), min(1.0, p / 100 + 2 / bound)], bound) for p in quantiles]
    sketch = materialize(attr.groupBy("class", "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.count("phi").alias("__n"), F.min("phi").alias("phi_min"), F.max("phi").alias("phi_max"),
        *[r.alias(f"__r{i}") for i, r in enumerate(around)]))
    ranges = sketch.select(F.col("class").alias("__c"), F.col("feature").alias("__f"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("__i"), F.col(f"__r{i}")[0].alias("__lo"), F.col(f"__r{i}")[1].alias("__hi"),
                 F.ceil(F.col("__n") * (p / 100)).alias("__rank")) for i, p in enumerate(quantiles)])))
    # the value NULL stands for all rows below the range
    near = attr.join(F.broadcast(ranges), q("class").eqNullSafe(F.col("__c")) & (F.col("feature") == F.col("__f")) & (F.col("phi") <= F.col("__hi")))
    counts = near.groupBy("__c", "__f", "__i", "__rank", F.when(F.col("phi") >= F.col("__lo"), F.col("phi")).alias("__v")).agg(F.count(F.lit(1)).alias("__k"))
    run = F.sum("__k").over(Window.partitionBy("__c", "__f", "__i").orderBy(F.col("__v").asc_nulls_first()))
    cuts = counts.withColumn("__run", run).where(F.col("__run") >= F.col("__rank")).groupBy("__c", "__f").agg(
        *[F.min(F.when(F.col("__i") == i, F.col("__v"))).alias(f"phi_q{p}") for i, p in enumerate(quantiles)])
    out = sketch.join(F.broadcast(cuts), q("class").eqNullSafe(F.col("__c")) & (F.col("feature") == F.col("__f")), "left")
    return out.select("class", "feature", "rows", "phi_min", *[f"phi_q{p}" for p in quantiles], "phi_max")
