"""Evaluation and ranking.

Every classification metric is derived from one count table
`(keys..., label, prediction, n)`: a grouped aggregate with map-side
partial counts, so the shuffle is a few rows per map task whatever the
table size. ROC curves pre-aggregate per distinct score before any
window runs, and each window is partitioned by (model, class).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.operators.eda import inner_cuts
from cohortlens.operators.profile import q

# distinct scores that one range of an ROC curve may hold, and the most ranges (their bounds go to every task: 512 kB)
RANGE_ROWS = 1_000_000
MAX_RANGES = 65_536


def _keys(keys: Sequence[str] | str | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def confusion_counts(preds: DataFrame, keys=("model",), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """(keys, label, prediction, n): the table all metrics come from."""
    keys = _keys(keys)
    return preds.groupBy(*[q(k) for k in keys], q(label).alias("label"),
                         q(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(preds: DataFrame, keys=("model",), label="label", prediction="prediction") -> DataFrame:
    """Share of rows with prediction == label."""
    keys = _keys(keys)
    return preds.groupBy(*keys).agg(
        F.avg(F.when(q(label) == q(prediction), 1.0).otherwise(0.0)).alias("accuracy"))


def per_class(preds: DataFrame, keys=("model",), label="label", prediction="prediction",
              counts: DataFrame | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class (0 where undefined).

    Classes are the union of true and predicted labels, as in the
    reference's metric library.
    """
    keys = _keys(keys)
    c = counts if counts is not None else confusion_counts(preds, keys, label, prediction)
    by_true = c.groupBy(*keys, F.col("label").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = c.groupBy(*keys, F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    j = by_true.join(by_pred, keys + ["class"], "full_outer").na.fill(0, ["support", "tp", "predicted"])
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    j = j.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return j.select(*keys, "class", "precision", "recall", f1.alias("f1"), "support")


def weighted_f1(preds: DataFrame, keys=("model",), label="label", prediction="prediction") -> DataFrame:
    """Support-weighted F1."""
    keys = _keys(keys)
    pc = per_class(preds, keys, label, prediction)
    return pc.groupBy(*keys).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def classification_report(preds: DataFrame, keys=("model",), label="label",
                          prediction="prediction") -> DataFrame:
    """Per-class rows plus `accuracy`, `macro avg` and `weighted avg`."""
    keys = _keys(keys)
    pc = per_class(preds, keys, label, prediction).withColumn("class", F.col("class").cast("string"))
    total = F.sum("support")
    macro = pc.groupBy(*keys).agg(
        F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support"))
    weighted = pc.groupBy(*keys).agg(
        F.lit("weighted avg").alias("class"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"), total.alias("support"))
    acc = pc.groupBy(*keys).agg(
        F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        (F.sum(F.when(F.col("support") > 0, F.col("recall") * F.col("support")).otherwise(0.0)) / total)
        .alias("f1"), total.alias("support"))
    return pc.unionByName(acc).unionByName(macro).unionByName(weighted)


def confusion_matrix(preds: DataFrame, labels: Sequence, keys=("model",), label="label",
                     prediction="prediction") -> DataFrame:
    """One row per (keys, true label) and one column per predicted
    label, zeros included. Label rows absent from the data are added per
    key group by exploding the (given, K-long) label list."""
    keys = _keys(keys)
    names = [str(v) for v in labels]
    c = confusion_counts(preds, keys, label, prediction)
    wide = c.groupBy(*keys, "label").pivot("prediction", list(labels)).agg(F.sum("n"))
    frame = c.select(*keys).distinct().select(*keys, F.explode(F.array(*[F.lit(v) for v in labels])).alias("label"))
    out = frame.join(wide, keys + ["label"], "left").na.fill(0, names)
    return out.select(*keys, "label", *[F.col(f"`{n}`").cast("long").alias(n) for n in names])


def mse(preds: DataFrame, target: str, value: str, keys=("model",)) -> DataFrame:
    """Mean squared error of a numeric prediction."""
    keys = _keys(keys)
    d = q(value).cast("double") - q(target).cast("double")
    return preds.groupBy(*keys).agg(F.avg(d * d).alias("mse"))


def binarize(preds: DataFrame, labels: Sequence, label: str = "label", id_cols=("row_id",),
             keys=("model",), score_cols: dict | None = None) -> DataFrame:
    """One-vs-rest indicators (keys, ids, class, y[, score]) by exploding the classes."""
    keys, ids = _keys(keys), list(id_cols)
    entries = []
    for v in labels:
        fields = [F.lit(v).alias("class"), (q(label) == F.lit(v)).cast("int").alias("y")]
        if score_cols:
            fields.append(q(score_cols[v]).cast("double").alias("score"))
        entries.append(F.struct(*fields))
    return preds.select(*keys, *ids, F.inline(F.array(*entries)))


def _score_ranges(agg: DataFrame, col: str, buckets: int, accuracy: int = 1_000, target: int = RANGE_ROWS) -> DataFrame:
    """Order-preserving range index of `col` (Bucketizer = binary search on the
    JVM) from global approximate quantiles; only balance depends on them. The
    number of ranges grows with the rows (distinct scores): a quarter more
    than rows / `target`, at least `buckets`, with quantiles as fine as that needs."""
    from pyspark.ml.feature import Bucketizer

    def quantiles(n: int) -> tuple:
        grid = [i / n for i in range(1, n)]
        return agg.agg(F.count(F.lit(1)), F.percentile_approx(F.col(col), grid, max(accuracy, 4 * n))).first()

    rows, cuts = quantiles(buckets)
    wanted = min(math.ceil(1.25 * rows / target), MAX_RANGES)
    if wanted > buckets:
        rows, cuts = quantiles(wanted)
    splits = [float("-inf"), *(sorted(inner_cuts(cuts)) or [0.0]), float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol="__b", handleInvalid="keep").transform(agg)


def roc_curve(binarized: DataFrame, keys=("model",), drop_intermediate: bool = True,
              score_bins: int | None = None, buckets: int = 256) -> DataFrame:
    """ROC points per (keys, class); tied scores share one point.

    Rows are first reduced to (keys, class, score) with positive and
    negative counts. Running counts over the distinct scores (descending)
    are computed in two levels so no (keys, class) is ever sorted in one
    task: scores are cut into order-preserving ranges, a small per-range
    summary gives each range's offsets, and windows run per
    (keys, class, range). Neighbour values for `drop_intermediate` (drop
    points whose second differences in fps and tps are both zero) cross
    range borders through the same summary. The origin point has a NULL
    threshold. `score_bins` floors scores to a grid first (optional).
    """
    keys = _keys(keys)
    part = keys + ["class"]
    score = F.col("score")
    if score_bins:
        score = F.floor(score * score_bins) / score_bins
    agg = binarized.groupBy(*part, score.alias("threshold")).agg(
        F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    ranged = _score_ranges(agg, "threshold", buckets)
    summary = ranged.groupBy(*part, "__b").agg(
        F.sum("pos").alias("bp"), F.sum("neg").alias("bn"), F.count(F.lit(1)).alias("bc"),
        F.max_by("pos", "threshold").alias("fp"), F.max_by("neg", "threshold").alias("fn"))
    wb = Window.partitionBy(*part).orderBy(F.desc("__b"))
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    summary = summary.select(
        *part, "__b",
        F.coalesce(F.sum("bp").over(before), F.lit(0)).alias("offp"),
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("offn"),
        F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("offc"),
        F.lead("fp").over(wb).alias("nfp"), F.lead("fn").over(wb).alias("nfn"),
        F.sum("bp").over(whole).alias("P"), F.sum("bn").over(whole).alias("N"))
    wr = Window.partitionBy(*part, "__b").orderBy(F.desc("threshold"))
    run = wr.rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.join(summary, part + ["__b"]).select(
        *part, "__b", "threshold", "pos", "neg", "offc", "nfp", "nfn", "P", "N",
        (F.col("offp") + F.sum("pos").over(run)).alias("tps"),
        (F.col("offn") + F.sum("neg").over(run)).alias("fps"),
        F.row_number().over(wr).alias("__li"))
    if drop_intermediate:
        first = F.col("__li") == 1
        prev_t = F.when(first, F.when(F.col("offc") > 0, F.col("tps") - F.col("pos"))).otherwise(
            F.lag("tps").over(wr))
        prev_f = F.when(first, F.when(F.col("offc") > 0, F.col("fps") - F.col("neg"))).otherwise(
            F.lag("fps").over(wr))
        nxt_t = F.coalesce(F.lead("tps").over(wr), F.col("tps") + F.col("nfp"))
        nxt_f = F.coalesce(F.lead("fps").over(wr), F.col("fps") + F.col("nfn"))
        rows = rows.withColumn("__pt", prev_t).withColumn("__pf", prev_f) \
            .withColumn("__nt", nxt_t).withColumn("__nf", nxt_f)
        keep = (F.col("__pt").isNull() | F.col("__nt").isNull()
                | (F.col("__nf") - 2 * F.col("fps") + F.col("__pf") != 0)
                | (F.col("__nt") - 2 * F.col("tps") + F.col("__pt") != 0))
        rows = rows.where(keep)
    # point numbers: kept rows per range -> offsets -> local numbering
    kept = rows.groupBy(*part, "__b").agg(F.count(F.lit(1)).alias("kc"))
    kept = kept.select(*part, "__b", F.coalesce(F.sum("kc").over(before), F.lit(0)).alias("offk"))
    pts = rows.join(kept, part + ["__b"]).select(
        *part, "threshold", "tps", "fps", "P", "N",
        (F.col("offk") + F.row_number().over(wr)).cast("int").alias("point"))
    origin = summary.where(F.col("offc") == 0).select(
        *part, F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("tps"),
        F.lit(0).cast("long").alias("fps"), "P", "N", F.lit(0).alias("point"))
    allp = pts.unionByName(origin)
    return allp.select(*part, "threshold", F.try_divide(F.col("fps"), F.col("N")).alias("fpr"),
                       F.try_divide(F.col("tps"), F.col("P")).alias("tpr"), "point")


def auc_from_scores(binarized: DataFrame, keys=("model",)) -> DataFrame:
    """E09 without any window: over the full curve each distinct score adds
    the trapezoid neg/N * (2 tps - pos) / (2 P), where tps counts positives
    at or above it. Running counts come from `roc_curve`'s two-level plan."""
    return _auc_full(binarized, _keys(keys))


def _auc_full(binarized: DataFrame, keys) -> DataFrame:
    part = keys + ["class"]
    agg = binarized.groupBy(*part, F.col("score").alias("threshold")).agg(
        F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    ranged = _score_ranges(agg, "threshold", 256)
    summary = ranged.groupBy(*part, "__b").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    wb = Window.partitionBy(*part).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    summary = summary.select(*part, "__b", F.coalesce(F.sum("bp").over(wb), F.lit(0)).alias("offp"),
                             F.sum("bp").over(whole).alias("P"), F.sum("bn").over(whole).alias("N"))
    wr = Window.partitionBy(*part, "__b").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.join(summary, part + ["__b"]).withColumn("tps", F.col("offp") + F.sum("pos").over(wr))
    area = F.try_divide(F.col("neg") * (2 * F.col("tps") - F.col("pos")), 2.0 * F.col("N") * F.col("P"))
    return rows.groupBy(*part).agg(F.sum(area).alias("auc"))


def auc(roc: DataFrame, keys=("model",)) -> DataFrame:
    """E09 from an ROC point table (a window per curve; use
    `auc_from_scores` when the curve itself is unbounded)."""
    keys = _keys(keys)
    part = keys + ["class"]
    o = Window.partitionBy(*part).orderBy("point")
    area = (F.col("fpr") - F.lag("fpr").over(o)) * (F.col("tpr") + F.lag("tpr").over(o)) / 2
    return roc.withColumn("__a", area).groupBy(*part).agg(F.sum("__a").alias("auc"))


def results_table(preds: DataFrame, keys=("model",), label="label", prediction="prediction",
                  cv: DataFrame | None = None, cv_col: str = "cv_f1") -> DataFrame:
    """One row per key group with test accuracy and
    weighted F1, left-joined to cross-validated scores (NULL when absent)."""
    keys = _keys(keys)
    acc = accuracy(preds, keys, label, prediction)
    f1 = weighted_f1(preds, keys, label, prediction)
    out = acc.join(f1, keys)
    if cv is not None:
        out = out.join(cv.select(*keys, F.col(cv_col).alias("cv_f1")), keys, "left")
    else:
        out = out.withColumn("cv_f1", F.lit(None).cast("double"))
    return out.select(*keys, "cv_f1", F.col("accuracy").alias("test_accuracy"),
                      F.col("weighted_f1").alias("test_f1"))


def union_results(*tables: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Concatenate result tables on a common column projection."""
    columns = list(columns) if columns is not None else tables[0].columns
    out = tables[0].select(*columns)
    for t in tables[1:]:
        out = out.unionByName(t.select(*columns), allowMissingColumns=False)
    return out


def rank_models(results: DataFrame, metric: str = "test_f1", key: str = "model") -> DataFrame:
    """Rank 1 = best metric (ties by name). A global window, used on
    result tables only (one row per model)."""
    return results.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc_nulls_last(metric), key)))


def best_model(results: DataFrame, metric: str = "cv_f1", key: str = "model") -> DataFrame:
    """The row with the highest metric (ties by name)."""
    ranked = rank_models(results, metric, key)
    return ranked.where(F.col("rank") == 1).drop("rank")
