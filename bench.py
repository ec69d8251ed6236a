"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full plan is executed with the `noop` sink (every row and
column is produced, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "outcome_share_by_age_group",   # fixture joins + features + pivot
    "table_info",                   # one-pass profile
    "nunique_columns",              # exact distinct counts
    "grade_box_stats",              # grouped exact percentiles + whiskers
    "grade_density",                # KDE on a broadcast grid
    "key_corr_matrix",              # one-pass pair moments
    "stratified_split",             # bucketed exact stratified split
    "anova_f_scores",               # grouped moments -> F
    "rule_classification_report",   # count-table metrics
    "rule_roc_curve",               # pre-aggregated ROC windows
    "knn_predict_uniform",          # blocked exact neighbour join
    "smote_synthetic",              # same-class neighbours + interpolation
    "model_results",                # DT + LR + RF fits and evaluation
    "softmax_boost_results",        # custom boosting loop
    "tree_attributions",            # TreeSHAP over mapInPandas
    "score_batch",                  # full scoring pipeline
]


#: headline queries that start from the prepared train and test tables
MODEL_QUERIES = ["model_results", "softmax_boost_results"]


def baseline_fits(spark, sf_dir: str) -> dict:
    """
    train split, preprocessing), for a like-for-like comparison."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
    from cohortlens.operators import models
    from cohortlens.plans.q_models import prepared

    train, *_ = prepared(spark, sf_dir)
    fits = {
        "fit_logistic_default": LogisticRegression(featuresCol="features", labelCol="label"),
        "fit_tree_depth10": models.decision_tree(max_depth=10, max_bins=32),
        "fit_forest_100x10": models.random_forest(n_estimators=100, max_depth=10, seed=42, max_bins=32),
        "fit_ovr_gbt_10": OneVsRest(classifier=GBTClassifier(maxIter=10, featuresCol="features",
                                                             labelCol="label"), featuresCol="features",
                                    labelCol="label"),
    }
    out = {}
    for name, est in fits.items():
        t = time.time()
        est.fit(train)
        out[name] = round(time.time() - t, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("BENCH_CPUS", cpus)
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from cohortlens.session import get_session
    from cohortlens.plans.registry import all_queries

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    qs = all_queries()
    names = [n for n in HEADLINE if n in qs]
    only = os.environ.get("BENCH_QUERIES")
    if only:
        names = [n for n in only.split(",") if n in qs]
    # warm-up: JVM, codegen and Python workers (small data, not timed)
    qs["outcome_share_by_age_group"].run(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    if any(n in names for n in MODEL_QUERIES):
        # split, preprocessing and checkpoints that the model queries share
        from cohortlens.plans.q_models import prepared
        t = time.time()
        prepared(spark, sf_dir)
        times["prepare_models"] = round(time.time() - t, 3)
    for n in names:
        t = time.time()
        qs[n].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
    if not only:
        times.update(baseline_fits(spark, sf_dir))
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
