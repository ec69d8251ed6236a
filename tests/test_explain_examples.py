"""Every class's example is explained, for the class predicted for it."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import explain
from cohortlens.plans import q_explain


@pytest.fixture(scope="module")
def fitted(spark):
    class Forest:  # predicts what the row says
        def transform(self, df):
            return df

    test = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 0.0), (3, 1.0, 2.0), (4, 2.0, 2.0), (5, 1.0, 2.0)],
                                 "id long, label double, prediction double")
    attr = spark.createDataFrame(
        [(r, c, f"f{i:02d}", 1.0, (i - 8) * 0.01 * (r + k)) for r in range(1, 6) for k, c in enumerate(q_explain.CLASSES)
         for i in range(20)], "row_id long, class string, feature string, value double, phi double")
    return Forest(), test, attr, {c: 0.1 * (k + 1) for k, c in enumerate(q_explain.CLASSES)}


def test_all_classes_are_explained(spark, fitted, monkeypatch):
    monkeypatch.setattr(q_explain, "fitted_attributions", lambda spark, sf: fitted)
    _, _, attr, base = fitted
    names = q_explain.CLASSES
    want = {(2, names[0]), (3, names[2]), (4, names[2])}  # no row of the second class is predicted right
    steps = q_explain.q_attribution_decompose(spark, "").collect()
    assert {(r["row_id"], r["class"]) for r in steps} == want
    force = q_explain.q_attribution_force(spark, "").collect()
    assert {(r["row_id"], r["class"]) for r in force} == want
    for row, cls in want:
        one = [tuple(r) for r in steps if (r["row_id"], r["class"]) == (row, cls)]
        alone = [tuple(r) for r in explain.decompose(attr, row, cls, 15, base[cls]).collect()]
        assert sorted(x[:4] for x in one) == sorted(x[:4] for x in alone)
        assert sorted(x[5] for x in one) == pytest.approx(sorted(x[5] for x in alone))
        total = attr.where((F.col("row_id") == row) & (F.col("class") == cls)).agg(F.sum("phi")).first()[0]
        assert sum(r["total"] for r in force if (r["row_id"], r["class"]) == (row, cls)) == pytest.approx(total)


def test_summary_quantiles_are_exact_from_bounded_sketches(spark):
    import random

    rng = random.Random(5)
    values = {(c, f): [rng.gauss(0, 1) if f == "x" else float(rng.randrange(4)) for _ in range(n)] + [None]
              for c, n in (("A", 3001), ("B", 7)) for f in ("x", "y")}
    attr = spark.createDataFrame([(i, c, f, 0.0, v) for (c, f), vs in values.items() for i, v in enumerate(vs)],
                                 "row_id long, class string, feature string, value double, phi double")
    got = {(r["class"], r["feature"]): r for r in explain.distribution_summary(attr, 2, accuracy=20).collect()}
    assert set(got) == set(values)
    for key, vs in values.items():
        own = sorted(v for v in vs if v is not None)
        want = [own[-(-len(own) * p // 100) - 1] for p in (25, 50, 75)]
        assert [got[key][f"phi_q{p}"] for p in (25, 50, 75)] == want
        assert (got[key]["rows"], got[key]["phi_min"], got[key]["phi_max"]) == (len(vs), own[0], own[-1])
