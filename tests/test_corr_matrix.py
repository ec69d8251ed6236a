"""Pairwise correlations from pattern sums against pandas."""

import math

import numpy as np
import pandas as pd
import pytest

from cohortlens.operators import eda

COLS = ["a", "b", "c", "d", "e"]
SCHEMA = ", ".join(f"{c} double" for c in COLS)


def matrix(spark, rows):
    return {(r["col_a"], r["col_b"]): r["corr"] for r in eda.corr_matrix(spark.createDataFrame(rows, SCHEMA), COLS).collect()}


def test_missing_offset_and_constant_columns(spark):
    r = np.random.default_rng(5)
    x = pd.DataFrame(r.normal(size=(400, 5)), columns=COLS)
    x["b"] = x["a"] * 2 + x["b"] + 1e9
    x["e"] = 0.1
    x = x.mask(r.random(x.shape) < 0.2)
    got = matrix(spark, [tuple(None if math.isnan(v) else v for v in row) for row in x.itertuples(index=False)])
    assert len(got) == 25
    for a in COLS:
        for b in COLS:
            if "e" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(x[a].corr(x[b]), abs=1e-6)


def test_pairs_without_rows_and_empty_tables(spark):
    got = matrix(spark, [(1.0, None, 3.0, float("nan"), 0.0), (2.0, None, 5.0, float("nan"), 0.0), (None, 1.0, None, None, 0.0)])
    assert got["a", "c"] == pytest.approx(1.0)
    assert got["a", "b"] is None and got["d", "d"] is None and got["e", "e"] is None
    empty = matrix(spark, [])
    assert len(empty) == 25 and set(empty.values()) == {None}
