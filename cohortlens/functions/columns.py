"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def present(x) -> Column:
    """A numeric column as double with NaN read as missing (NULL)."""
    v = _c(x).cast("double")
    return F.when(~F.isnan(v), v)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))


def rate(num, den, default: float = 0.0) -> Column:
    """num / den when den > 0 else `default` (F03). The guard is evaluated first."""
    return F.when(_c(den) > 0, _c(num) / _c(den)).otherwise(F.lit(default))


def half_even_class(pred, lo: int = 0, hi: int = 2) -> Column:
    """Regression output to class code (M06): round half to even, clip to [lo, hi]."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.bround(_c(pred), 0))).cast("int")


def right_closed_bins(x, edges: Sequence[float], labels: Sequence[int] | None = None) -> Column:
    """Right-closed binning (e1, e2], (e2, e3], ...; outside or NULL gives NULL."""
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (_c(x) > lo) & (_c(x) <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def safe_name(x, n: int = 30) -> Column:
    """`/` and space become `_`, first n characters, lower case."""
    return F.lower(F.substring(F.translate(_c(x), "/ ", "__"), 1, n))


def format_proba(label, p, digits: int = 1) -> Column:
    """`"Class: 12.3%"`."""
    return F.format_string(f"%s: %.{digits}f%%", _c(label), _c(p) * 100)


def hash_order_key(id_col, seed: int = 42) -> Column:
    """Deterministic pseudo-random order key: md5 of `id|seed` (hex text).

    Sorting by the hex text equals sorting by the 128-bit number, and the
    same key is computable in any SQL engine with md5.
    """
    return F.md5(F.concat(_c(id_col).cast("string"), F.lit(f"|{seed}")))


def rounded(x, digits: int = 6) -> Column:
    return F.round(_c(x), digits)
