"""Exploratory aggregates: the data behind every chart.

Design rules used throughout:
* one pass per statistic family: all columns in the same `agg`;
* per-class work is a `groupBy` with map-side partial aggregation, so a
  class holding a third of the rows is still combined in every map task
  before the shuffle;
* small statistics (per-class counts, min/max) enter later stages as
  scalar subqueries or as a broadcast side whose size is checked.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.columns import present
from cohortlens.operators.profile import q
from cohortlens.session import materialize

# fixed values: box-plot whisker factor, histogram bins, KDE grid, KDE support cut
WHISKER_IQR = 1.5
HIST_BINS = 20
KDE_POINTS = 100
KDE_CUT = 2.0
MAX_PIVOT_VALUES = 10_000


def _values(df: DataFrame, col: str, limit: int = MAX_PIVOT_VALUES) -> list:
    """Sorted distinct values of a low-cardinality column (a statistics pass).

    Refuses more than `limit` values so a wide pivot cannot be requested
    by accident.
    """
    rows = df.select(q(col)).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values; pass `values`")
    return sorted((r[0] for r in rows), key=lambda v: (v is None, v))


def inner_cuts(quantiles: Sequence[float | None] | None) -> set[float]:
    """Range bounds from approximate quantiles. A value that several quantiles
    hit is common: it gets a range of its own, up to the next double."""
    found = [float(x) for x in quantiles or [] if x is not None and x == x]
    common = {x for x, n in Counter(found).items() if n > 1}
    return {x for x in {*found, *(math.nextafter(x, math.inf) for x in common)} if math.isfinite(x)}


def _recut(df: DataFrame, cols: Sequence[str], splits: list[list[float]], located, buckets: int, accuracy: int,
           target: int) -> list[list[float]] | None:
    """Cuts the located ranges that hold more than `target` rows again, by the
    quantiles of their own rows; None when no range is left to cut.
    `located(splits)` gives the located (column, __b, __n) ranges."""
    crowded = (located(splits).groupBy("column", "__b").agg(F.sum("__n").alias("__n"))
               .where(F.col("__n") > target).select("column", "__b").collect())  # at most a row for each range
    # a range of one double is done: its rows are one distinct value
    open_ = [(cols.index(r["column"]), r["__b"]) for r in crowded]
    open_ = [(i, b) for i, b in open_ if splits[i][b + 1] > math.nextafter(splits[i][b], math.inf)]
    if not open_:
        return None
    grid = [k / buckets for k in range(1, buckets)]
    aggs = []
    for n, (i, b) in enumerate(open_):
        x = present(q(cols[i]))
        aggs.append(F.percentile_approx(F.when((x >= splits[i][b]) & (x < splits[i][b + 1]), x), grid, accuracy).alias(f"__q{n}"))
    cuts = df.agg(*aggs).first()
    out = [set(s) for s in splits]
    for n, (i, b) in enumerate(open_):
        out[i] |= inner_cuts(cuts[f"__q{n}"])
    new = [sorted(s) for s in out]
    return None if [len(s) for s in new] == [len(s) for s in splits] else new


def exact_percentiles(df: DataFrame, by: str, cols: Sequence[str], probs: Sequence[float],
                      buckets: int = 256, accuracy: int = 1_000, target: int = 1_000_000) -> DataFrame:
    """Exact percentiles (linear interpolation) per class and column without
    gathering a class's values in one task.

      1. global approximate quantiles give `buckets` value ranges per column
         (bounded statistics);
      2. rows are counted per (class, column, range) - partial aggregation,
         a tiny shuffle;
      3. a running sum over the ranges finds, for every needed rank, its
         range and the rank inside it; where a range can hold more than
         `target` distinct values (never below `target` / 0.006 rows), the
         crowded located ranges are cut again by their own quantiles until
         each is below `target` rows or one value;
      4. only rows of those ranges are read again, reduced to distinct
         (value, count) and ranked there.
    Returns (by, column, p, value).
    """
    from pyspark.ml.feature import Bucketizer

    cols, probs = list(cols), [float(x) for x in probs]
    grid = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.percentile_approx(present(q(c)), grid, accuracy).alias(f"__s{i}") for i, c in enumerate(cols)]).first()
    splits = [[float("-inf"), *(sorted(inner_cuts(cuts[f"__s{i}"])) or [0.0]), float("inf")] for i in range(len(cols))]
    # the class inside a struct: its joins then also match rows without a class
    base = df.select(F.struct(q(by).alias("v")).alias("__by"),
                     *[present(q(c)).alias(f"__v{i}") for i, c in enumerate(cols)])

    def cells(splits: list[list[float]]) -> DataFrame:
        # value ranges by binary search on the JVM (Bucketizer), one index column per input column
        based = Bucketizer(splitsArray=splits, inputCols=[f"__v{i}" for i in range(len(cols))],
                           outputCols=[f"__r{i}" for i in range(len(cols))], handleInvalid="keep").transform(base)
        return based.select("__by", F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"__v{i}").alias("v"), F.col(f"__r{i}").cast("int").alias("__b"))
            for i, c in enumerate(cols)]))).where(F.col("v").isNotNull())

    def locate(splits: list[list[float]]) -> DataFrame:
        counts = cells(splits).groupBy("__by", "column", "__b").agg(F.count(F.lit(1)).alias("__n"))
        w = Window.partitionBy("__by", "column").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
        cum = counts.withColumn("__cum", F.sum("__n").over(w)).withColumn(
            "__tot", F.sum("__n").over(Window.partitionBy("__by", "column")))
        # ranks needed for each p: floor and ceil of (n - 1) * p (0-based)
        pos = F.explode(F.array(*[F.struct(F.lit(i).alias("pi"), F.lit(p).alias("p")) for i, p in enumerate(probs)]))
        need = cum.select("__by", "column", "__tot").distinct().select("*", pos.alias("__pp")).select(
            "__by", "column", "__tot", F.col("__pp.pi").alias("pi"), F.col("__pp.p").alias("p"),
            ((F.col("__tot") - 1) * F.col("__pp.p")).alias("h"))
        need = need.select("*", F.explode(F.array(F.floor("h").cast("long"), F.ceil("h").cast("long"))).alias("rank"))
        return need.join(cum, ["__by", "column", "__tot"]).where(
            (F.col("rank") < F.col("__cum")) & (F.col("rank") >= F.col("__cum") - F.col("__n"))) \
            .select("__by", "column", "pi", "p", "h", "rank", "__b", "__n",
                    (F.col("rank") - F.col("__cum") + F.col("__n")).alias("local"))

    # between two neighbouring quantiles lie 1/buckets of the rows and twice the quantiles' error at most
    if cuts["__rows"] * (1 / buckets + 2 / accuracy) > target:
        ranges = lambda at: locate(at).select("__by", "column", "__b", "__n").distinct()
        while (finer := _recut(df, cols, splits, ranges, buckets, accuracy, target)) is not None:
            splits = finer
    keyed, located = cells(splits), locate(splits).drop("__n")
    targets = located.select("__by", "column", "__b").distinct()
    vals = (keyed.join(targets, ["__by", "column", "__b"], "left_semi")
            .groupBy("__by", "column", "__b", "v").agg(F.count(F.lit(1)).alias("c")))
    vw = Window.partitionBy("__by", "column", "__b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    vals = vals.withColumn("__hi", F.sum("c").over(vw)).withColumn("__lo", F.col("__hi") - F.col("c"))
    picked = located.join(vals, ["__by", "column", "__b"]).where(
        (F.col("local") >= F.col("__lo")) & (F.col("local") < F.col("__hi")))
    out = picked.groupBy("__by", "column", "pi", "p", "h").agg(
        F.min_by("v", "rank").alias("v_lo"), F.max_by("v", "rank").alias("v_hi"))
    value = F.col("v_lo") + (F.col("h") - F.floor("h")) * (F.col("v_hi") - F.col("v_lo"))
    return out.select(F.col("__by.v").alias(by), "column", "p", value.alias("value"))


def box_stats(df: DataFrame, by: str, cols: Sequence[str], approx: bool = False,
              accuracy: int = 10_000) -> DataFrame:
    """Per class and column q1, median, q3 (linear interpolation),
    whiskers (most extreme data inside 1.5 IQR) and outlier count.

    Pass 1: exact quartiles by bucketed rank selection
    (`exact_percentiles`; no class is gathered in one task), or bounded
    sketches with `approx=True`. The per-class quartiles (one row per
    class) are kept; pass 2 joins the fences back and whiskers and outliers
    are one more grouped aggregate. NULL and NaN values take no part; rows
    without a class form a class of their own.
    """
    cols = list(cols)
    if approx:
        stats = df.groupBy(q(by).alias("__by")).agg(*[
            F.percentile_approx(present(q(c)), [0.25, 0.5, 0.75], accuracy).alias(f"__p{i}")
            for i, c in enumerate(cols)])
    else:
        ex = exact_percentiles(df, by, cols, [0.25, 0.5, 0.75]).withColumnRenamed(by, "__by")
        idx = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
        stats = (ex.withColumn("__i", idx[F.col("column")]).groupBy("__by").pivot("__i", list(range(len(cols))))
                 .agg(F.array_sort(F.collect_list(F.struct("p", "value"))).alias("a")))
        stats = stats.select("__by", *[F.transform(F.col(f"`{i}`"), lambda s_: s_["value"]).alias(f"__p{i}")
                                       for i in range(len(cols))])
    # one row per class, kept so that the fences and the final join reuse it
    stats = materialize(stats)
    fences = stats.select("__by", *[
        x for i in range(len(cols)) for x in (
            (F.col(f"__p{i}")[0] - WHISKER_IQR * (F.col(f"__p{i}")[2] - F.col(f"__p{i}")[0]))
            .alias(f"__lo{i}"),
            (F.col(f"__p{i}")[2] + WHISKER_IQR * (F.col(f"__p{i}")[2] - F.col(f"__p{i}")[0]))
            .alias(f"__hi{i}"))])
    joined = df.select(q(by).alias("__by"), *[present(q(c)).alias(f"__x{i}")
                                                for i, c in enumerate(cols)]) \
        .join(fences.withColumnRenamed("__by", "__fby"), F.col("__by").eqNullSafe(F.col("__fby")))
    aggs = []
    for i in range(len(cols)):
        x, lo, hi = F.col(f"__x{i}"), F.col(f"__lo{i}"), F.col(f"__hi{i}")
        inside = (x >= lo) & (x <= hi)
        aggs += [F.min(F.when(inside, x)).alias(f"__wl{i}"),
                 F.max(F.when(inside, x)).alias(f"__wh{i}"),
                 F.count_if((x < lo) | (x > hi)).alias(f"__o{i}"),
                 F.count(x).alias(f"__n{i}")]
    whisk = joined.groupBy("__by").agg(*aggs).join(stats.withColumnRenamed("__by", "__sby"),
                                                   F.col("__by").eqNullSafe(F.col("__sby")))
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"),
        F.col(f"__p{i}")[0].alias("q1"), F.col(f"__p{i}")[1].alias("median"),
        F.col(f"__p{i}")[2].alias("q3"),
        F.col(f"__wl{i}").alias("whisker_lo"), F.col(f"__wh{i}").alias("whisker_hi"),
        F.col(f"__o{i}").alias("outliers"), F.col(f"__n{i}").alias("n"))
        for i, c in enumerate(cols)])
    return whisk.select(F.col("__by").alias(by), F.inline(entries))


def histogram(df: DataFrame, col: str, by: str | None = None, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over the common min..max, last bin closed.

    min and max are scalar subqueries (computed once, broadcast as
    literals); the bin index is a native expression and the counts one
    grouped aggregate.
    """
    x = present(q(col))
    # one scalar subquery (computed once, reused by every reference)
    bounds = df.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    keys = ([q(by).alias(by)] if by else []) + [idx.alias("bin")]
    out = (df.where(x.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
           .withColumn("bin_lo", lo + F.col("bin") * width)
           .withColumn("bin_hi", F.when(F.col("bin") == bins - 1, hi)
                       .otherwise(lo + (F.col("bin") + 1) * width)))
    return out


def crosstab(df: DataFrame, rows: Sequence[str] | str, col: str, normalize: str | None = None,
             values: Sequence | None = None) -> DataFrame:
    """Counts of `rows` x `col`, zeros filled; `normalize='index'`
    gives row percentages (x100).

    `groupBy(rows).pivot(col, values)` compiles to one aggregation with
    map-side partial counts; explicit values avoid the extra distinct job.
    """
    rows = [rows] if isinstance(rows, str) else list(rows)
    values = list(values) if values is not None else _values(df, col)
    ct = (df.groupBy(*[q(r).alias(r) for r in rows]).pivot(col, values)
          .agg(F.count(F.lit(1))).na.fill(0, subset=[str(v) for v in values]))
    names = [str(v) for v in values]
    if normalize == "index":
        total = sum((F.col(f"`{n}`") for n in names), F.lit(0))
        ct = ct.select(*rows, *[(F.col(f"`{n}`") * 100.0 / total).alias(n) for n in names])
    elif normalize is not None:
        raise ValueError("normalize must be None or 'index'")
    return ct


def kde(df: DataFrame, col: str, by: str, points: int = KDE_POINTS, cut: float = KDE_CUT,
        bw_adjust: float = 1.0, bins_per_bandwidth: int | None = None) -> DataFrame:
    """Gaussian density per class on a grid (violin data).

    Bandwidth is Scott's rule: n^(-1/5) * sample std. The grid spans
    min - cut*bw .. max + cut*bw with `points` points per class.

    Plan: a statistics pass gives per-class n, std, min and max (one row
    per class). That table is joined back (Spark picks the join from its
    size) and all `points` kernel sums are accumulated in one grouped
    aggregate: no row expansion, and only classes x points partial sums per
    map task are shuffled. NULL and NaN values take no part.

    With `bins_per_bandwidth` (s) the rows are first shared out between the
    two nearest points of a fine grid of step bandwidth / s (linear binning),
    one narrow aggregate over the rows; the `points` kernel sums then run over
    the occupied grid points of each class only, a discrete convolution. A row
    so enters with the kernel's linear interpolation between two grid points,
    so that no density is off by more than `kde_error_bound`: the kernel's
    second derivative is at most its peak, 1 / (bandwidth sqrt(2 pi)), over
    bandwidth squared, and an interpolation errs by step^2 / 8 of that.
    """
    x = present(q(col))
    if bins_per_bandwidth is not None and bins_per_bandwidth < 1:
        raise ValueError("bins_per_bandwidth must be at least 1")
    stats = (df.where(x.isNotNull()).groupBy(q(by).alias("__gby"))
             .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(x).alias("sd"),
                  F.min(x).alias("lo"), F.max(x).alias("hi")))
    bw = F.coalesce("sd", F.lit(0.0)) * F.pow("n", F.lit(-0.2)) * F.lit(float(bw_adjust))
    steps = float(points - 1) if points > 1 else None
    grid = stats.withColumn("bw", bw).select(
        "__gby", (F.col("lo") - cut * F.col("bw")).alias("g0"),
        ((F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / steps if steps else F.lit(0.0)).alias("gs"), "bw", "n", "lo")
    rows = df.where(x.isNotNull()).select(q(by).alias("__by"), x.alias("__x")).join(
        grid, F.col("__by").eqNullSafe(F.col("__gby")))
    weight = F.lit(1.0)
    if bins_per_bandwidth is not None:
        step = F.col("bw") / bins_per_bandwidth
        at = F.try_divide(F.col("__x") - F.col("lo"), step)  # NULL for a zero bandwidth, as the density is
        bins = rows.withColumn("__at", at).groupBy("__by", "g0", "gs", "bw", "n", "lo", F.floor("__at").alias("__bin")).agg(
            F.sum(1 - (F.col("__at") - F.floor("__at"))).alias("__left"), F.sum(F.col("__at") - F.floor("__at")).alias("__right"))
        ends = F.inline(F.array(F.struct(F.col("__bin").alias("__bin"), F.col("__left").alias("__w")),
                                F.struct((F.col("__bin") + 1).alias("__bin"), F.col("__right").alias("__w"))))
        rows = (bins.select("__by", "g0", "gs", "bw", "n", "lo", ends)
                .select("*", (F.col("lo") + F.col("__bin") * step).alias("__x")))
        weight = F.col("__w")
    sums = []
    for i in range(points):
        # a zero bandwidth (constant or one-row class) gives NULL densities, not an ANSI error
        z = F.try_divide(F.col("g0") + F.lit(i) * F.col("gs") - F.col("__x"), F.col("bw"))
        sums.append(F.sum(weight * F.exp(-0.5 * z * z)).alias(f"__s{i}"))
    agg = rows.groupBy("__by", "g0", "gs", "bw", "n").agg(*sums)
    norm = F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)
    entries = F.array(*[F.struct(F.lit(i).alias("point"), (F.col("g0") + F.lit(i) * F.col("gs")).alias("x"),
                                 F.try_divide(F.col(f"__s{i}"), norm).alias("density")) for i in range(points)])
    return agg.select(F.col("__by").alias(by), F.inline(entries))


def kde_error_bound(bandwidth: Column, bins_per_bandwidth: int) -> Column:
    """The most that a binned density differs from the exact one."""
    return 1.0 / (8 * bins_per_bandwidth**2 * math.sqrt(2 * math.pi)) / bandwidth


def scatter(df: DataFrame, x: str, y: str, by: str, id_col: str | None = None,
            bins: int | None = None) -> DataFrame:
    """Per-class (x, y) points; with `bins`, 2-D bin counts instead
    (bounded output for tables of any size)."""
    if bins is None:
        keep = ([q(id_col).alias(id_col)] if id_col else []) + [
            q(by).alias(by), q(x).alias(x), q(y).alias(y)]
        return df.where(q(x).isNotNull() & q(y).isNotNull()).select(*keep)
    xs, ys = present(q(x)), present(q(y))
    b4 = df.select(F.struct(F.min(xs).alias("a"), F.max(xs).alias("b"), F.min(ys).alias("c"),
                            F.max(ys).alias("d"))).scalar()
    xlo, xhi, ylo, yhi = (b4.getField(f) for f in "abcd")

    def b(v, lo, hi):
        return F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((v - lo) * bins / (hi - lo)), F.lit(bins - 1))).cast("int")

    return (df.where(xs.isNotNull() & ys.isNotNull())
            .groupBy(q(by).alias(by), b(xs, xlo, xhi).alias("x_bin"), b(ys, ylo, yhi).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("count")))


def compare_counts(frames: dict[str, DataFrame], col: str) -> DataFrame:
    """Value counts of `col` per named frame (stage), long form."""
    parts = [f.groupBy(q(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
             .withColumn("stage", F.lit(name)) for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("stage", "value", "count")


def _pearson(x: Column, y: Column) -> Column:
    """Pearson r over the rows that have both values (NULL and NaN are
    missing), from stable central-moment aggregates; NULL for a constant
    column (ANSI `corr` would raise a division by zero)."""
    x, y = present(x), present(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every column with a numeric target, one pass."""
    y = q(target).cast("double")
    row = df.agg(*[_pearson(q(c).cast("double"), y).alias(f"__r{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__r{i}").alias("corr"))
        for i, c in enumerate(cols)])))


def rank_corr(corr: DataFrame, n: int = 10) -> DataFrame:
    """N highest and n lowest correlations.

    Both rankings are windows over the small per-column table, evaluated
    once; each row is emitted as 'top' and/or 'bottom' with `inline`, so
    the correlation aggregate upstream runs a single time.
    """
    from pyspark.sql.window import Window
    valid = corr.where(F.col("corr").isNotNull())
    ranked = (valid.withColumn("__top", F.row_number().over(Window.orderBy(F.desc("corr"), "column")))
              .withColumn("__bottom", F.row_number().over(Window.orderBy(F.asc("corr"), "column"))))
    both = F.array(F.struct(F.lit("top").alias("side"), F.col("__top").alias("rank")),
                   F.struct(F.lit("bottom").alias("side"), F.col("__bottom").alias("rank")))
    return ranked.select("column", "corr", F.inline(F.filter(both, lambda e: e["rank"] <= n)))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson matrix, long form (col_a, col_b, corr), one pass.

    All pair moments come from the same aggregate. For hundreds of columns
    `pyspark.ml.stat.Correlation` on an assembled vector is the better
    plan (one treeAggregate of the Gram matrix).
    """
    cols = list(cols)
    xs = [q(c).cast("double") for c in cols]
    aggs, entries = [], []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(_pearson(xs[i], xs[j]).alias(f"__r{i}_{j}"))
    row = df.agg(*aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            entries.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                    F.col(f"__r{lo}_{hi}").alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def corr_matrix_vector(df: DataFrame, features_col: str, names: Sequence[str] | None = None) -> DataFrame:
    """P23 for wide assembled vectors (hundreds of slots): Spark ML's
    `Correlation` computes the Gram matrix in one tree aggregation; the
    d x d result (statistics) is returned in long form. Constant slots give
    NULL, as in `corr_matrix`."""
    from pyspark.ml.stat import Correlation
    m = Correlation.corr(df.select(features_col), features_col).first()[0].toArray()
    d = m.shape[0]
    names = list(names) if names is not None else [str(i) for i in range(d)]
    # a constant slot has NaN off the diagonal; its diagonal is reported NULL too
    const = {i for i in range(d) if d > 1 and all(m[i, j] != m[i, j] for j in range(d) if j != i)}
    rows = [(names[i], names[j], None if (i in const or j in const or m[i, j] != m[i, j]) else float(m[i, j]))
            for i in range(d) for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")
