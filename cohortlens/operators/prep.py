"""Preprocessing (T01-T10): split, imputation, scaling, encoding.

Fitted stages are Spark ML Estimator/Model pairs, so a whole
preprocessing chain is one `Pipeline` that persists with the ML writer
and scores as one projection. Fitting reads statistics only: means,
population standard deviations and modes come from one aggregate each;
category lists come from `StringIndexer`.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer, StringIndexer,
                                StringIndexerModel, VectorAssembler, IndexToString)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.columns import hash_order_key, present
from cohortlens.operators.profile import q
from cohortlens.session import materialize

# fixed values: test share and seed of the split; hex digits of the hash bucket
TEST_SHARE = 0.2
SPLIT_SEED = 42
BUCKET_HEX_DIGITS = 5
# one row each of up to this many groups is broadcast; more are joined without a hint
BROADCAST_GROUPS = 100_000


def features_target(df: DataFrame, label: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(features without the label, label with the kept key columns)."""
    return df.drop(label), df.select(*[q(k) for k in keep], q(label))


# --------------------------------------------------------------------------- split
def smallest_per_group(df: DataFrame, group: str, key: Column, tiebreak: str,
                       quota: DataFrame, quota_col: str = "quota",
                       digits: int = BUCKET_HEX_DIGITS) -> DataFrame:
    """Flag, per group, the `quota` rows with the smallest hash `key`.

    Exact and skew-safe: rows are never ranked inside one whole group.
      1. count rows per (group, first `digits` hex chars of key): an
         aggregate of at most groups x 16^digits rows;
      2. a running sum over those counts locates, per group, the bucket
         where the quota is reached and how many rows it still needs;
      3. rows in earlier buckets are selected, rows in later ones are
         not, and only the boundary bucket (about n / 16^digits rows of
         a group) is ranked with a window.
    Rows without a group are a group of their own; a quota of at least the
    group's size selects all of it, a group without a quota nothing.
    Returns df with a boolean column `__selected`.
    """
    keyed = df.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, digits))
    counts = keyed.groupBy(q(group).alias("__g"), "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__g").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    quotas = quota.select(q(group).alias("__qg"), F.col(quota_col).cast("long").alias("__quota"))
    cum = counts.withColumn("__cum", F.sum("__n").over(w)).join(quotas, F.col("__g").eqNullSafe(F.col("__qg")))
    # cut: the first bucket whose running count reaches the quota; none where the quota takes the whole group
    cut = F.when(F.col("__cum") >= F.col("__quota"),
                 F.struct("__bucket", (F.col("__quota") - F.col("__cum") + F.col("__n")).alias("__need")))
    plan = (cum.groupBy("__g", "__quota").agg(F.min(cut).alias("__cut"))
            .select(F.col("__g").alias("__gp"), F.lit(True).alias("__known"), F.col("__cut.__bucket").alias("__bb"),
                    F.col("__cut.__need").alias("__need")))
    # a join on the group would send all rows of one to one task: the cuts of a bounded number of groups are broadcast
    plan = materialize(plan)
    side = F.broadcast(plan) if plan.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else plan
    tagged = keyed.join(side, q(group).eqNullSafe(F.col("__gp")), "left")
    at_boundary = F.col("__bucket").eqNullSafe(F.col("__bb"))
    rest = tagged.where(~at_boundary).withColumn(
        "__selected", F.when(F.col("__known").isNull(), False).when(F.col("__bb").isNull(), True)
        .otherwise(F.col("__bucket") < F.col("__bb")))
    edge = tagged.where(at_boundary)
    rank = F.row_number().over(Window.partitionBy("__gp").orderBy("__key", q(tiebreak)))
    edge = edge.withColumn("__selected", rank <= F.col("__need"))
    return rest.unionByName(edge).drop("__gp", "__known", "__bb", "__need", "__bucket")


def stratified_split(df: DataFrame, label: str, id_col: str, test: float = TEST_SHARE,
                     seed: int = SPLIT_SEED, out: str = "split") -> DataFrame:
    """Exact stratified split, `round(n_class * test)` test rows per class.

    Rows are ordered by md5(`id|seed`) within their class (the same order
    any SQL engine with md5 reproduces) and the first ones go to test.
    """
    quota = df.groupBy(q(label).alias(label)).agg(
        F.round(F.count(F.lit(1)) * F.lit(test)).cast("long").alias("quota"))
    flagged = smallest_per_group(df, label, hash_order_key(q(id_col), seed), id_col, quota)
    return flagged.withColumn(out, F.when(F.col("__selected"), "test").otherwise("train")) \
        .drop("__selected", "__key")


def split_frames(df: DataFrame, col: str = "split") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(col) == "train").drop(col), df.where(F.col(col) == "test").drop(col)


def fold_column(df: DataFrame, label: str | None, id_col: str, folds: int = 5, seed: int = SPLIT_SEED,
                out: str = "fold") -> DataFrame:
    """Fold assignment for cross-validation: stratified when `label` is given.

    Within each class rows are numbered in md5 order and dealt round-robin
    to folds, so every fold holds the same class shares (+-1 row).
    The numbering uses the same bucketed plan as the split: a full-class
    window is only applied to hash buckets, never to a whole class.
    """
    key = hash_order_key(q(id_col), seed + 1)
    keyed = df.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, BUCKET_HEX_DIGITS))
    g = q(label) if label else F.lit(0)
    counts = keyed.groupBy(g.alias("__g"), "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__g").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    within = Window.partitionBy("__g", "__bucket").orderBy("__key", q(id_col))
    left = keyed.withColumn("__g", g)
    right = offsets.drop("__n").withColumnsRenamed({"__g": "__g2", "__bucket": "__bucket2"})
    # null-safe on the class so rows without a label still get a fold
    numbered = (left.join(right, left["__g"].eqNullSafe(right["__g2"]) & (left["__bucket"] == right["__bucket2"]))
                .drop("__g2", "__bucket2")
                .withColumn("__pos", F.col("__off") + F.row_number().over(within) - 1))
    return numbered.withColumn(out, (F.col("__pos") % folds).cast("int")) \
        .drop("__g", "__bucket", "__off", "__pos", "__key")


# --------------------------------------------------------------------------- custom stages
class _ColumnsParams(HasInputCols, HasOutputCols):
    def _pairs(self):
        ins = self.getInputCols()
        outs = self.getOrDefault("outputCols") if self.isDefined("outputCols") else ins
        return list(zip(ins, outs))


class PopulationScaler(Estimator, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std; a zero-variance column is only centred.

    `StandardScaler` divides by the sample std, so it is not used here.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        pairs = self._pairs()
        aggs = []
        for i, (c, _) in enumerate(pairs):
            x = present(q(c))
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        means = [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(pairs))]
        stds = [float(row[f"s{i}"]) if row[f"s{i}"] is not None else 0.0 for i in range(len(pairs))]
        model = PopulationScalerModel(inputCols=[p[0] for p in pairs], outputCols=[p[1] for p in pairs],
                                      means=means, stds=stds)
        return model


class PopulationScalerModel(Model, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        means, stds = self.getOrDefault("means"), self.getOrDefault("stds")
        exprs = {}
        for (c, o), m, s in zip(self._pairs(), means, stds):
            exprs[o] = (q(c).cast("double") - F.lit(m)) / F.lit(s if s > 0 else 1.0)
        return df.withColumns(exprs)


class ModeImputer(Estimator, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULL with the most frequent value; a tie takes the smallest.

    Works for string and numeric columns; all columns are counted in one
    grouped aggregate.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        """Value counts per (column, value) are a grouped aggregate (partial
        counts map-side, values spread over tasks by hash); the pick per
        column keeps only a running best, so no task ever holds a column's
        whole value->count map."""
        from pyspark.sql.types import NumericType
        pairs = self._pairs()
        types = {f.name: f.dataType for f in df.schema.fields}
        entries = []
        for i, (c, _) in enumerate(pairs):
            numeric = isinstance(types[c], NumericType)
            entries.append(F.struct(F.lit(i).alias("i"),
                                    (q(c).cast("double") if numeric else F.lit(None).cast("double")).alias("num"),
                                    (F.lit(None).cast("string") if numeric else q(c).cast("string")).alias("txt")))
        long = df.select(F.inline(F.array(*entries))).where(F.col("num").isNotNull() | F.col("txt").isNotNull())
        counts = long.groupBy("i", "num", "txt").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("i").agg(F.min_by(F.struct("num", "txt"), F.struct(-F.col("n"), "num", "txt"))
                                       .alias("m")).collect()
        picked = {r["i"]: r["m"] for r in best}
        fills = []
        for i, (c, _) in enumerate(pairs):
            m = picked.get(i)
            if m is None:
                fills.append(None)
            elif m["num"] is not None:
                v = m["num"]
                fills.append(int(v) if float(v).is_integer() and not types[c].typeName() in ("double", "float") else v)
            else:
                fills.append(m["txt"])
        return ModeImputerModel(inputCols=[p[0] for p in pairs], outputCols=[p[1] for p in pairs],
                                fills=json.dumps(fills))


class ModeImputerModel(Model, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill values (JSON list)", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault("fills"))
        types = {f.name: f.dataType for f in df.schema.fields}
        return df.withColumns({
            o: F.coalesce(q(c), F.lit(v).cast(types[c])) for (c, o), v in zip(self._pairs(), fills)})


# --------------------------------------------------------------------------- pipelines
def mean_imputer(cols: Sequence[str], suffix: str = "__imp") -> list:
    """Cast to double then the stock mean `Imputer` (a filled integer
    column keeps the fractional mean)."""
    cast = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST(`{c}` AS DOUBLE) AS `{c}__dbl`" for c in cols) + " FROM __THIS__")
    imp = Imputer(strategy="mean", inputCols=[f"{c}__dbl" for c in cols],
                  outputCols=[f"{c}{suffix}" for c in cols])
    return [cast, imp]


def one_hot_stages(cols: Sequence[str], suffix: str = "__ohe") -> list:
    """Categories indexed in text order, unseen values -> all zeros."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}{suffix}" for c in cols],
                        dropLast=True)
    return [idx, ohe]


def build_preprocessor(numeric: Sequence[str], categorical: Sequence[str],
                       output: str = "features") -> Pipeline:
    """Numeric block (mean impute, population scale) then categorical
    block (mode impute, one-hot), assembled into one vector."""
    numeric, categorical = list(numeric), list(categorical)
    stages = []
    if numeric:
        stages += mean_imputer(numeric)
        stages.append(PopulationScaler(inputCols=[f"{c}__imp" for c in numeric],
                                       outputCols=[f"{c}__scl" for c in numeric]))
    if categorical:
        stages.append(ModeImputer(inputCols=categorical, outputCols=[f"{c}__mode" for c in categorical]))
        stages += one_hot_stages([f"{c}__mode" for c in categorical])
    stages.append(VectorAssembler(
        inputCols=[f"{c}__scl" for c in numeric] + [f"{c}__mode__ohe" for c in categorical],
        outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def fit_apply(pipeline: Pipeline, train: DataFrame, *others: DataFrame):
    """Fit on the training rows only, transform train and the others."""
    model = pipeline.fit(train)
    return (model, model.transform(train), *[model.transform(o) for o in others])


def feature_names(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Output slot names, `num__<col>` then `cat__<col>_<value>`."""
    names = [f"num__{c}" for c in numeric]
    idx = [s for s in model.stages if isinstance(s, StringIndexerModel) and s.isSet("inputCols")]
    if idx:
        for c, labels in zip(categorical, idx[0].labelsArray):
            names += [f"cat__{c}_{v}" for v in labels]
    return names


# --------------------------------------------------------------------------- labels
def encode_label(df: DataFrame, label: str, out: str = "label") -> tuple[DataFrame, list[str]]:
    """Alphabetical label index as double (0, 1, 2, ...)."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    return model.transform(df), list(model.labels)


def label_indexer(label: str, out: str = "label") -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc")


def decode_label(df: DataFrame, index_col: str, labels: Sequence[str], out: str) -> DataFrame:
    """Index -> label text."""
    return IndexToString(inputCol=index_col, outputCol=out, labels=list(labels)).transform(df)


def label_map(labels: Sequence[str]) -> Column:
    """Literal map index -> label, for use in expressions."""
    return F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(float(i)), F.lit(v))])
