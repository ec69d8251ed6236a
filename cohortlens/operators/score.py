"""Scoring (C01, C02, C04, C05): one PipelineModel holds feature
engineering, preprocessing, selection, the classifier and label decoding,
so a batch is scored by one distributed projection (the reference loops
per row)."""

from __future__ import annotations

from typing import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlens.functions.columns import format_proba
from cohortlens.operators.features import PeriodColumns, engineer_features
from cohortlens.sources.files import record_frame, write_table


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """F01-F09 as a pipeline stage (column names are parameters)."""

    periods = Param(Params._dummy(), "periods", "p1/p2 column names as 'a1,a2;e1,e2;g1,g2;c1,c2;w1,w2'",
                    TypeConverters.toString)
    ageCol = Param(Params._dummy(), "ageCol", "age column", TypeConverters.toString)

    @keyword_only
    def __init__(self, periods=None, ageCol="age"):
        super().__init__()
        p = PeriodColumns()
        default = ";".join(",".join(x) for x in (p.approved, p.enrolled, p.grade, p.credited, p.without_eval))
        self._setDefault(periods=default, ageCol="age")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = [tuple(x.split(",")) for x in self.getOrDefault("periods").split(";")]
        return engineer_features(df, PeriodColumns(*parts), self.getOrDefault("ageCol"))


def scoring_model(stages: Sequence, labels: Sequence[str], prediction: str = "prediction",
                  out: str = "predicted") -> PipelineModel:
    """Chain fitted stages and a label decoder into one PipelineModel."""
    return PipelineModel(stages=list(stages) + [
        IndexToString(inputCol=prediction, outputCol=out, labels=list(labels))])


def score_batch(model: PipelineModel, df: DataFrame, classes: Sequence[str], id_col: str = "id",
                prob_col: str = "probability", out: str = "predicted", with_text: bool = False) -> DataFrame:
    """Id, predicted class and one probability column per class
    (alphabetical order); `with_text` adds the C04 display string."""
    scored = model.transform(df)
    arr = vector_to_array(F.col(prob_col))
    cols = [F.col(id_col), F.col(out).alias("predicted")] + [arr[i].alias(f"p_{c}") for i, c in enumerate(classes)]
    res = scored.select(*cols)
    if with_text:
        best = F.greatest(*[F.col(f"p_{c}") for c in classes])
        res = res.withColumn("confidence", format_proba(F.col("predicted"), best))
    return res


def score_one(model: PipelineModel, spark, record: dict, schema: StructType, classes: Sequence[str]) -> DataFrame:
    """One record through the same model (same code path as batches)."""
    df = record_frame(spark, record, schema)
    id_col = schema.fieldNames()[0]
    return score_batch(model, df, classes, id_col, with_text=True)


def export_scores(df: DataFrame, path: str) -> str:
    """Predictions as CSV with a header."""
    return write_table(df, path, "csv")
