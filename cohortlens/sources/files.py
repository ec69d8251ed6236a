"""File sources and sinks: delimited text, Parquet, role lists, models.

Readers take an explicit schema whenever one is known; inference is only
a fallback. Writers never route rows through the driver.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, asdict
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: delimiters the sniffer chooses between, in order of preference
SNIFF_DELIMITERS = [";", ","]


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that occurs most often outside quotes in the header line
    (the earlier of SNIFF_DELIMITERS on ties, `,` when there is none).

    Only the first line is read (`limit(1)` stops the scan early).
    """
    first = spark.read.text(path).limit(1).collect()
    head = re.sub(r'"[^"]*"', "", first[0][0]) if first else ""
    best = max(SNIFF_DELIMITERS, key=head.count)
    return best if head.count(best) else ","


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               sep: str | None = ";", header: bool = True,
               normalize_names: bool = False) -> DataFrame:
    """Read a delimited text table (A01); `sep=None` sniffs it.

    With a schema no inference pass is made. NaN read from text becomes
    NULL so that missing values are uniform.
    """
    if sep is None:
        sep = sniff_delimiter(spark, path)
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        name = _normalize(f.name) if normalize_names else f.name
        cols.append(c.alias(name))
    return df.select(*cols)


def _normalize(name: str) -> str:
    return "_".join(name.strip().replace("/", " ").replace("'", "").replace("(", " ")
                    .replace(")", " ").lower().split())


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, sep: str = ",") -> str:
    """Write a result table (A10, C05): CSV with header, or Parquet.

    Each task writes its own part file; nothing is gathered on the driver.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("sep", sep).csv(path)
    else:
        w.format(fmt).save(path)
    return path


@dataclass
class Roles:
    """Column roles (A04): numeric, categorical, label, id."""

    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    label: str | None = None
    id: str | None = None

    def extend(self, numeric: Iterable[str] = (), categorical: Iterable[str] = ()) -> "Roles":
        return Roles(self.numeric + [c for c in numeric if c not in self.numeric],
                     self.categorical + [c for c in categorical if c not in self.categorical],
                     self.label, self.id)

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Roles":
        return cls(**json.loads(text))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Roles":
        return cls.from_json(spark.read.text(path).first()[0])

    def verify(self, df: DataFrame) -> dict[str, list[str]]:
        """Columns of the table that no role lists (missing), and listed
        ones that the table has not (extra)."""
        cols = set(df.columns) - {self.label, self.id}
        declared = set(self.features)
        return {"missing": sorted(cols - declared), "extra": sorted(declared - cols)}


def save_features(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Feature vectors and labels stay in the same row, as Parquet."""
    df.write.mode(mode).parquet(path)
    return path


def load_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_split(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> str:
    """A split table partitioned by its split column."""
    df.write.mode(mode).partitionBy(split).parquet(path)
    return path


def load_split(spark: SparkSession, path: str, label: str, id_col: str, split: str = "split"):
    """(features of train, of test, labels of train, of test). Features
    keep the id; labels are (id, label). Each side reads its partition and its
    columns only."""
    whole = spark.read.parquet(path)
    sides = [whole.where(F.col(split) == name).drop(split) for name in ("train", "test")]
    return (*[s.drop(label) for s in sides], *[s.select(id_col, label) for s in sides])


def load_labels(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A label file of one column; rows keep no order of their own, so
    labels that belong to rows elsewhere need an id (see load_split)."""
    df = read_table(spark, path, sep=sep)
    if len(df.columns) != 1:
        raise ValueError(f"{path} has {len(df.columns)} columns, not one")
    return df


def save_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Long prediction table partitioned by model."""
    df.write.mode(mode).partitionBy("model").parquet(path)
    return path


def load_predictions(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    """Read predictions; a model filter prunes partitions."""
    df = spark.read.parquet(path)
    if models is not None:
        df = df.where(F.col("model").isin(list(models)))
    return df


def has_model(df: DataFrame, model: str) -> bool:
    """Optional-member test on a prediction table (partition-pruned)."""
    return len(df.where(F.col("model") == model).select("model").limit(1).collect()) > 0


def save_model(model, path: str) -> str:
    """Persist a fitted stage or pipeline with the ML writer."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def load_first(paths: Sequence[str], loader=None):
    """Load the first model path that exists; only a missing path is skipped."""
    from pyspark.errors import AnalysisException
    from py4j.protocol import Py4JJavaError

    loader = loader or load_model
    errors = []
    for p in paths:
        try:
            return loader(p)
        except (AnalysisException, Py4JJavaError, FileNotFoundError) as e:
            text = str(e)
            if "does not exist" in text or "FileNotFound" in text or "PATH_NOT_FOUND" in text \
                    or "Input path does not exist" in text:
                errors.append(p)
                continue
            raise
    raise FileNotFoundError(f"none of the model paths exist: {list(paths)}")


def record_frame(spark: SparkSession, record: dict, schema: StructType) -> DataFrame:
    """One record in training column order with the training types."""
    row = tuple(record.get(f.name) for f in schema.fields)
    return spark.createDataFrame([row], schema)
