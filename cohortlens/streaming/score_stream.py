"""Stateless stream scoring of arriving files.

`readStream` with an explicit schema -> the scoring PipelineModel ->
`writeStream` to Parquet (or CSV) with a checkpoint location. No state
and no watermark are needed: each micro-batch is scored independently,
and the file sink plus checkpoint give exactly-once output, so a restart
after a lost executor or driver resumes where it stopped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortlens.operators.score import score_batch


def score_stream(spark: SparkSession, model: PipelineModel, source: str, schema: StructType, sink: str,
                 checkpoint: str, classes: Sequence[str], id_col: str = "id", fmt: str = "parquet",
                 sep: str = ";", available_now: bool = True, max_files_per_trigger: int | None = None
                 ) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        src = reader.option("header", True).option("sep", sep).csv(source)
    else:
        src = reader.parquet(source)
    scored = score_batch(model, src, classes, id_col, with_text=True)
    writer = (scored.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
