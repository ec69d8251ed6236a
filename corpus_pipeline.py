"""The training-data pipeline: STAGES applied to `documents` in turn, each
stage written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import kept, table
from cohortlens.llm.stages import drop_contaminated, drop_repeated_lines, known_language, one_of_near_duplicates, pack

STAGES = [
    ("language_id", known_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: language ID, SimHash and packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = kept(docs, f"stage-{name}")
    return docs
