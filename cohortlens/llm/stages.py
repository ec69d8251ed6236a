"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns
the documents it keeps, with the columns it was given (the last one returns
what it makes of them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import cross_parse, line_bloom, packing, simhash_bk, winnowing
from cohortlens.llm.common import steady, table


def recounted(docs: DataFrame, text: str) -> DataFrame:
    """Puts a changed text in place; n_chars, where present, follows it."""
    changed = ~F.col("text").eqNullSafe(F.col(text))
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return docs.withColumn("text", F.col(text)).drop(text)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: learns from the labelled documents; those without a letter
    (predicted `und`) go. The label stays as given."""
    steady(spark)
    model = cross_parse.sample(docs)
    found = docs.withColumn("__language", cross_parse.identify(F.col("text"), model))
    return found.where(F.col("__language.lang") != cross_parse.UNKNOWN).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines held by three or more documents stay in one only.
    Every document stays; null texts stay null."""
    steady(spark)
    out = line_bloom.dedup_lines(docs, kept="__kept", n_lines="__lines", n_dropped="__dropped")
    out = out.withColumn("__kept", F.when(F.col("text").isNotNull(), F.col("__kept")))
    return recounted(out, "__kept").select(docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: of each component the document with the smallest id stays."""
    steady(spark)
    return simhash_bk.one_of_each(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a hit word go."""
    steady(spark)
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return winnowing.decontaminate(docs, benchmark, prefix="__").where("__n_hit = 0").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: a row for each piece with its place."""
    steady(spark)
    import public_tokenizers

    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
