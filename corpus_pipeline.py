"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage reads what the one before it wrote, works on all of it, and returns the columns of documents; the last one returns
packed pieces.  Models and limits are fitted on labelled rows of the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwatch.llm import mixing, ngram_join, packing, quality_rules, toxicity
from panelwatch.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts by the base rules and by compression bands."""
    return quality_rules.keep_good(docs, quality_rules.fit_bands(docs, table(spark, sf_dir, "labels")))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic texts."""
    return toxicity.keep_civil(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each class of near copies."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by target weights; those of later epochs come again."""
    return mixing.mixed_docs(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs token pieces into sequences."""
    return packing.packed(docs)


STAGES = [("quality_rules", quality), ("toxicity", civil), ("ngram_join", distinct_texts), ("mixing", mix), ("packing", pack)]

#: SQL has neither the compressor nor the fitted model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
