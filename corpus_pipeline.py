"""The training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it works on all
that the stage before it kept. ``run`` writes each stage as Parquet into the
cluster's shared folder and reads it back as the next stage's input, so a lost
executor never costs more than one stage. All stages but the last return the
columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import line_dedup, mixing, packing, quality, simhash
from statflow.llm.common import stage
from statflow.session import prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them only."""
    cut = line_dedup.line_dedup(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that their sources meet the target weights."""
    return mixing.mix_sources(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into windows of tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("near-dedup", near_duplicates),
    ("source mix", source_mix),
    ("packing", packed),
]

#: SQL can express neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"stage-{k}")
    return docs
