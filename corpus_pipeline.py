"""A training corpus out of raw documents, stage by stage.

Each stage reads what the one before it wrote. All but the last return the columns of documents; the last
adds `copies`, how often the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesgrain.llm.decontaminate import drop_leaky
from salesgrain.llm.exact_dedup import drop_exact_copies
from salesgrain.llm.jaccard_join import drop_near_copies
from salesgrain.llm.quality_model import keep_good
from salesgrain.llm.shared import Scratch
from salesgrain.llm.source_mix import draw_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest doc_id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, 0.8 alike or more, the one with the least doc_id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy, exact or edited, of a benchmark item."""
    return drop_leaky(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    return draw_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
]

ORACLE_SQL = None  # a learned score, the alignment and the chosen paths are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.stage(f"stage-{number}", stage(spark, docs, sf_dir))
    return docs
