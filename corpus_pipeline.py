"""The document pipeline: quality, line dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir); ``docs`` has the columns of ``documents``, which all
stages but the last return. What a stage returns is written as Parquet and read
again as the next one's ``docs``. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.llm import line_dedup, packing, pii, quality, simhash
from ovenplan.session import materialize


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(kind))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.kept_documents(docs, labels)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in the one with the largest id."""
    return _sized(line_dedup.dedup_lines(docs, counts=False), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_of_each_group(docs)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes <kind>."""
    return _sized(pii.mask_documents(docs), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("PII", pii_masking),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the forest of the first stage, nor the fingerprints of the third.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
