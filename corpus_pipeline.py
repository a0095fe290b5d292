"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Documents that the quality rules reject go; one document of each group of near-duplicates stays;
documents that hold a passage of the benchmark go; personal data in the others is masked; what is left
is packed into sequences. All stages but the last return the columns of ``documents``. Nulls, empty
texts, repeated rows and further columns have the results that each operator's module states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import decontam, neardup, packing, pii, quality
from meterloom.llm.common import ship, stored, table
from meterloom.llm.queries import word_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.passed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more."""
    ship(spark)
    return neardup.one_of_each(docs, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pii.masked_texts(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their tokens (unsigned little-endian 32-bit ids)."""
    ship(spark)
    return packing.pack(docs, word_tokenizer()).withColumn("ids_crc32", F.crc32("tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Learned estimates, verified sketches and tokens are beyond SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
