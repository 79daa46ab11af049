"""The corpus pipeline: five stages over ``documents``, each writing what the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registrylake.llm import decontamination, minhash, mixing, pii, quality_rules
from registrylake.tables.work import work_folder

#: Common 5-word shingles, in percent of all, from which on documents are near duplicates.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return minhash.keep_first(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, items)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of the documents that the mixture takes, with their epoch and position."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("personal data", remove_personal_data),
    ("source mixing", mix_sources),
]

#: Estimated rule weights and rewritten texts have no SQL form; tests compare with Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
