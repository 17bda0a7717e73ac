"""A corpus pipeline over ``documents``: quality classifier, line deduplication, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rotorlens.llm import line_dedup, mixing, packing, quality_classifier, simhash
from rotorlens.llm.common import shared_folder, table
from rotorlens.llm.queries import tokenizer_file


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.accepted_documents(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return line_dedup.deduped_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.deduped_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_shared_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training, fingerprint bits and draws have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a Parquet table in the shared folder between them."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
