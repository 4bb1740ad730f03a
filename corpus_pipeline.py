"""From raw documents to packed token sequences, in five stages.

Each stage gets what the one before it kept, as a table that was written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import language, mixing, packing, secret_scan, simhash
from tapeline.llm.common import DOCUMENT
from tapeline.llm.queries import tokenizer_file
from tapeline.session import staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in; those in others and texts without letters go."""
    return language.speaks(docs, DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id."""
    return simhash.one_of_each(docs, DOCUMENT)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them masked."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take_mix(docs, DOCUMENT)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full windows of token ids."""
    return packing.pack(docs, tokenizer_file()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, language profiles and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
