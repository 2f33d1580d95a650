"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bagminhash, packing, quality, secret_scans
from tidewatch.llm.common import documents, staged
from tidewatch.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def first_of_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return bagminhash.first_of_groups(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: confirmed secrets are replaced in the text; every document stays."""
    return secret_scans.redacted(docs, secret_scans.scan(docs, F.col("source")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: what is left, end to end in sequences of 2048 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.piece_digests(packing.pack_documents(docs, path))


STAGES: list[tuple[str, Stage]] = [
    ("quality", accept),
    ("near_dedup", first_of_groups),
    ("secrets", redact),
    ("packing", pack),
]

#: Tokenizing, classifying and matching can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
