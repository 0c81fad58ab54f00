"""From documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept; what it returns is written as Parquet and read
again. The first four keep the columns of `documents`: toxic documents go, of each group of near copies
one document stays, documents that hold a benchmark item go, and personal data is replaced. The last
packs what is left and returns the place of every piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from repopulse.llm import decontaminate, jaccard, packing, pii, toxicity
from repopulse.llm.store import stored
from repopulse.llm.textops import table


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.without_personal_data(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic_documents),
    ("near_copies", near_copies),
    ("decontamination", benchmark_passages),
    ("personal_data", personal_data),
    ("packing", sequences),
]

#: The classifier, the learned patterns and the packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
