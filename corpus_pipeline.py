"""A training corpus from raw documents: five stages, each one of the operators of assetlake.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.

Defined results: null and empty texts are scored, kept apart from near duplicates, masked as they
are, and leave at the mix, which takes words; repeated rows are near duplicates; extra columns ride
along to the last stage; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm import mixing, ngram_join, packing, pii, toxicity
from assetlake.llm.common import read, release, stage, with_text


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labels of the documents given."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return ngram_join.first_of_each(docs, n=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by its kind."""
    return docs.select(with_text(docs, pii.mask(F.col("text"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes."""
    return mixing.mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: Compression lengths, parity sketches and tokens have no SQL twin; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs
