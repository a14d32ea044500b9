"""Registered queries of this package: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetlake.llm import (embedding_dups, fixity, hard_negatives, licenses, mixing, ngram_join, packing, pii, quality, records,
                           repeats, resampling, toxicity)
from assetlake.llm.common import read

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op4_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return fixity.audit(pages, fixity.aged_copy(pages))


ORACLES["op8_warc_fixity"] = fixity.SQL


@query
def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(read(spark, sf_dir, "documents"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


ORACLES["op11_hard_negatives"] = hard_negatives.SQL


@query
def op13_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode(read(spark, sf_dir, "documents"))


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
