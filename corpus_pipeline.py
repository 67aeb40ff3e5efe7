"""Documents to packed training sequences, stage by stage; each stage's rows are written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, minhash, mixing, packing, quality_rules
from millrace.llm.text import land


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the production policy rejects."""
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language can't be told or was not learned; learns from all those not held out."""
    learn = ~langid.held_out()
    model = langid.with_bounds(spark, docs, langid.fit(spark, docs, learn=learn, settings=langid.WHOLE), learn=learn)
    return langid.keep(spark, docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.keep_one(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents to meet each source's target, in training order."""
    return mixing.mix(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence, and the place in it, of every piece of every document; sequences keep to a stretch of the mix."""
    return packing.pack_table(spark, packing.in_order(spark, docs), position="position")


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("mixing", mixture),
    ("best_fit_packing", packed),
]

#: Language identification and near duplicates can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
