"""A corpus pipeline of five stages: language ID, exact dedup, near-dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. run() applies them to the
table `documents`; what a stage returns is written to the shared folder and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import exact_dedup, language_id, mixing, near_dedup, packing
from postloom.llm.common import Scratch


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that look like no language rather than like any."""
    model, langs = language_id.learn(docs, language_id.bucket_of("doc_id", 3) != 1)
    return language_id.keep_identified(docs, model, langs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8, the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within the shards."""
    return mixing.Mix(docs).shuffled().select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the network nor the genetic algorithm; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
