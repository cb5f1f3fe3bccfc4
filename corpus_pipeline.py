"""From raw documents to packed sequences: quality rules, near-dedup, decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last return the columns of
documents. Null ids and texts, repeated rows and empty tables go through every stage as the operators state.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from caseflux.llm import decontamination, near_dups, packing, pii, quality_rules
from caseflux.llm.common import shared
from caseflux.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the model's fixed threshold go."""
    return quality_rules.keep(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return near_dups.drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that re-use a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def remove_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced in the text."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their checksum, sequence and offset."""
    return packing.pack_digest(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", remove_pii), ("packing", pack)]

# The quality model is fitted and the packing tokenises: SQL can express neither (tests compare with a plain version).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    shared(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
