"""From raw documents to a shuffled, sharded mix, in stages that are each written before the next one reads.

Nulls in any column, empty and very long texts, repeated rows and empty tables pass through as the operators define.
Extra columns stay, whatever their names, until the last stage, where those named like its own are replaced.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.llm import decontaminate, mixing, near_dedup, quality_rules, sharding
from convoy.llm.common import read_table
from convoy.session import ensure_checkpoint_dir


#: Columns that the operators read; others are out of their way under names that none of them uses.
READ = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[c if c in READ else f"other{i}" for i, c in enumerate(docs.columns)])


def _back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """``kept`` with the columns of ``docs`` under their names."""
    return kept.select(*[F.col(c if c in READ else f"other{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return _back(quality_rules.apply_rules(_aside(docs), model).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id."""
    return _back(near_dedup.mark_near_duplicates(_aside(docs)).filter("kept"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return _back(decontaminate.drop_contaminated(_aside(docs), read_table(spark, sf_dir, "benchmark")), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that is taken twice is there twice."""
    return _back(mixing.expand_copies(mixing.mix(_aside(docs))), docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality rules", quality), ("near duplicates", near_duplicates), ("benchmark decontamination", decontamination),
    ("mixing", mix), ("sharding", shards),
]

#: SQL cannot express the trees of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read back."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid4()}"
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
