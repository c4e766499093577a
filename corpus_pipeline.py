"""The corpus pipeline: quality rules, near-duplicates, secrets, mixture, packing.

Each stage takes the documents that the one before it kept; the last returns the
packed pieces. No SQL checks it: near-duplicate classes, the mixture's draws and
the packing aren't expressible there; tests/llm holds every stage against a brute-force form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import line_quality, mixing, neardup, packing, secret_scan
from pagelake.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others lose the lines that too many documents share."""
    return line_quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.query(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("packed", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_dir(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
