"""Ids already published: a table, and its exchange form as one JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.operators.dedupe import without
from repotide.sources.topics import read_table

PUBLISHED_SCHEMA = "repo_id bigint"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, PUBLISHED_SCHEMA)


def read_published_document(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a ``{"published_repo_ids": [...]}`` document written by another run."""
    listed = spark.read.schema("published_repo_ids array<bigint>").option("multiLine", True)
    return listed.json(path).select(F.explode("published_repo_ids").alias("repo_id"))


def save_published(ids: DataFrame, path: str) -> None:
    """Append ids, in order of id inside each file."""
    ids.select("repo_id").sortWithinPartitions("repo_id").write.mode("append").parquet(path)


def unpublished(records: DataFrame, published: DataFrame) -> DataFrame:
    return without(records, published, "repo_id")
