"""The corpus pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm import line_dedup, near_dedup, packing, secret_scan
from repotide.llm import toxicity as toxic_model
from repotide.llm.common import materialize, table, tokenizer_path


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a text that a stage has changed."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, unchanged."""
    model = toxic_model.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_model.without_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site lines stay at their first place; documents emptied by that go."""
    return _recounted(line_dedup.cleaned(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, unchanged."""
    return near_dedup.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked."""
    forest = secret_scan.train(secret_scan.labelled_findings())
    return _recounted(secret_scan.redacted(docs, forest))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets),
    ("packing", pack),
]

# A trained classifier and signatures are beyond SQL; tests hold the run
# against brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
