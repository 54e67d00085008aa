"""Newline-delimited JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.columns import emit_stamp, sorted_json
from repotide.schemas import RAW_REPO

CORRUPT = "_corrupt"


def read_records(spark: SparkSession, path: str, schema: T.StructType = RAW_REPO) -> DataFrame:
    """Good records of NDJSON files: lines that are one JSON object with an id or a name.

    Blank lines are skipped, unknown fields ignored. :func:`bad_lines` has the
    other lines.
    """
    lines = _lines(spark, path, schema)
    return lines.filter(_sound()).drop(CORRUPT)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_REPO) -> DataFrame:
    """Lines that do not parse, and records without id and name, with what was read."""
    return _lines(spark, path, schema).filter(~_sound())


def _lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _sound():
    """A record can be told from others: by its id, or by its name."""
    return F.coalesce(F.col(CORRUPT).isNull() & (F.col("repo_id").isNotNull() | (F.col("full_name") != "")), F.lit(False))


def write_records(records: DataFrame, path: str, stamp: bool = True) -> None:
    """Replace ``path`` by the records, keys sorted inside each line.

    ``emitted_at`` is stamped here, after deduplication, and not earlier.
    """
    if stamp:
        records = records.withColumn("emitted_at", emit_stamp())
    lines = records.select(sorted_json(records.columns).alias("value"))
    lines.write.mode("overwrite").text(path)


def tap(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records met, four fields each."""
    return records.select("repo_id", "full_name", "stars", "language").limit(n)
