"""Topics: append-only message logs read from the earliest message.

Here a topic is a folder of JSON lines. A broker topic differs only in the
format and options passed to ``open_topic``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.columns import from_wire, sorted_json, whole_number, wire_type


def publish(records: DataFrame, path: str, files: int | None = None) -> None:
    """Append records as JSON lines; ``files`` spreads them evenly over that many.

    Files carry no order, so records are not gathered by key here: one busy key
    would otherwise fill one file.
    """
    if files:
        records = records.repartition(files)
    lines = records.select(sorted_json(records.columns).alias("value"))
    lines.write.mode("append").text(path)


def send(messages: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Write ``(key, value)`` messages to a broker, which places them by key."""
    messages.select("key", "value").write.format(fmt).options(**options).save()


def open_topic(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    fmt: str = "text",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of messages with their text in ``value``.

    ``files_per_batch`` bounds how much one micro-batch takes in.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "text":
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.load(path)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of messages that each hold one JSON object with an id.

    Everything else, such as text that is no JSON, a list, several objects, or
    an id that is no whole number, gives no record; :func:`unfit_messages` has it.
    """
    record = F.explode(_one_record(schema)).alias("r")
    return messages.select(record).select(*from_wire("r", schema))


def unfit_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages of which :func:`parse_messages` makes no record, blank ones aside."""
    return messages.filter((F.trim("value") != "") & (F.size(_one_record(schema)) != 1))


def judge_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Records, and the messages that hold none with an ``error``; one parse gives both.

    A record has its columns and neither ``payload`` nor ``error``; an unfit
    message has only those two. Blank messages give neither.
    """
    parsed = messages.filter(F.trim("value") != "").select("value", F.explode_outer(_one_record(schema)).alias("r"))
    unfit = F.col("r").isNull()
    return parsed.select(
        *from_wire("r", schema),
        F.when(unfit, F.col("value")).alias("payload"),
        F.when(unfit, F.lit("no record")).alias("error"),
    )


def _one_record(schema: T.StructType) -> Column:
    """The record of a message as an array of one, else an empty array."""
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = F.from_json(
        wrapped, T.ArrayType(wire_type(schema)), {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
    )
    sound = F.filter(parsed, lambda r: whole_number(r["repo_id"]).isNotNull())
    none = F.slice(parsed, 1, 0)
    if "repo_id" not in schema.names:
        sound = parsed
    return F.coalesce(F.when(F.size(parsed) == 1, sound).otherwise(none), F.array().cast(T.ArrayType(wire_type(schema))))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
