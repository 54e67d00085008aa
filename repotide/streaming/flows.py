"""Streams between topics and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.columns import sorted_json
from repotide.operators.quality import judge_lines
from repotide.session import materialize
from repotide.sources.published import unpublished
from repotide.sources.topics import judge_messages
from repotide.streaming.first_seen import FirstSeen
from repotide.streaming.intake import Intake
from repotide.streaming.runs import drain_to_files, write_batch


def quarantine_topic(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Keep every message with the reason it is unfit, null when it is fit.

    One pass over the messages; fit and unfit ones land in separate partitions,
    so one bad message never holds up another.
    """
    judged = judge_lines(messages.withColumnRenamed("value", "line"))
    status = F.when(F.col("reason").isNull(), F.lit("fit")).otherwise(F.lit("unfit"))
    drain_to_files(judged.withColumn("status", status), path, checkpoint, ("status",))


def publish_topic(
    messages: DataFrame, schema: T.StructType, published: DataFrame, root: str
) -> Intake:
    """Send each record once that no earlier run has published, and log its id.

    ``published`` is the log of earlier runs. An id enters this run's log only
    after its message is stored. The earlier log is made distinct once, ahead of
    the stream. Sent messages are under ``root/sent``, ids under ``root/log``;
    messages without a record are the intake's unfit ones.
    """
    spark = messages.sparkSession
    published = materialize(published.select("repo_id").distinct(), "published")
    first = FirstSeen(spark, f"{root}/first", schema)

    def send(batch: DataFrame, batch_id: int) -> None:
        value = sorted_json(batch.columns).alias("value")
        sent = write_batch(batch.select("repo_id", value), f"{root}/sent", batch_id)
        write_batch(sent.select("repo_id"), f"{root}/log", batch_id)

    first.deliver = send
    intake = Intake(
        spark, f"{root}/intake", judge_messages, schema,
        lambda records, batch_id: first.take(unpublished(records, published), batch_id),
    )
    intake.run(messages)
    return intake


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log).select("repo_id")
