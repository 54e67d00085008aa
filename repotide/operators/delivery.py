"""Messages to publish, envelopes, and accounting of send attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.columns import from_wire, json_objects, sorted_json, wire_type
from repotide.operators.blocks import numbered
from repotide.schemas import DEFAULT_FLUSH_EVERY, DEFAULT_MAX_RETRIES


def keyed_messages(records: DataFrame, key: str = "repo_id") -> DataFrame:
    """``(key, value)``: the id as text, and the record as JSON with sorted keys."""
    return records.select(
        F.col(key).cast("string").alias("key"), sorted_json(records.columns).alias("value")
    )


def pack_envelopes(
    records: DataFrame, position: str, size: int = DEFAULT_FLUSH_EVERY
) -> DataFrame:
    """``(envelope, value)`` with ``size`` consecutive records each, and the rest in the last.

    The records are numbered in the order of ``position``, so that envelopes are
    full whatever gaps the positions have.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    envelope = F.floor(F.col("_number") / size).cast("bigint").alias("envelope")
    entry = F.struct("_number", F.struct(*sorted(records.columns)).alias("r"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["r"])
    return (
        numbered(records, [position], "_number")
        .groupBy(envelope)
        .agg(ordered.alias("records"))
        .select(
            "envelope",
            F.to_json(F.struct("records"), {"ignoreNullFields": "false"}).alias("value"),
        )
    )


def unpack_envelopes(
    messages: DataFrame, schema: T.StructType, value: str = "value"
) -> DataFrame:
    """Records of messages: the list of an envelope, or a lone record itself.

    Adds ``error`` for messages that are no object, and for records without a
    usable id or with a commit count that is no number; those carry their
    ``payload``, belong in quarantine, and never stop the others.
    """
    text = F.col(value)
    messages = messages.select(text, json_objects(text).alias("objects")).select(
        text, F.when(F.size("objects") == 1, F.get("objects", F.lit(0))).alias("object")
    )
    sound = F.col("object").isNotNull()
    listed = F.coalesce(
        F.ltrim(F.try_element_at("object", F.lit("records"))).startswith("["), F.lit(False)
    )
    wire = wire_type(schema).simpleString()
    many = F.from_json(text, f"struct<records:array<{wire}>>")["records"]
    one = F.array(F.from_json(text, wire))
    nothing = F.array(F.lit(None).cast(wire))
    records = F.coalesce(F.when(sound & listed, many).when(sound, one), nothing)
    rows = messages.select(
        text.alias("payload"), sound.alias("sound"), F.explode(records).alias("r")
    ).select("payload", "sound", "r", *from_wire("r", schema))
    error = F.when(~F.col("sound"), F.lit("not an object")).when(
        F.col("repo_id").isNull(), F.lit("no repo_id")
    )
    if "commit_count" in schema.names:
        lost = F.col("r.commit_count").isNotNull() & F.col("commit_count").isNull()
        error = error.when(lost, F.lit("bad commit_count"))
    return rows.select(
        *schema.names, F.when(error.isNotNull(), F.col("payload")).alias("payload"), error.alias("error")
    )


def record_outcomes(attempts: DataFrame) -> DataFrame:
    """Per record: whether it got through, and how many attempts failed."""
    return attempts.groupBy("repo_id").agg(
        F.max("ok").alias("published"),
        F.count_if(~F.col("ok")).alias("failures"),
    )


def delivery_totals(
    attempts: DataFrame, skipped: DataFrame | None = None, max_retries: int = DEFAULT_MAX_RETRIES
) -> DataFrame:
    """Totals over send attempts ``(repo_id, attempt, ok)``.

    Every failed attempt counts as a failure; a record fails for good once
    ``max_retries + 1`` attempts have failed. ``skipped`` has the ids that were
    not attempted because an earlier run has published them.
    """
    spent = ~F.col("published") & (F.col("failures") > max_retries)
    outcomes = record_outcomes(attempts).select(
        "published", "failures", spent.alias("spent"), F.lit(False).alias("skipped")
    )
    if skipped is not None:
        no = F.lit(False)
        outcomes = outcomes.unionByName(
            skipped.select(
                no.alias("published"),
                F.lit(0).cast("bigint").alias("failures"),
                no.alias("spent"),
                F.lit(True).alias("skipped"),
            )
        )
    return outcomes.agg(
        F.count_if("published").alias("published"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("publish_failures"),
        F.count_if("spent").alias("permanent_failures"),
        F.count_if("skipped").alias("skipped_via_checkpoint"),
    )
