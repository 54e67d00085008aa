"""Hand-off checks of record lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.functions.columns import is_falsy_id, json_objects, language_label
from repotide.operators.rankings import top_ranked
from repotide.schemas import REQUIRED_FIELDS, UNKNOWN_LANGUAGE_IN_REPORT

BLANKS = " \t\r\n\f\u000b"


def parse_lines(lines: DataFrame, keep: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """``keep`` and ``(is_record, missing, key, language)`` of every non-blank line.

    ``missing`` lists absent required fields; a present null is not missing.
    ``key`` is the id, or the lower-cased name when the id is null, empty or zero.
    """
    text = F.btrim(F.col("line"), F.lit(BLANKS))
    fields = F.col("fields")
    repo_id = F.try_element_at(fields, F.lit("repo_id"))
    name = F.when(
        F.map_contains_key(fields, "full_name"),
        F.lower(F.coalesce(F.try_element_at(fields, F.lit("full_name")), F.lit("None"))),
    ).otherwise(F.lit(""))
    present = F.map_keys(fields)
    absent = [F.when(~F.array_contains(present, f), F.lit(f)) for f in sorted(REQUIRED_FIELDS)]
    is_record = fields.isNotNull()
    return (
        lines.withColumn("_text", text)
        .filter(F.col("_text") != "")
        .select(*keep, json_objects("_text").alias("objects"))
        .select(*keep, F.when(F.size("objects") == 1, F.get("objects", F.lit(0))).alias("fields"))
        .select(
            *keep,
            is_record.alias("is_record"),
            F.when(is_record, F.concat_ws(", ", *absent)).alias("missing"),
            F.when(is_record, F.when(is_falsy_id(repo_id), name).otherwise(repo_id)).alias("key"),
            F.try_element_at(fields, F.lit("language")).alias("language"),
        )
    )


def line_diagnostics(lines: DataFrame) -> DataFrame:
    """One row per non-blank line with its problems.

    A repeat is a record that is not the first line of its key. Only keys that
    do repeat are looked up, with their first line: few in a healthy hand-off,
    so that Spark can broadcast them and leave the lines where they are. A key
    shared by very many lines is skewed on the lines' side only, which is split.
    """
    # Neither a filter on the parsed fields nor a nullable join key: either would
    # be pushed down to the lines and parse them a second time.
    # Lines that are no records repeat nothing, and are spread by their number.
    own = F.concat(F.lit("\u0000"), F.col("line_no").cast("string"))
    parsed = parse_lines(lines).withColumn(
        "_key", F.when(F.col("is_record"), F.coalesce("key", F.lit(""))).otherwise(own)
    )
    repeated = (
        parsed.groupBy("_key")
        .agg(
            F.min(F.when(F.col("is_record"), F.col("line_no"))).alias("first_line"),
            F.count_if("is_record").alias("n"),
        )
        .filter("n > 1")
        .select("_key", "first_line")
    )
    later = F.col("is_record") & (F.col("line_no") > F.col("first_line"))
    return parsed.join(repeated, "_key", "left").select(
        "line_no",
        (~F.col("is_record")).alias("invalid_json"),
        F.coalesce("missing", F.lit("")).alias("missing"),
        "key",
        F.coalesce(later, F.lit(False)).alias("is_duplicate"),
    )


def line_summary(lines: DataFrame) -> DataFrame:
    """Totals of a hand-off: records, repeats, incomplete records, invalid lines."""
    per_key = (
        parse_lines(lines)
        .groupBy("is_record", "key")
        .agg(F.count("*").alias("n"), F.count_if(F.col("missing") != "").alias("incomplete"))
    )
    record = F.col("is_record")
    totals = per_key.agg(
        F.coalesce(F.sum(F.when(record, F.col("n"))), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.when(record, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(record, F.col("incomplete"))), F.lit(0)).alias("missing_required"),
        F.coalesce(F.sum(F.when(~record, F.col("n"))), F.lit(0)).alias("invalid_json"),
    )
    faults = F.col("duplicates") + F.col("missing_required") + F.col("invalid_json")
    return totals.withColumn("has_errors", faults > 0)


def language_preview(lines: DataFrame, n: int = 10) -> DataFrame:
    label = language_label("language", UNKNOWN_LANGUAGE_IN_REPORT)
    # Counted, not filtered: a filter would parse the lines a second time.
    counts = parse_lines(lines).groupBy(label.alias("name")).agg(
        F.count_if("is_record").alias("count")
    )
    return top_ranked(counts.filter(F.col("count") > 0), n)


def judge_lines(lines: DataFrame, keep: tuple[str, ...] = ("line",)) -> DataFrame:
    """``keep`` and ``reason``, null for lines fit to be processed."""
    reason = F.when(~F.col("is_record"), F.lit("invalid json")).when(
        F.col("missing") != "", F.concat(F.lit("missing: "), F.col("missing"))
    )
    return parse_lines(lines, keep).select(*keep, reason.alias("reason"))
