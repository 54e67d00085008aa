"""Stored search result pages: ``(query, page_no, payload)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.columns import as_col, from_wire, whole_number, wire_type
from repotide.schemas import SEARCH_CAP, SEARCH_ITEM

# Numbers are read as text, so that one in quotes is a number too.
ITEM = wire_type(SEARCH_ITEM)
ITEM_TYPE = ITEM.simpleString()
# One shape for every payload: a page with items, or an item; ``_end`` is our own mark.
PAGE = "items array<%s>, %s, _end string" % (
    ITEM_TYPE, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ITEM.fields)
)


def _parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``items``, from one parse of each payload.

    Items are those of an object with a list ``items``, of a bare list, or a lone
    item; null for anything else. The payload is read as the first of two values:
    with anything behind it, the mark is not the second.
    """
    payload = F.col("payload")
    page = F.when(F.ltrim(payload).startswith("["), F.concat(F.lit('{"items":'), payload, F.lit("}"))).otherwise(payload)
    marked = F.concat(F.lit("["), page, F.lit(',{"_end":"1"}]'))
    values = pages.withColumn("_values", F.from_json(marked, f"array<struct<{PAGE}>>"))
    sound = (F.size("_values") == 2) & (F.get("_values", F.lit(1))["_end"] == "1")
    first = F.get("_values", F.lit(0))
    lone = F.when(first["id"].isNotNull(), F.array(F.struct(*[first[f.name].alias(f.name) for f in ITEM.fields])))
    return values.withColumn("items", F.when(sound, F.coalesce(first["items"], lone))).drop("_values")


def page_items(pages: DataFrame) -> DataFrame:
    """One row per search item with an id; :func:`page_errors` has the rest."""
    # An inner explode would test the items below it, which parses them again.
    placed = _parsed(pages).select("query", "page_no", F.posexplode_outer("items").alias("position", "item"))
    return placed.select("query", "page_no", "position", *from_wire("item", SEARCH_ITEM)).filter(
        F.col("id").isNotNull()
    )


def page_errors(pages: DataFrame) -> DataFrame:
    """Pages that cannot be taken in whole: unreadable, or with an item without id."""
    nameless = F.exists("items", lambda item: whole_number(item["id"]).isNull())
    reason = F.when(F.col("items").isNull(), F.lit("unreadable")).when(
        nameless, F.lit("item without id")
    )
    judged = _parsed(pages).withColumn("reason", reason)
    return judged.filter("reason is not null").select("query", "page_no", "payload", "reason")


def page_metadata(pages: DataFrame) -> DataFrame:
    """Total and completeness flag of each query, from its first object page.

    A total that is no integer is null; a missing flag means complete. Only the
    two values are carried into the aggregation, never the payload.
    """
    facts = F.from_json("payload", "total_count string, incomplete_results boolean")
    return (
        pages.filter(F.ltrim("payload").startswith("{"))
        .select("query", "page_no", facts.alias("page"))
        .select(
            "query",
            "page_no",
            F.col("page.total_count").try_cast("bigint").alias("total"),
            F.coalesce("page.incomplete_results", F.lit(False)).alias("incomplete"),
        )
        .groupBy("query")
        .agg(
            F.min_by("total", "page_no").alias("total_count"),
            F.min_by("incomplete", "page_no").alias("incomplete_results"),
        )
    )


def completeness(metadata: DataFrame, cap: int = SEARCH_CAP) -> DataFrame:
    """Flag queries whose results exceed the cap; an unknown total does not."""
    return metadata.select(
        "query",
        F.coalesce(F.col("total_count") > cap, F.lit(False)).alias("over_cap"),
        F.col("incomplete_results").alias("incomplete"),
    )


def crawl_gate(flags: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """A crawl is complete only without a single warning.

    With ``errors``, those of :func:`page_errors`, their number counts as well.
    """
    gate = _warnings(flags)
    if errors is None:
        return gate
    bad = errors.agg(F.count("*").alias("page_errors"))
    return gate.join(F.broadcast(bad)).withColumn(
        "complete", F.col("complete") & (F.col("page_errors") == 0)
    )


def _warnings(flags: DataFrame) -> DataFrame:
    return flags.agg(
        F.count_if("over_cap").alias("cap_warnings"),
        F.count_if("incomplete").alias("incomplete_warnings"),
    ).withColumn(
        "complete", (F.col("cap_warnings") == 0) & (F.col("incomplete_warnings") == 0)
    )


def normalize_items(items: DataFrame, crawl_day: Column | str) -> DataFrame:
    """Search items as records of the day they were searched for."""
    return items.select(
        F.col("id").cast("bigint").alias("repo_id"),
        "full_name",
        "language",
        F.col("stargazers_count").cast("bigint").alias("stars"),
        F.col("forks_count").cast("bigint").alias("forks"),
        "created_at",
        "updated_at",
        "pushed_at",
        F.col("size").cast("bigint").alias("size_kb"),
        "default_branch",
        as_col(crawl_day).alias("crawl_day"),
        "archived",
        "topics",
        F.col("open_issues_count").cast("bigint").alias("open_issues_count"),
        F.lit(None).cast("string").alias("emitted_at"),
    )
