"""Cross-site boilerplate lines, removed by DataFrame operations alone.

A HyperLogLog sketch per line hash counts the distinct sites a line stands on;
sketches merge by aggregation, so a line found in a third of all documents costs
one partial sketch per task. Estimates clearly off the limit decide at once.
Lines near it, in a margin of several standard errors, get exact distinct
counts. A line on ``min_sites`` sites or more is boilerplate: its first
occurrence, by ``doc_id`` and position, stays, so that no content is lost; all
others go. Lines are compared as they are; blank lines always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import materialize, unused

MIN_SITES = 10
# 4096 registers: a standard error of 1.6 %, exact for small counts.
SKETCH_BITS = 12
MARGIN = 0.1


def _key(*columns: str) -> Column:
    """96 bits: two documents or lines with the same key are the same."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.hash(*columns).alias("b"))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """``doc, doc_id, pos, site, line`` (keys only) of every line that is not blank."""
    return (
        docs.select(
            _key("doc_id", "text").alias("doc"),
            "doc_id",
            F.col(site).cast("string").alias("site"),
            F.posexplode(F.split("text", "\n")).alias("pos", "_line"),
        )
        .filter(F.trim("_line") != "")
        .select("doc", "doc_id", "site", "pos", _key("_line").alias("line"))
    )


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``line, first_id, first_doc, first_pos`` of the lines on ``min_sites`` sites or more."""
    lines = _lines(docs, site)
    place = F.struct("doc_id", "doc", "pos")
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
        F.min(place).alias("first"),
    )
    likely = materialize(sketched.filter(F.col("sites") >= min_sites * (1 - MARGIN)), "lines")
    sure = likely.filter(F.col("sites") >= min_sites * (1 + MARGIN)).select("line", "first")
    near = likely.filter(F.col("sites") < min_sites * (1 + MARGIN)).select("line", "first")
    counted = (
        lines.join(near.select("line"), "line", "left_semi")
        .groupBy("line")
        .agg(F.countDistinct("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
        .select("line")
    )
    return sure.union(near.join(counted, "line"))


def remove_boilerplate(
    docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``docs`` with its texts less the boilerplate, and ``n_lines``, ``n_removed``.

    Rows and all other columns stay as they are (columns named like the two
    counts are replaced). A null text stays null with no lines; an empty one has
    one blank line. Rows without a site count for no site. Fully repeated rows
    are treated as one document. ``text`` is empty where every line went.
    """
    kept = docs.select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")])
    return _without(kept, site, min_sites, "n_lines", "n_removed")


def _without(docs: DataFrame, site: str, min_sites: int, n_lines: str, n_removed: str) -> DataFrame:
    """All columns of ``docs``, and the two counts under names that it does not use."""
    columns = docs.columns
    doc, parts, gone = (unused([*columns, n_lines, n_removed], c) for c in ("doc", "parts", "gone"))
    found = materialize(boilerplate(docs, site, min_sites), "boilerplate")
    repeats = (
        _lines(docs, site)
        .join(found, "line")
        .filter((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
        .select(F.col("doc").alias(doc), "pos")
        .distinct()
        .groupBy(doc)
        .agg(F.array_sort(F.collect_list("pos")).alias(gone))
    )
    # What stays are the stretches between lines that go, so each line is copied once.
    before = F.concat(F.array(F.lit(-1)), F.col(gone))
    behind = F.concat(F.col(gone), F.array(F.size(parts)))
    stays = F.flatten(F.zip_with(before, behind, lambda a, b: F.slice(F.col(parts), a + 2, b - a - 1)))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return (
        docs.withColumn(doc, _key("doc_id", "text"))
        .join(repeats, doc, "left")
        .withColumn(parts, F.split("text", "\n"))
        .select(
            *(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns),
            F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias(n_lines),
            F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_removed),
        )
    )


def cleaned(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The pipeline's form: own columns, less documents of which nothing is left."""
    n_lines, n_removed = (unused(docs.columns, c) for c in ("n_lines", "n_removed"))
    kept = _without(docs, site, min_sites, n_lines, n_removed)
    emptied = (F.col(n_removed) > 0) & (F.trim(F.regexp_replace("text", "\n", "")) == "")
    return kept.filter(~F.coalesce(emptied, F.lit(False))).select(*(F.col(f"`{c}`") for c in docs.columns))
