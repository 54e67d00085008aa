"""Connected components of a link table, kept in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotide.llm.common import materialize


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)``; root is the smallest id.

    Large-star and small-star rounds by turns: each hangs the neighbours of a
    node on the smallest of them, until nothing changes, in a number of rounds
    logarithmic in the component size. A node with very many links costs one
    partially aggregated minimum and one join whose other side is unique per
    key, so the planner can split it. Only two numbers per round reach the
    driver. Links with a null end and self links are ignored; without links the
    result is empty.
    """
    edges = materialize(
        links.select("u", "v").filter("u is not null and v is not null and u <> v").distinct(),
        "links",
    )
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = (
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        down = large.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = materialize(small, "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    hung = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = hung.select(F.col("root").alias("node"), "root").distinct()
    return hung.union(roots)
