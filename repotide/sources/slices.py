"""Slice store: rows by (date field, day, query) and version, and a manifest.

Every write goes into a version folder of its own. The manifest names a slice's
version only after its rows are committed, and readers take the newest version
named, so a listed slice is complete, is never seen half replaced, and is empty
when its last write had no rows for it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.columns import slice_id
from repotide.operators.counters import Counters
from repotide.operators.dedupe import distinct_records, limit_per_group
from repotide.operators.slicing import missing_slices, stored_slices
from repotide.session import materialize
from repotide.sources.topics import read_table

SLICE_KEYS = ["date_field", "crawl_day", "query_key"]
KEY_SCHEMA = "date_field string, crawl_day string, query_key string"


def with_query_key(slices: DataFrame, suffix: str = "query_suffix") -> DataFrame:
    """Name each slice's query so that different suffixes never share a slice."""
    return slices.withColumn("query_key", slice_id(suffix))


class SliceStore:
    """Rows of the given columns; ``schema`` leaves out the slice keys."""

    def __init__(self, spark: SparkSession, root: str, schema: str) -> None:
        self.spark = spark
        self.schema = f"{schema}, version string, {KEY_SCHEMA}"
        self.rows_path = f"{root}/rows"
        self.manifest_path = f"{root}/manifest"

    def manifest(self) -> DataFrame:
        """Complete slices, each once, with its newest version."""
        written = read_table(self.spark, self.manifest_path, f"{KEY_SCHEMA}, version string")
        return written.groupBy(*SLICE_KEYS).agg(F.max("version").alias("version"))

    def hits(self, requested: DataFrame) -> DataFrame:
        return stored_slices(requested, self.manifest(), SLICE_KEYS)

    def misses(self, requested: DataFrame) -> DataFrame:
        return missing_slices(requested, self.manifest(), SLICE_KEYS)

    def write(
        self, rows: DataFrame, slices: DataFrame, order: list, key: str | None = None, counters: Counters | None = None
    ) -> None:
        """Store the complete rows of ``slices``, deduplicated inside each slice.

        ``key`` defaults to :func:`own_key`. Rebalancing splits a slice that is
        much larger than the others over several files and joins small ones,
        instead of one task per slice. A slice without rows is complete too, so
        the manifest takes all of them.
        """
        # Sorts by time; the tail keeps apart what one moment writes twice.
        version = f"v{time.time_ns():020d}-{uuid.uuid4().hex}"
        if counters:
            rows = counters.watch(rows, "fetched")
        kept = distinct_records(rows, SLICE_KEYS, order, key)
        if counters:
            kept = counters.watch(kept, "written_to_cache")
        (
            kept.hint("rebalance", *SLICE_KEYS)
            .write.partitionBy(*SLICE_KEYS)
            .parquet(f"{self.rows_path}/version={version}")
        )
        listed = slices.select(*SLICE_KEYS).distinct().withColumn("version", F.lit(version))
        listed.write.mode("append").parquet(self.manifest_path)

    def read(self, requested: DataFrame | None = None) -> DataFrame:
        """Rows of complete slices, of the requested ones when given.

        The days asked for are looked up first, one row of bounds, so that other
        days are pruned from the scan by their folders; the join then picks the
        slices. ``requested`` is read several times: give a calendar or a table.
        """
        rows = read_table(self.spark, self.rows_path, self.schema)
        wanted = self.manifest()
        if requested is not None:
            asked = requested.select(*SLICE_KEYS).distinct()
            wanted = wanted.join(asked, SLICE_KEYS, "left_semi")
            first, last = wanted.agg(F.min("crawl_day"), F.max("crawl_day")).first()
            rows = rows.filter(F.col("crawl_day").between(first or "", last or ""))
        return rows.join(wanted, [*SLICE_KEYS, "version"], "left_semi").drop("version")

    def serve(
        self,
        requested: DataFrame,
        produced: DataFrame,
        order: list,
        key: str | None = None,
        limit: int | None = None,
        refresh: bool = False,
        limit_stored: bool = False,
        counters: Counters | None = None,
    ) -> DataFrame:
        """Rows of the requested slices: stored ones as stored, the others from
        ``produced``, deduplicated inside each slice.

        Without a limit the new slices are complete and are stored on the way. A
        ``limit`` takes that many rows of each produced slice before
        deduplication, and nothing is stored, since such slices are cut short on
        purpose; stored slices are served whole unless ``limit_stored``.
        ``refresh`` produces all requested slices anew, with a limit or without.

        ``counters`` are told how many rows were fetched, written and loaded, by
        the run itself.
        """
        requested = requested.select(*SLICE_KEYS)
        missing = requested.distinct() if refresh else self.misses(requested)
        if counters:
            # Slices, not rows; stored, as a write changes what is missing.
            missing = materialize(missing.distinct(), "missing")
            counters.slices(requested, missing)
        if limit is None:
            hits = requested.join(missing, SLICE_KEYS, "left_anti") if counters else None
            self.write(produced.join(missing, SLICE_KEYS, "left_semi"), missing, order, key, counters)
            if counters:
                return counters.watch(self.read(hits), "loaded_from_cache").unionByName(self.read(missing))
            return self.read(requested)
        fetched = produced.join(missing, SLICE_KEYS, "left_semi")
        fetched = limit_per_group(fetched, SLICE_KEYS, order, limit)
        if counters:
            fetched = counters.watch(fetched, "fetched")
        if refresh:
            return distinct_records(fetched, SLICE_KEYS, order, key)
        stored = self.read(requested)
        if counters:
            stored = counters.watch(stored, "loaded_from_cache")
        if limit_stored:
            stored = limit_per_group(stored, SLICE_KEYS, order, limit)
        return distinct_records(stored.unionByName(fetched), SLICE_KEYS, order, key)
