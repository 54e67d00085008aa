"""A crawl from slices to distinct, stamped records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from repotide.functions.columns import emit_stamp
from repotide.operators.counters import Counters
from repotide.operators.dedupe import distinct_records, limit_rows
from repotide.sources.slices import SliceStore


def crawl_window(
    store: SliceStore,
    requested: DataFrame,
    produced: DataFrame,
    slice_order: list,
    arrival_order: list,
    key: str | None = None,
    limit_per_slice: int | None = None,
    limit: int | None = None,
    counters: Counters | None = None,
) -> DataFrame:
    """Records of the requested slices, each repository once, first arrival first.

    ``limit_per_slice`` counts rows before deduplication, ``limit`` counts
    distinct repositories. Records are stamped last, so that rows stored in
    slices stay unstamped. ``counters`` are complete when the result has been
    computed once.
    """
    rows = store.serve(requested, produced, slice_order, key, limit_per_slice, counters=counters)
    unique = distinct_records(rows, [], arrival_order, key)
    if counters:
        unique = counters.watch(unique, "unique")
    if limit is not None:
        unique = limit_rows(unique, arrival_order, limit)
        if counters:
            unique = counters.watch(unique, "emitted")
    return unique.withColumn("emitted_at", emit_stamp())
