"""Shards by a two-pass external shuffle.

The shard of a row is a consistent hash of its id and the number of shards:
with one shard more, rows move into the new shard only. The first pass scatters
the rows of each shard into buckets by a seeded hash, as many as keep a bucket
within a task's memory. The second pass reads each bucket in a canonical order
and deals it the slots of a seeded Fisher-Yates shuffle, so that the whole shard
is in random order, the same at every run. Only the slots of a bucket are held
in memory; the rows stream past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from repotide.llm.common import prepare, unused

SHARDS = 40
BUCKET_BYTES = 32 << 20
SEED = 7
# Bytes of a row besides its text.
ROW_BYTES = 16


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shard_of(doc_id: str, shards: int, seed: int = SEED) -> Column:
    """The shard, of ``shards``, whose hash with the id is largest.

    A further shard can only win rows for itself. Rows without id share a shard.
    """
    draws = F.array(
        *(F.struct(F.xxhash64(F.lit(seed), F.lit(i), doc_id).alias("draw"), F.lit(i).alias("shard"))
          for i in range(shards))
    )
    return F.array_max(draws)["shard"]


def _bucket_of(buckets: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(buckets)).cast("int")


def _deal(seed: int, columns: list[str], places: tuple[str, ...]):
    """Give the rows of each bucket, which follow each other, their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, slots, used = None, np.empty(0, np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, bucket, base, rows = (
                batch.column(batch.schema.names.index(c)).to_numpy()
                for c in places
            )
            changes = np.flatnonzero((shard[1:] != shard[:-1]) | (bucket[1:] != bucket[:-1])) + 1
            edges = [0, *changes.tolist(), batch.num_rows]
            dealt = np.empty(batch.num_rows, np.int64)
            for start, end in zip(edges, edges[1:]):
                here = int(shard[start]), int(bucket[start])
                if here != at:
                    at, used = here, 0
                    slots = np.arange(base[start], base[start] + rows[start])
                    np.random.default_rng([seed, *here]).shuffle(slots)
                dealt[start:end] = slots[used : used + end - start]
                used += end - start
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(dealt)], names=[*columns, "slot"])

    return run


def shuffled(
    docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """``docs`` with ``shard``, ``grown_shard`` and ``slot``, gapless from 0 in each shard.

    ``docs`` needs ``doc_id`` and ``text``; all its columns stay (those named
    like the new ones are replaced). A null text counts no bytes. Rows of one id
    share a shard and spread over its buckets by their text; of rows alike in
    both, any may get any of their slots. Empty input gives no rows.
    """
    prepare(docs.sparkSession)
    given = ("shard", "grown_shard", "slot")
    own = [c for c in docs.columns if c.lower() not in given]
    bucket, base, rows = (unused([*own, *given], c) for c in ("bucket", "base", "rows"))
    total = docs.agg(F.sum(size_of())).first()[0] or 0
    # Twice the buckets that would do if hashes were even.
    buckets = max(1, -(-2 * total // (shards * bucket_bytes)))
    scattered = docs.select(
        *own,
        shard_of("doc_id", shards, seed).alias("shard"),
        shard_of("doc_id", shards + 1, seed).alias("grown_shard"),
        _bucket_of(buckets, seed).alias(bucket),
    )
    sizes = scattered.groupBy("shard", bucket).agg(F.count("*").alias(rows))
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn(base, F.coalesce(F.sum(rows).over(before), F.lit(0)))
    columns = [*own, "shard", "grown_shard"]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The explicit exchange keeps a bucket in one task, whatever the join does.
    ready = (
        scattered.join(bases, ["shard", bucket])
        # As many tasks as keep one bucket's bytes each, if the session has fewer.
        .repartition(max(tasks, -(-total // bucket_bytes)), "shard", bucket)
        .sortWithinPartitions("shard", bucket, "doc_id", F.xxhash64("text"))
    )
    schema = scattered.select(*columns).schema.add("slot", LongType())
    return ready.mapInArrow(_deal(seed, columns, ("shard", bucket, base, rows)), schema)


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder per shard, its files and their rows in the order of the slots."""
    (
        dealt.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
