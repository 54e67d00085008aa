"""Tables that grow by one part per micro-batch, merged level by level.

Batch ``n`` is stored once under ``level=0``. Whenever the parts of ``FAN``
neighbours are complete they are merged into one of the next level, so the first
``n`` batches are covered by at most ``(FAN - 1) * log(n)`` parts, which follow
from ``n`` alone. A replayed batch finds its parts stored and changes nothing.
Old parts are not removed: readers of earlier batches may still be at work, and
the folder's expiry rule sees to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.session import conf_set, shuffles_freed
from repotide.sources.topics import read_table
from repotide.streaming.runs import BATCH, is_committed

FAN = 8
FOLDERS = 4


def cover(batch_id: int, fan: int = FAN) -> list[tuple[int, int]]:
    """``(level, last batch)`` of the parts that hold batches 0 to ``batch_id``."""
    parts, start, left = [], 0, batch_id + 1
    size, level = 1, 0
    while size * fan <= left:
        size, level = size * fan, level + 1
    while left > 0:
        while size > left:
            size, level = size // fan, level - 1
        start, left = start + size, left - size
        parts.append((level, start - 1))
    return parts


class BatchTable:
    """``fold`` reduces merged rows, such as to the latest of each key; null keeps all."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema,
        fold: Callable[[DataFrame], DataFrame] | None = None,
        fan: int = FAN,
        split_by: tuple[str, ...] = (),
    ) -> None:
        self.spark, self.root, self.schema = spark, root, schema
        self.fold, self.fan, self.split_by = fold, fan, split_by

    def _part(self, level: int, batch_id: int) -> str:
        return f"{self.root}/level={level}/{BATCH}={batch_id}"

    def stream(self) -> DataFrame:
        """The batches as they are stored, as a stream; :data:`BATCH` tells them apart."""
        return self.spark.readStream.schema(self.schema).parquet(f"{self.root}/level=0")

    def write(
        self, rows: DataFrame, batch_id: int, stateful: bool = False, slices: int = 1, key: str | None = None
    ) -> DataFrame:
        """Store the rows of a batch once, and return them as stored.

        Rows of a ``stateful`` stream are computed even when they are stored
        already: a replay has to bring the state up to the batch. ``slices`` by
        ``key`` are computed one after another, each with a shuffle of its own.
        """
        path = self._part(0, batch_id)
        if not is_committed(self.spark, path):
            self._store(rows, path, slices, key)
        elif stateful:
            rows.write.format("noop").mode("overwrite").save()
        self._merge(batch_id)
        return self.at(batch_id)

    def _store(self, rows: DataFrame, path: str, slices: int = 1, key: str | None = None) -> None:
        for n in range(slices):
            own = rows.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == n) if slices > 1 else rows
            writer = own.write.mode("append" if n else "overwrite").option("compression", "zstd")
            # Only the last slice marks the part as committed.
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(n == slices - 1).lower())
            if self.split_by:
                writer = writer.partitionBy(*self.split_by)
            # A task writes its few folders side by side, and has nothing to sort for that.
            open_files = conf_set(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(FOLDERS))
            with shuffles_freed(rows.sparkSession), open_files:
                writer.parquet(path)

    def _merge(self, batch_id: int) -> None:
        size, level = self.fan, 1
        while (batch_id + 1) % size == 0:
            path = self._part(level, batch_id)
            if not is_committed(self.spark, path):
                step = size // self.fan
                merged = self._read([(level - 1, batch_id - i * step) for i in range(self.fan)])
                # Files of the size that adaptive execution aims at, not one per part.
                self._store((self.fold(merged) if self.fold else merged).hint("rebalance"), path)
            size, level = size * self.fan, level + 1

    def _read(self, parts: list[tuple[int, int]]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        frames = [self.spark.read.schema(self.schema)]
        if self.split_by:
            # Each part has folders of its own.
            found = [self.spark.read.schema(self.schema).parquet(self._part(*p)) for p in parts]
            whole = found[0]
            for other in found[1:]:
                whole = whole.unionByName(other)
            return whole
        return frames[0].parquet(*(self._part(*p) for p in parts))

    def has(self, batch_id: int) -> bool:
        return batch_id >= 0 and is_committed(self.spark, self._part(0, batch_id))

    def at(self, batch_id: int) -> DataFrame:
        """Rows of one batch; none for the batch before the first."""
        return self._read([(0, batch_id)] if batch_id >= 0 else [])

    def read(self, batch_id: int) -> DataFrame:
        """Rows of all batches up to ``batch_id``, folded."""
        rows = self._read(cover(batch_id, self.fan) if batch_id >= 0 else [])
        return self.fold(rows) if self.fold else rows


class Newest:
    """The number of the newest complete batch, in two places written by turns.

    While one is written the other holds, so a reader always finds a number that
    was complete.
    """

    SCHEMA = "newest bigint"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _slot(self, batch_id: int) -> str:
        return f"{self.root}/slot={batch_id % 2}"

    def set(self, batch_id: int) -> None:
        row = self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("newest"))
        row.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id))

    def get(self) -> int:
        """-1 before the first batch."""
        found = [read_table(self.spark, self._slot(i), self.SCHEMA).collect() for i in (0, 1)]
        return max((r["newest"] for rows in found for r in rows), default=-1)
