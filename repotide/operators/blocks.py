"""Numbering and looking back over a whole table, in many tasks.

The rows are sorted into blocks, one per task, and stored. Within a block each
task works alone; what it needs of the blocks before is one number or one row of
each, of which there are no more than tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.session import materialize

# A row's id holds its block above, and its place in the block below, this bit.
_PLACE_BITS = 33


def _blocks(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in order, as stored blocks: ``_block`` ascends with the order, ``_place`` within."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", at)
        .withColumn("_block", F.shiftright("_at", _PLACE_BITS))
        .withColumn("_place", F.col("_at") - F.shiftleft("_block", _PLACE_BITS))
        .drop("_at")
    )
    return materialize(placed, "blocks")


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """``df`` with its rows numbered from 0 in ``order``, without gaps."""
    placed = _blocks(df, order)
    sizes = placed.groupBy("_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per block.
    return (
        placed.join(F.broadcast(starts), "_block")
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_block", "_place", "_start")
    )


def lagged(df: DataFrame, keys: list[str], order: str, column: str, name: str) -> DataFrame:
    """``df`` with the ``column`` of the row before, in ``order``, of the same ``keys``."""
    placed = _blocks(df, [*keys, order])
    inside = Window.partitionBy("_block", *keys).orderBy("_place")
    last = placed.groupBy("_block", *keys).agg(F.max_by(F.struct(column), "_place").alias("_last"))
    carried = last.withColumn(
        "_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block"))
    ).drop("_last")
    own: Column = F.when(F.row_number().over(inside) == 1, F.lit(None)).otherwise(F.struct(F.lag(column).over(inside).alias(column)))
    same = [F.col("_block") == F.col("_border"), *(F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys)]
    borders = carried.select(F.col("_block").alias("_border"), "_carried", *(F.col(k).alias(f"_own_{k}") for k in keys))
    # One row per block and key, of which a block that holds several is their border.
    return (
        placed.withColumn("_before", own)
        .join(borders, same, "left")
        .withColumn(name, F.coalesce("_before", "_carried")[column])
        .select(*df.columns, name)
    )
