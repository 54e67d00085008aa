"""First-record-wins deduplication, limits, and their accounting.

``row_number() <= k`` is planned with a per-task group limit ahead of the
shuffle, so of a hot key each task sends at most ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.columns import own_key

# Largest k for which Spark plans the group limit ahead of the shuffle
# (``spark.sql.optimizer.windowGroupLimitThreshold``).
GROUP_LIMIT_THRESHOLD = 1000
GROUP_SALTS = 64


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Earliest row of each key under ``order``, whole."""
    return limit_per_group(df, keys, order, 1)


def distinct_records(
    df: DataFrame, within: Sequence[str], order: Sequence[Column | str], key: str | None = None
) -> DataFrame:
    """Earliest row of each record inside each ``within`` group.

    Records are the same by column ``key``, if given, else by :func:`own_key`:
    those without an id are told apart by name, and never collapse into one.
    """
    same = F.col(key).cast("string") if key else own_key(df.columns)
    return first_seen(df.withColumn("_same", same), [*within, "_same"], order).drop("_same")


def limit_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int
) -> DataFrame:
    """First ``k`` rows of each group under ``order``; exact for every k.

    Beyond the planner's threshold the limit runs twice, first inside salted
    parts of the group, so that no task sorts a whole hot group.
    """
    if k < 1:
        raise ValueError("limit must be at least 1")
    if k > GROUP_LIMIT_THRESHOLD:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(GROUP_SALTS))
        df = _row_limit(df.withColumn("_salt", salt), [*keys, "_salt"], order, k).drop("_salt")
    return _row_limit(df, keys, order, k)


def _row_limit(df, keys, order, k):
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pos", F.row_number().over(window)).filter(F.col("_pos") <= k).drop("_pos")


def limit_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows overall: a top-k per task, then one of those."""
    if n < 1:
        raise ValueError("limit must be at least 1")
    return df.orderBy(*order).limit(n)


def tightest_limit(*limits: int | None) -> int | None:
    """Smallest of the limits that are set."""
    present = [limit for limit in limits if limit is not None]
    return min(present) if present else None


def dedupe_accounting(
    df: DataFrame,
    slice_columns: Sequence[str],
    key: str,
    slice_order: Sequence[Column],
) -> DataFrame:
    """Per slice: rows fetched, repeats inside it, repeats of other slices, emitted.

    Rows are counted per (slice, key) before anything is compared between
    slices, so the window sees one row per slice of a key however hot it is.
    """
    per_key = df.groupBy(*slice_columns, key).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*slice_order))
    return (
        per_key.withColumn("_place", place)
        .groupBy(*slice_columns)
        .agg(
            F.sum("n").alias("fetched"),
            F.sum(F.col("n") - 1).alias("duplicate_in_slice"),
            F.count_if(F.col("_place") > 1).alias("duplicate_global"),
            F.count_if(F.col("_place") == 1).alias("emitted"),
        )
    )


def without(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``.

    Repeats in ``done`` are dropped ahead of the join's shuffle, which also
    serves that; so only ``df`` can be skewed, and its side can be split.
    """
    return df.join(done.select(key).distinct(), key, "left_anti")
