"""Equi join that spreads the keys known to be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 1024
MIN_HOT_ROWS = 1_000_000
SALTS = 64


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    key_counts: DataFrame,
    salt_from: str,
    min_hot_rows: int = MIN_HOT_ROWS,
    salts: int = SALTS,
    how: str = "inner",
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (one row per key), splitting hot keys.

    ``key_counts`` has the keys and ``n``, the rows per key. The hot keys are the
    heaviest :data:`MAX_HOT_KEYS` with at least ``min_hot_rows``: a list bounded
    by construction, hence broadcast, and any key outside it holds less than
    one in ``MAX_HOT_KEYS`` of all rows. Hot lookup rows are copied ``salts``
    times, hot rows take one of the copies by a hash of ``salt_from``.
    """
    hot = (
        key_counts.filter(F.col("n") >= min_hot_rows)
        .orderBy(F.desc("n"), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*keys, F.lit(True).alias("_hot"))
    )
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int"))
    left = (
        rows.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = (
        lookup.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
