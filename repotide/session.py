"""Session settings the operators rely on, and where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime-settable; applied to whatever session the caller hands us.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split even when the split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A limit beyond this many rows is sorted and streamed, not held in memory.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Dedupe state grows with the number of repositories: keep it off-heap and
    # checkpoint only its changes.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Streams that hand batches to one another keep step only without empty batches.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

_local_root: str | None = None


def is_local(spark: SparkSession) -> bool:
    """One process on one machine; ``local-cluster`` is none."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF`; on a local master also size the shuffles.

    On a cluster ``spark.sql.shuffle.partitions`` stays as the cluster set it.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if is_local(spark):
        cores = spark.sparkContext.defaultParallelism
        if int(spark.conf.get("spark.sql.shuffle.partitions")) > cores:
            spark.conf.set("spark.sql.shuffle.partitions", str(cores))
    return spark


def build_session(app_name: str = "repotide", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` names it. Only a local master may go without: there
    the driver's own temporary folder is visible to every task.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="repotide-")
    return _local_root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path no earlier run has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def conf_set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Inside, a setting has this value."""
    before = spark.conf.get(key, None)
    if before == value:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Inside, the shuffle files of a write go when it ends, not when the driver
    happens to collect its garbage. A write's plan is its own, so no later query
    reads its shuffles; other queries belong outside.
    """
    return conf_set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Store a small result that several later steps read, and return it as stored.

    Lost executors do not lose it, and its size is known when it is joined.
    """
    path = fresh_dir(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
