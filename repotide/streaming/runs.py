"""Running a stream to the end of its input, and tables kept per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"


OnBatch = Callable[[DataFrame, int], None]


def _writer(stream: DataFrame, checkpoint: str, on_batch: OnBatch, mode: str):
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )


def drain(
    stream: DataFrame, checkpoint: str, on_batch: OnBatch, mode: str = "append"
) -> StreamingQuery:
    """Process everything now in the source, then stop.

    Progress is committed only after ``on_batch`` returns; a batch interrupted
    before that is replayed with the same number and rows, so ``on_batch`` writes
    through :func:`write_batch`.
    """
    query = _writer(stream, checkpoint, on_batch, mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def follow(
    stream: DataFrame,
    checkpoint: str,
    on_batch: OnBatch,
    mode: str = "append",
    every: str = "30 seconds",
) -> StreamingQuery:
    """Like :func:`drain`, but goes on: what has arrived is flushed ``every`` interval."""
    return _writer(stream, checkpoint, on_batch, mode).trigger(processingTime=every).start()


def drain_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> None:
    """Append a stateless stream to Parquet; each row lands exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/{BATCH}={batch_id}"


def is_committed(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(marker)


def write_batch(rows: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Store the rows of one batch once, and return them as stored.

    A replay finds the batch committed and leaves its files alone. Reading the
    stored rows back keeps later steps from running the stream's plan again.
    """
    spark, path = rows.sparkSession, batch_path(root, batch_id)
    if not is_committed(spark, path):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def read_batch(spark: SparkSession, root: str, batch_id: int, schema) -> DataFrame:
    """Rows of one batch; none for the batch before the first."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(batch_path(root, batch_id))
