"""The way in: each message is parsed once, and either taken in or set aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from repotide.streaming.runs import drain, follow
from repotide.streaming.tables import BatchTable, Newest

# Turns messages into records, or a ``payload`` with an ``error``.
Judge = Callable[[DataFrame, T.StructType], DataFrame]
Deliver = Callable[[DataFrame, int], None]


class Intake:
    """Fit records and unfit messages of a topic, both kept under ``root``.

    A micro-batch is judged in one pass and stored in one write, whose folders
    part the fit from the unfit. A batch that is replayed finds its rows stored.
    ``deliver`` gets the fit records of each batch, as stored, before the batch
    counts as done; it must bear being called again with the same number.
    """

    def __init__(
        self, spark: SparkSession, root: str, judge: Judge, schema: T.StructType, deliver: Deliver | None = None
    ) -> None:
        self.spark, self.root, self.judge, self.schema, self.deliver = spark, root, judge, schema, deliver
        judged = T.StructType(
            [*schema.fields, T.StructField("payload", T.StringType()), T.StructField("error", T.StringType()),
             T.StructField("fit", T.BooleanType())]
        )
        self.judged = BatchTable(spark, f"{root}/judged", judged, split_by=("fit",))
        self.newest = Newest(spark, f"{root}/judged-newest")

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        judged = self.judge(batch.filter(F.trim("value") != ""), self.schema).withColumn("fit", F.col("error").isNull())
        stored = self.judged.write(judged, batch_id)
        if self.deliver:
            self.deliver(self._fit(stored), batch_id)
        self.newest.set(batch_id)

    def _fit(self, judged: DataFrame) -> DataFrame:
        return judged.filter("fit").select(*self.schema.names)

    def run(self, messages: DataFrame) -> None:
        """Take in all messages now in the topic; resumes where the last run stopped."""
        drain(messages, f"{self.root}/_intake", self._take)

    def follow(self, messages: DataFrame, every: str = "30 seconds") -> StreamingQuery:
        return follow(messages, f"{self.root}/_intake", self._take, every=every)

    def records(self) -> DataFrame:
        return self._fit(self.judged.read(self.newest.get()))

    def unfit(self) -> DataFrame:
        """``payload, error`` of every message set aside."""
        return self.judged.read(self.newest.get()).filter("not fit").select("payload", "error")
