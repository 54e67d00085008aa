"""Each repository once, over the whole life of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.streaming.runs import drain
from repotide.streaming.tables import BatchTable


class FirstSeen:
    """The first record of every key, in the micro-batch that brings it.

    Arrival is the micro-batch, then ``order`` inside it. Repeats within a batch
    are combined in each task before the shuffle, so a key that is delivered over
    and over does not load one task; what is left goes through a deduplication
    whose state is the key alone. A key that is known already is read and not
    written, and the width of the records does not matter to the state.

    Exact counting keeps every key for good. ``forget_after``, such as
    ``"2 days"``, bounds the state instead: a key that comes again later than
    that after its first arrival counts as new.

    ``at_most`` stops at exactly that many keys. What is new beyond them is held
    back with its place in the order, and comes first when a later run allows more.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str = "repo_id",
        order: str = "seq",
        forget_after: str | None = None,
        at_most: int | None = None,
    ) -> None:
        self.spark, self.root, self.key, self.order = spark, root, key, order
        self.schema, self.forget_after, self.at_most = schema, forget_after, at_most
        arrived = T.StructType([*schema.fields, T.StructField("_arrived", T.TimestampType())])
        self.arrived = BatchTable(spark, f"{root}/arrived", arrived)
        self.first = BatchTable(spark, f"{root}/first", schema)
        held = T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])
        self.held = BatchTable(spark, f"{root}/held", held)
        self.candidates = BatchTable(spark, f"{root}/candidates", held)
        self.deliver = None
        # Progress of the last deduplication: rows of state, and how many were written.
        self.state: dict[str, int] = {}

    def take(self, records: DataFrame, batch_id: int, slices: int = 1) -> None:
        """Take in the records of a batch; new ones are handed to ``deliver`` before this returns.

        Repeats in a batch are told in ``slices`` of the keys, each of which reads all records.
        """
        payload = [c for c in self.schema.names if c != self.key]
        once = records.groupBy(self.key).agg(F.min_by(F.struct(*payload), self.order).alias("r"))
        self.arrived.write(
            once.select(self.key, "r.*").select(*self.schema.names, F.current_timestamp().alias("_arrived")),
            batch_id, slices=slices, key=self.key,
        )
        stream = self.arrived.stream().select(*self.arrived.schema.names)
        if self.forget_after:
            bounded = stream.withWatermark("_arrived", self.forget_after)
            distinct = bounded.dropDuplicatesWithinWatermark([self.key])
        else:
            distinct = stream.dropDuplicates([self.key])
        # Batches are taken in one by one, so here is exactly the one just stored.
        query = drain(distinct.select(*self.schema.names), f"{self.root}/_first", self._keep)
        progress = query.lastProgress
        if progress and progress["stateOperators"]:
            state = progress["stateOperators"][0]
            self.state = {"rows": state["numRowsTotal"], "written": state["numRowsUpdated"]}

    def _keep(self, batch: DataFrame, batch_id: int) -> None:
        if self.at_most is None and not self.held.has(batch_id - 1):
            new = self.first.write(batch, batch_id, stateful=True)
        else:
            new = self._bounded(batch, batch_id)
        if self.deliver:
            self.deliver(new, batch_id)

    def _bounded(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The next keys in order that the bound allows; the others are held back."""
        arrived = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        waiting = arrived
        if self.held.has(batch_id - 1):
            waiting = self.held.at(batch_id - 1).unionByName(arrived)
        waiting = self.candidates.write(waiting, batch_id, stateful=True)
        if self.at_most is None:
            return self.first.write(waiting.drop("_batch"), batch_id)
        left = max(self.at_most - self.first.read(batch_id - 1).count(), 0)
        in_order = waiting.orderBy("_batch", self.order, self.key)
        new = self.first.write(in_order.limit(left).drop("_batch"), batch_id)
        later = waiting.join(new.select(self.key), self.key, "left_anti")
        self.held.write(later.select(*self.held.schema.names), batch_id)
        return new
