"""Live enrichment: a repository goes on when all its lookups have an outcome.

A lookup that failed, for want of quota or of an answer, tells nothing. Its
repository waits, and is enriched once in the batch that brings the last missing
outcome; until then no record says that it has no tests.

Tables under ``root``, one part per micro-batch: ``repos`` and ``outcomes`` as
they came, unfit messages among them; ``open`` the lookups without an outcome
after the batch; ``waiting`` the repositories they hold up; ``enriched``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.operators.enrich import best_evidence, enrich, path_evidence
from repotide.session import materialize
from repotide.sources.topics import judge_messages
from repotide.streaming.runs import drain
from repotide.streaming.tables import BatchTable, Newest

# One answer to a path lookup; ``content`` is base64, of files alone.
OUTCOME = T.StructType(
    [
        T.StructField("full_name", T.StringType()),
        T.StructField("branch", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("content", T.StringType()),
    ]
)
LOOKUP = ["full_name", "branch", "path"]
UNFIT = [T.StructField("payload", T.StringType()), T.StructField("error", T.StringType()), T.StructField("fit", T.BooleanType())]


def has_outcome(status: str = "status"):
    """Found or absent; any other error leaves the question open."""
    return (F.col(status) < 400) | (F.col(status) == 404)


def latest_outcomes(rows: DataFrame) -> DataFrame:
    """One row per lookup: an outcome if there is one, else the last failure."""
    better = F.struct(has_outcome().alias("known"), F.struct("status", "content").alias("v"))
    one = rows.groupBy(*LOOKUP).agg(F.max(better).alias("b"))
    return one.select(*LOOKUP, "b.v.*")


def _matched(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str) -> DataFrame:
    """``left`` semi or anti joined to ``right``; a null branch is a branch, a null name matches nothing."""
    other = right.select(*[F.col(theirs).alias(f"_{mine}") for mine, theirs in keys.items()]).distinct()
    same = F.lit(True)
    for mine in keys:
        both = F.col(mine), F.col(f"_{mine}")
        same = same & (both[0].eqNullSafe(both[1]) if "branch" in mine else both[0] == both[1])
    return left.join(other, same, how)


PLACE = {"full_name": "full_name", "branch": "branch"}


class LiveEnrichment:
    """``stats`` and ``evidence`` are the lookups that are known, ``failed`` those to
    be tried again (``full_name, branch, path``); all are stored once at the start."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        stats: DataFrame,
        evidence: DataFrame,
        failed: DataFrame | None = None,
    ) -> None:
        self.spark, self.root, self.schema = spark, root, schema
        self.stats, self.evidence = materialize(stats, "stats"), materialize(evidence, "evidence")
        none = spark.createDataFrame([], "full_name string, branch string, path string")
        self.failed = materialize(none if failed is None else failed.select(*LOOKUP).distinct(), "failed")
        self.repos = BatchTable(spark, f"{root}/repos", T.StructType([*schema.fields, *UNFIT]), split_by=("fit",))
        self.outcomes = BatchTable(spark, f"{root}/outcomes", T.StructType([*OUTCOME.fields, *UNFIT]), split_by=("fit",))
        self.known = BatchTable(spark, f"{root}/known", OUTCOME, latest_outcomes)
        self.open = BatchTable(spark, f"{root}/open", self.failed.schema)
        self.waiting = BatchTable(spark, f"{root}/waiting", schema)
        empty = spark.createDataFrame([], schema)
        self.done = BatchTable(spark, f"{root}/enriched", enrich(empty, self.stats, self.evidence).schema)
        self.newest = Newest(spark, f"{root}/newest")

    def run(self, repos: DataFrame, outcomes: DataFrame | None = None) -> None:
        """Take in all messages now in the topics; resumes where the last run stopped."""
        messages = repos.select(F.lit("repo").alias("kind"), "value")
        if outcomes is not None:
            messages = messages.union(outcomes.select(F.lit("outcome").alias("kind"), "value"))
        drain(messages, f"{self.root}/_enrich", self._take)

    def _judged(self, table: BatchTable, messages: DataFrame, schema: T.StructType, batch_id: int) -> DataFrame:
        judged = judge_messages(messages, schema)
        if "repo_id" not in schema.names:
            lost = F.col("error").isNull() & F.expr("full_name is null or path is null or status is null")
            judged = judged.withColumn("payload", F.when(lost, F.to_json(F.struct(*schema.names))).otherwise(F.col("payload")))
            judged = judged.withColumn("error", F.when(lost, F.lit("no lookup")).otherwise(F.col("error")))
        stored = table.write(judged.withColumn("fit", F.col("error").isNull()), batch_id)
        return stored.filter("fit").select(*schema.names)

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        new = self._judged(self.repos, batch.filter("kind = 'repo'"), self.schema, batch_id)
        answers = self._judged(self.outcomes, batch.filter("kind = 'outcome'"), OUTCOME, batch_id)
        self.known.write(latest_outcomes(answers), batch_id)
        known = self.known.read(batch_id).filter(has_outcome())

        here = new.select("full_name", F.col("default_branch").alias("branch"))
        asked = _matched(self.failed, here, PLACE, "left_semi")
        still = self.open.at(batch_id - 1).unionByName(asked).distinct()
        still = self.open.write(_matched(still, known, {k: k for k in LOOKUP}, "left_anti"), batch_id)

        home = {"full_name": "full_name", "default_branch": "branch"}
        present = self.waiting.at(batch_id - 1).unionByName(new)
        self.waiting.write(_matched(present, still, home, "left_semi"), batch_id)
        released = _matched(present, still, home, "left_anti")

        places = released.select("full_name", F.col("default_branch").alias("branch"))
        found = path_evidence(_matched(known.filter("status < 400"), places, PLACE, "left_semi"))
        evidence = best_evidence(_matched(self.evidence, places, PLACE, "left_semi"), found)
        self.done.write(enrich(released, self.stats, evidence), batch_id)
        self.newest.set(batch_id)

    def enriched(self) -> DataFrame:
        return self.done.read(self.newest.get())

    def pending(self) -> DataFrame:
        """Repositories that wait for an outcome."""
        return self.waiting.at(self.newest.get())

    def unfit(self) -> DataFrame:
        rows = [t.read(self.newest.get()).filter("not fit").select("payload", "error") for t in (self.repos, self.outcomes)]
        return rows[0].unionByName(rows[1])
