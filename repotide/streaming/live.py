"""Live rankings: all four questions after each micro-batch, and a history of them.

A message goes through three streams that keep step. The intake parses it once;
its batch is handed to the deduplication, and what is new there to the counters,
before the batch counts as done. So batch ``n`` of every table speaks of the same
messages, which is the common mark of the history. A run that was broken off
replays its batch: each step finds what it has stored, and the rest goes on.

Tables under ``root``, see :mod:`repotide.streaming.tables`:

* ``judged`` - records, and messages that are none,
* ``first`` - the repositories new in the batch,
* ``counters`` - counters that changed, of languages and of project names,
* ``languages`` - counters after the batch, one row per language,
* ``reserve`` - the highest project names, more than the ranking shows,
* ``rankings`` - the four rankings after the batch,
* ``snapshots`` - when the batch was counted, repositories so far, ranking length.

The cost of a batch follows the batch, the number of languages and the reserve,
not the number of repositories seen so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repotide.functions.columns import emit_stamp
from repotide.operators.delivery import unpack_envelopes
from repotide.operators.rankings import counters, rank_questions, unpivot_questions
from repotide.schemas import (
    DEFAULT_TOP_N,
    Q_LANGUAGES,
    Q_PROJECTS,
    Q_TESTS,
    Q_TESTS_CI,
    RANKED_REPO,
)
from repotide.streaming.first_seen import FirstSeen
from repotide.streaming.intake import Intake
from repotide.streaming.runs import drain
from repotide.streaming.tables import BatchTable, Newest

MEASURES = {"projects": Q_LANGUAGES, "with_tests": Q_TESTS, "with_tests_ci": Q_TESTS_CI}
COUNTERS = "kind string, name string, projects bigint, with_tests bigint, with_tests_ci bigint, commits bigint, at bigint"
LANGUAGES = "name string, projects bigint, with_tests bigint, with_tests_ci bigint"
RESERVE = "name string, count bigint, floor boolean"
RANKINGS = "batch_id bigint, question string, rk bigint, name string, count bigint"
STATE = "struct<projects:bigint,with_tests:bigint,with_tests_ci:bigint,commits:bigint,seq:bigint>"
# A larger batch is freed of its repeats in slices, of which at most ``SLICES`` read it again.
SLICE_RECORDS, SLICES = 2_000_000, 4
SNAPSHOTS = "batch_id bigint, processed_unique bigint, top_n bigint, recorded_at string"


def latest_counters(rows: DataFrame) -> DataFrame:
    """The newest state of each counter."""
    values = [c for c in rows.columns if c not in ("kind", "name")]
    newest = rows.groupBy("kind", "name").agg(F.max_by(F.struct(*values), "at").alias("v"))
    return newest.select("kind", "name", "v.*").select(*rows.columns)


class Reserve:
    """The highest counts of names that rise and fall, beyond the ranking's length.

    The floor is the last entry kept when the reserve was cut: every name outside
    ranks behind it. A name that falls behind the floor leaves; one that rises
    past it enters. As long as ``top_n`` entries are left they are the ranking.
    Only when there are fewer are all names looked at again.
    """

    def __init__(self, table: BatchTable, top_n: int, extra: int) -> None:
        self.table, self.top_n, self.keep = table, top_n, top_n + extra

    def update(self, changed: DataFrame, everything, batch_id: int) -> tuple[DataFrame, bool]:
        """The reserve after ``changed (name, count)``, and whether all names were needed.

        ``everything`` gives all names with their counts, ``changed`` included.
        """
        before = self.table.at(batch_id - 1)
        floors = before.filter("floor").collect()
        floor = (floors[0]["count"], floors[0]["name"]) if floors else None
        kept = before.filter("not floor").join(changed.select("name"), "name", "left_anti")
        risen = changed.filter(_not_behind(floor)) if floor else changed
        entries = self._top(kept.select("name", "count").unionByName(risen))
        recomputed = floor is not None and len(entries) < self.top_n
        if recomputed:
            floor, entries = None, self._top(everything())
        if len(entries) > 2 * self.keep:
            entries = entries[: self.keep]
            floor = entries[-1][1], entries[-1][0]
        rows = [(name, count, False) for name, count in entries]
        if floor:
            rows.append((floor[1], floor[0], True))
        spark = changed.sparkSession
        return self.table.write(spark.createDataFrame(rows, RESERVE), batch_id), recomputed

    def _top(self, counts: DataFrame) -> list[tuple[str, int]]:
        """At most one more than twice what is kept, by rank."""
        best = counts.orderBy(F.desc("count"), "name").limit(2 * self.keep + 1)
        return [(r["name"], r["count"]) for r in best.select("name", "count").collect()]


def _not_behind(floor: tuple[int, str]) -> Column:
    count, name = F.col("count"), F.col("name")
    return (count > floor[0]) | ((count == floor[0]) & (name <= floor[1]))


class LiveRankings:
    """``reserve`` is how many more names than ``top_n`` are held ready.

    With ``max_repos`` the run counts exactly that many repositories; those that
    arrive later are held back, in order, until a run with a higher bound.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        top_n: int = DEFAULT_TOP_N,
        reserve: int = 100,
        forget_after: str | None = None,
        max_repos: int | None = None,
    ) -> None:
        self.spark, self.root, self.top_n = spark, root, top_n
        self.intake = Intake(spark, root, unpack_envelopes, RANKED_REPO, self._distinct)
        self.first_seen = FirstSeen(
            spark, root, RANKED_REPO, forget_after=forget_after, at_most=max_repos
        )
        self.first_seen.deliver = self._count
        self.counters = BatchTable(spark, f"{root}/counters", COUNTERS, latest_counters)
        self.languages = BatchTable(spark, f"{root}/languages", LANGUAGES)
        self.reserve = Reserve(BatchTable(spark, f"{root}/reserve", RESERVE), top_n, reserve)
        self.rankings = BatchTable(spark, f"{root}/rankings", RANKINGS)
        self.snapshot_log = BatchTable(spark, f"{root}/snapshots", SNAPSHOTS)
        self.newest = Newest(spark, f"{root}/newest")
        # Batches for which the reserve did not do.
        self.recomputed: list[int] = []

    def run(self, messages: DataFrame) -> None:
        """Take in all available messages; resumes where the last run stopped."""
        self.intake.run(messages)

    def follow(self, messages: DataFrame, every: str = "30 seconds") -> StreamingQuery:
        """Keep taking in messages, with new rankings every interval that brings any."""
        return self.intake.follow(messages, every)

    def _distinct(self, records: DataFrame, batch_id: int) -> None:
        self.first_seen.take(records, batch_id, min(records.count() // SLICE_RECORDS + 1, SLICES))

    def _count(self, new: DataFrame, batch_id: int) -> None:
        stream = counters(self.first_seen.first.stream().select(*RANKED_REPO.names))
        drain(stream, f"{self.root}/_counters", self._rank, "update")

    def _rank(self, batch: DataFrame, batch_id: int) -> None:
        numbered = batch.select("kind", "name", *MEASURES, "commits", F.lit(batch_id).cast("bigint").alias("at"))
        changed = self.counters.write(numbered, batch_id, stateful=True)
        fresh = changed.filter("kind = 'language'").select("name", *MEASURES)
        earlier = self.languages.at(batch_id - 1).join(fresh.select("name"), "name", "left_anti")
        languages = self.languages.write(earlier.unionByName(fresh), batch_id)
        projects = changed.filter("kind = 'project'").select("name", F.col("commits").alias("count"))
        reserve, recomputed = self.reserve.update(projects, lambda: self.project_counts(batch_id), batch_id)
        if recomputed:
            self.recomputed.append(batch_id)

        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        tall = (
            languages.withColumnsRenamed(MEASURES)
            .unpivot("name", list(MEASURES.values()), "question", "count")
            .filter(F.col("count") > 0)
            .unionByName(reserve.filter("not floor").select("name", "count", F.lit(Q_PROJECTS).alias("question")))
        )
        ranked = rank_questions(tall, self.top_n).select(number, "question", "rk", "name", "count")
        self.rankings.write(ranked, batch_id)
        # Every repository counts for one language.
        snapshot = languages.agg(
            F.coalesce(F.sum("projects"), F.lit(0)).alias("processed_unique"),
            F.max(emit_stamp()).alias("recorded_at"),
        ).select(number, "processed_unique", F.lit(self.top_n).cast("bigint").alias("top_n"), "recorded_at")
        self.snapshot_log.write(snapshot, batch_id)
        self.newest.set(batch_id)

    def project_counts(self, batch_id: int) -> DataFrame:
        """Latest commit count of every project name, as of a batch."""
        known = self.counters.read(batch_id).filter("kind = 'project'")
        return known.select("name", F.col("commits").alias("count"))

    def language_counts(self) -> DataFrame:
        """Counters behind the language rankings."""
        return self.languages.at(self.newest.get())

    def history(self) -> DataFrame:
        """The four rankings after every micro-batch."""
        return self.rankings.read(self.newest.get())

    def snapshots(self) -> DataFrame:
        """One row per micro-batch: time, repositories so far, and ranking length."""
        return self.snapshot_log.read(self.newest.get())

    def current(self) -> DataFrame:
        """The four rankings after the newest micro-batch."""
        return self.rankings.at(self.newest.get()).drop("batch_id")

    def language_rankings(self) -> DataFrame:
        return self.current().filter(F.col("question") != Q_PROJECTS)

    def project_ranking(self) -> DataFrame:
        return self.current().filter(F.col("question") == Q_PROJECTS)

    def unfit(self) -> DataFrame:
        return self.intake.unfit()

    def exported_state(self) -> DataFrame:
        """Seen ids and all counters, ``section, name, count``, from the streams' own state."""
        reader = self.spark.read.format("statestore")
        seen = reader.load(f"{self.root}/_first").select(
            F.lit("seen").alias("section"),
            F.col("key.repo_id").cast("string").alias("name"),
            F.lit(1).cast("bigint").alias("count"),
        )
        # The state has the grouping and the aggregates in their order, under other names.
        held = reader.load(f"{self.root}/_counters").select(
            F.col("key").cast("struct<kind:string,name:string>").alias("key"), F.col("value").cast(STATE).alias("value")
        )
        counted = unpivot_questions(held.select("key.*", "value.*"))
        return seen.unionByName(counted.withColumnRenamed("question", "section"))
