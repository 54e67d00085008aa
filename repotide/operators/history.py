"""Rankings over time, their stability, and flow measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repotide.operators.blocks import lagged
from repotide.operators.dedupe import without
from repotide.operators.rankings import counters, rank_questions, unpivot_questions
from repotide.schemas import DEFAULT_TOP_N


def number_snapshots(arrivals: DataFrame) -> DataFrame:
    """Distinct snapshots as ``idx`` from 0, and the last of them: one row per day."""
    everything = Window.partitionBy(F.lit(0))
    days = arrivals.select("snapshot").distinct()
    return days.select(
        "snapshot",
        (F.row_number().over(everything.orderBy("snapshot")) - 1).alias("idx"),
        (F.count("*").over(everything).cast("int") - 1).alias("last_idx"),
    )


# Levels of the tree over snapshots: enough for any count of them.
LEVELS = 31


def held_counts(repos: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``(question, name, count, idx, until)``: each value of a counter and its span.

    ``repos`` are distinct and carry the ``snapshot`` they arrived in. They are
    first reduced to one change per counter and snapshot, in one aggregation. A
    counter holds its value from the snapshot that changed it until its next
    change.
    """
    per_snapshot = counters(repos, "snapshot").join(snapshots, "snapshot")
    own = Window.partitionBy("kind", "name").orderBy("idx")
    until = F.coalesce(F.lead("idx").over(own) - 1, F.col("last_idx"))
    running = {m: F.sum(m).over(own) for m in ("projects", "with_tests", "with_tests_ci")}
    held = per_snapshot.withColumns({**running, "until": until})
    return unpivot_questions(held, "idx", "until")


def _width(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def covering_nodes(first: str, last: str) -> Column:
    """Nodes ``(level, at)`` of the binary tree over snapshots that tile a span.

    At each level at most one node on either side belongs to the tiling, so a
    span takes two nodes per level at most, however long it is. Node ``at`` of a
    level holds the ``2 ** level`` snapshots from ``at * 2 ** level`` on.
    """
    def level_nodes(level: Column) -> Column:
        width = _width(level)
        low = F.ceil(F.col(first) / width)
        high = F.floor((F.col(last) + 1) / width)
        nodes = F.array(
            F.when((low < high) & (low % 2 == 1), low),
            F.when((low < high) & (high % 2 == 1), high - 1),
        )
        return F.transform(
            F.array_compact(nodes), lambda at: F.struct(level.alias("level"), at.alias("at"))
        )

    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    return F.flatten(F.transform(levels, level_nodes))


def history_ranks(repos: DataFrame, arrivals: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Top ``n`` of each question as of each snapshot that had arrivals.

    A value held over a span goes to the few tree nodes that tile the span. Only
    the ``n`` best values of a node can rank in a snapshot below it, so each node
    keeps these, and they alone are repeated for its snapshots: names times
    snapshots never arise. Exact for values that fall, too.
    """
    snapshots = number_snapshots(arrivals)
    placed = held_counts(repos, snapshots).withColumn("node", F.explode(covering_nodes("idx", "until")))
    placed = placed.select("question", "name", "count", "node.level", "node.at")
    best = rank_questions(placed, n, within=("level", "at")).drop("rk")
    width = _width(F.col("level"))
    start = F.col("at") * width
    spread = best.withColumn("idx", F.explode(F.sequence(start, start + width - 1)))
    named = spread.join(snapshots.select("snapshot", "idx"), "idx")
    return rank_questions(named.select("snapshot", "question", "name", "count"), n, within=("snapshot",))


def rank_changes(history: DataFrame) -> DataFrame:
    """Rank of each name beside its rank in the name's previous appearance."""
    earlier = Window.partitionBy("question", "name").orderBy("snapshot")
    return history.withColumn("previous_rk", F.lag("rk").over(earlier)).withColumn(
        "rank_change", F.col("previous_rk") - F.col("rk")
    )


def ranking_orders(history: DataFrame) -> DataFrame:
    """Per question and snapshot the ranked names (at most the ranking length) as one text,
    and whether they differ from the snapshot before."""
    names = F.transform(
        F.array_sort(F.collect_list(F.struct("rk", "name"))), lambda x: x["name"]
    )
    orders = history.groupBy("question", "snapshot").agg(F.array_join(names, ",").alias("names"))
    beside = lagged(orders, ["question"], "snapshot", "names", "before")
    return beside.withColumn("changed", ~F.col("names").eqNullSafe(F.col("before"))).drop("before")


def convergence(history: DataFrame) -> DataFrame:
    """Per question the snapshot from which on the ranked names stay in order."""
    return (
        ranking_orders(history)
        .groupBy("question")
        .agg(
            F.max(F.when(F.col("changed"), F.col("snapshot"))).alias("stable_from"),
            F.count_if("changed").alias("changes"),
            F.count("*").alias("snapshots"),
        )
    )


def throughput(records: DataFrame, ts: str, unit: str = "minute") -> DataFrame:
    """Records per minute."""
    slot = F.date_format(F.date_trunc(unit, F.col(ts).cast("timestamp")), "yyyy-MM-dd HH:mm:ss")
    return records.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))


def latency(records: DataFrame, emitted: str, received: str, by: list[str]) -> DataFrame:
    """Mean seconds from emission to receipt; records lacking a stamp do not count."""
    micros = F.unix_micros(F.col(received).cast("timestamp")) - F.unix_micros(
        F.col(emitted).cast("timestamp")
    )
    return records.groupBy(*by).agg(
        F.count(micros).alias("n"),
        (F.sum(micros).cast("double") / F.count(micros).cast("double") / 1e6).alias("avg_seconds"),
    )


def backlog(published: DataFrame, processed: DataFrame, key: str, ts: str) -> DataFrame:
    """Published and not yet processed, per minute of publication."""
    return throughput(without(published, processed, key), ts)


def backlog_depth(flow: DataFrame, published_at: str, processed_at: str) -> DataFrame:
    """Messages waiting at the end of each minute with traffic.

    ``flow`` has one row per message; a null ``processed_at`` is still waiting.
    Running sums are taken inside a day and shifted by the days before it.
    """
    events = flow.select(
        F.explode(
            F.array(
                F.struct(F.col(published_at).alias("ts"), F.lit(1).alias("d")),
                F.struct(F.col(processed_at).alias("ts"), F.lit(-1).alias("d")),
            )
        ).alias("x")
    ).select("x.ts", "x.d").filter(F.col("ts").isNotNull())
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    net = (
        events.groupBy(minute.alias("minute"))
        .agg(F.sum("d").alias("d"))
        .withColumn("day", F.to_date("minute"))
    )
    days = net.groupBy("day").agg(F.sum("d").alias("d"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select("day", F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("before"))
    inside = F.sum("d").over(Window.partitionBy("day").orderBy("minute"))
    return (
        net.withColumn("inside", inside)
        .join(before, "day")
        .select(
            F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("slot"),
            (F.col("before") + F.col("inside")).alias("waiting"),
        )
    )
