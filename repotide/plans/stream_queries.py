"""Registered streaming queries. Each runs a stream over a topic that Spark
derives from the given tables, to its end, and returns the table it built.

Every topic holds unfit messages too; they end up in the intake's own table,
which ``stream_intake`` and ``stream_unfit`` return."""

from __future__ import annotations

from pyspark.sql import functions as F

from repotide.functions import columns as C
from repotide.operators import delivery, enrich
from repotide.plans import views
from repotide.schemas import RANKED_REPO, RAW_REPO
from repotide.session import fresh_dir, shuffles_freed
from repotide.sources import topics
from repotide.streaming import flows, live
from repotide.streaming.enrichment import LiveEnrichment
from repotide.streaming.first_seen import FirstSeen
from repotide.streaming.intake import Intake

BATCHES = 2
# A compressed file is read by one task, so a large topic is cut into more files.
FILE_MESSAGES = 500_000


def topic_files(spark):
    """As many files as the session shuffles into, which the cluster sizes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def subscribe(spark, path):
    """The topic in micro-batches of about half of its files."""
    files = len(spark.read.text(path).inputFiles())
    return topics.open_topic(spark, path, max(-(-files // BATCHES), 1))


def append(messages, path):
    """More messages of a topic; as plain text they are several times the tables' size."""
    spark = messages.sparkSession
    writer = messages.repartition(topic_files(spark)).write.mode("append")
    with shuffles_freed(spark):
        writer.option("maxRecordsPerFile", FILE_MESSAGES).text(path, compression="gzip")


def publish(spark, sf_dir, records, path):
    """The records as messages, between messages that are none."""
    publish_parts([records], views.poison(spark, sf_dir), path)


def publish_parts(parts, poison, path):
    """Records in parts, one append each: what one has shuffled is gone when the next begins."""
    for n, records in enumerate(parts):
        value = C.sorted_json(records.columns).alias("value")
        append(records.select(value).unionByName(views.portion(poison, ["value"], n, len(parts))), path)


def delivered_parts(spark, sf_dir):
    """All deliveries, in parts that each have some of an order's."""
    lines = views.table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return [views.deliveries(spark, sf_dir, views.portion(lines, key, n, BATCHES)) for n in range(BATCHES)]


def raw_intake(spark, sf_dir, label):
    root = fresh_dir(spark, label)
    records = views.repo_records(spark, sf_dir)
    parts = [views.portion(records, ["repo_id"], n, BATCHES) for n in range(BATCHES)]
    publish_parts(parts, views.poison(spark, sf_dir), f"{root}/topic")
    intake = Intake(spark, root, topics.judge_messages, RAW_REPO)
    intake.run(subscribe(spark, f"{root}/topic"))
    return intake


def stream_raw(spark, sf_dir):
    records = raw_intake(spark, sf_dir, "stream-raw").records()
    return records.select("repo_id", "full_name", "stars", "language")


def stream_first_seen(spark, sf_dir):
    root = fresh_dir(spark, "stream-first-seen")
    publish(spark, sf_dir, views.deliveries(spark, sf_dir), f"{root}/topic")
    first = FirstSeen(spark, root, RANKED_REPO)
    intake = Intake(spark, root, topics.judge_messages, RANKED_REPO, first.take)
    intake.run(subscribe(spark, f"{root}/topic"))
    return first.first.read(intake.newest.get())


def stream_enrich(spark, sf_dir):
    root = fresh_dir(spark, "stream-enrich")
    repos = views.order_repos(spark, sf_dir)
    publish(spark, sf_dir, repos, f"{root}/topic")
    run = LiveEnrichment(
        spark, root, repos.schema, views.order_commits(spark, sf_dir),
        enrich.path_evidence(views.repo_contents(spark, sf_dir)),
    )
    run.run(subscribe(spark, f"{root}/topic"))
    return run.enriched()


def retried(spark, sf_dir, label):
    """All orders, of which some have failed lookups; then the second tries."""
    root = fresh_dir(spark, label)
    repos, lookups = views.order_repos(spark, sf_dir), views.path_lookups(spark, sf_dir)
    failed = lookups.filter("first_try >= 400")
    publish(spark, sf_dir, repos, f"{root}/repos")
    run = LiveEnrichment(
        spark, f"{root}/tables", repos.schema, views.order_commits(spark, sf_dir),
        enrich.path_evidence(lookups.filter("first_try < 400")), failed,
    )
    answers = failed.select("full_name", "branch", "path", F.col("second_try").alias("status"), "content")
    outcomes = f"{root}/outcomes"
    publish(spark, sf_dir, answers.limit(0), outcomes)
    for found in (answers.limit(0), answers):
        topics.publish(found, outcomes, topic_files(spark))
        run.run(topics.open_topic(spark, f"{root}/repos"), topics.open_topic(spark, outcomes))
    return run


def stream_retry(spark, sf_dir):
    """Each repository once, in the batch that settles the last of its lookups."""
    run = retried(spark, sf_dir, "stream-retry")
    released = run.enriched().withColumn("state", F.lit("enriched"))
    return released.unionByName(run.pending().withColumn("state", F.lit("waiting")), allowMissingColumns=True)


def envelope_topic(spark, sf_dir, path):
    """Every delivered order once in an envelope, and all its deliveries again as
    lone records, between messages that are neither."""
    envelopes = delivery.pack_envelopes(views.deliveries(spark, sf_dir).distinct(), "seq", 100)
    poison = views.poison(spark, sf_dir)
    for n, sent in enumerate(delivered_parts(spark, sf_dir)):
        packed = views.portion(envelopes, ["envelope"], n, BATCHES).select("value")
        lone = delivery.keyed_messages(sent).select("value")
        append(packed.unionByName(lone).unionByName(views.portion(poison, ["value"], n, BATCHES)), path)


def ranked_run(spark, sf_dir, label):
    """Envelopes and lone records, taken in by the live rankings."""
    root = fresh_dir(spark, label)
    envelope_topic(spark, sf_dir, f"{root}/topic")
    run = live.LiveRankings(spark, f"{root}/tables")
    run.run(subscribe(spark, f"{root}/topic"))
    return run


def stream_rankings(spark, sf_dir):
    return ranked_run(spark, sf_dir, "stream-rankings").language_rankings()


def stream_projects(spark, sf_dir):
    return ranked_run(spark, sf_dir, "stream-projects").project_ranking()


def resumed_run(spark, sf_dir, label):
    """The topic grows after the first run; the second resumes and counts every
    repository once, though most of its messages are repeats."""
    root = fresh_dir(spark, label)
    topic = f"{root}/topic"
    sent, poison = delivered_parts(spark, sf_dir), views.poison(spark, sf_dir)
    run = live.LiveRankings(spark, f"{root}/tables")
    for parts in ([part.filter(F.col("language") != "1-URGENT") for part in sent], sent):
        publish_parts(parts, poison, topic)
        # All there is makes one batch.
        run.run(topics.open_topic(spark, topic))
    return run


def stream_history(spark, sf_dir):
    """All four rankings after each of two batches."""
    return resumed_run(spark, sf_dir, "stream-history").history()


def stream_resume(spark, sf_dir):
    return resumed_run(spark, sf_dir, "stream-resume").language_rankings()


def stream_intake(spark, sf_dir):
    """How many records and unfit messages each topic held."""
    root = fresh_dir(spark, "stream-intake")
    envelope_topic(spark, sf_dir, f"{root}/topic")
    enveloped = Intake(spark, f"{root}/tables", delivery.unpack_envelopes, RANKED_REPO)
    enveloped.run(subscribe(spark, f"{root}/topic"))
    counts = None
    for name, intake in (("raw", raw_intake(spark, sf_dir, "stream-intake-raw")), ("enriched", enveloped)):
        judged = intake.judged.read(intake.newest.get()).groupBy(F.coalesce("error", F.lit("fit")).alias("outcome"))
        own = judged.agg(F.count("*").alias("n")).select(F.lit(name).alias("topic"), "outcome", "n")
        counts = own if counts is None else counts.unionByName(own)
    return counts


def stream_unfit(spark, sf_dir):
    """The messages of a topic that hold no record, as they came."""
    return raw_intake(spark, sf_dir, "stream-unfit").unfit()


def stream_quarantine(spark, sf_dir):
    root = fresh_dir(spark, "stream-quarantine")
    lines = views.handoff_lines(spark, sf_dir).select("line")
    lines.repartition(topic_files(spark)).write.text(f"{root}/topic")
    messages = subscribe(spark, f"{root}/topic")
    flows.quarantine_topic(messages, f"{root}/out", f"{root}/checkpoint")
    judged = spark.read.schema("line string, reason string, status string").parquet(f"{root}/out")
    return judged.groupBy("status", "line", "reason").agg(F.count("*").alias("n"))


def stream_publish_log(spark, sf_dir):
    """Ids sent by this run: delivered, and not of orders an earlier run has sent."""
    root = fresh_dir(spark, "stream-publish")
    publish(spark, sf_dir, views.deliveries(spark, sf_dir), f"{root}/topic")
    orders = views.table(spark, sf_dir, "orders")
    done = orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("repo_id"))
    flows.publish_topic(subscribe(spark, f"{root}/topic"), RANKED_REPO, done, root)
    return flows.read_log(spark, f"{root}/log")


def stream_bounded(spark, sf_dir):
    """A run that stops at half of the delivered orders, in their order."""
    root = fresh_dir(spark, "stream-bounded")
    sent = views.deliveries(spark, sf_dir)
    publish(spark, sf_dir, sent, f"{root}/topic")
    bound = sent.select("repo_id").distinct().count() // 2
    run = live.LiveRankings(spark, f"{root}/tables", max_repos=bound)
    run.run(topics.open_topic(spark, f"{root}/topic"))
    return run.current()


def stream_state(spark, sf_dir):
    """Counters behind the rankings after the last micro-batch."""
    return ranked_run(spark, sf_dir, "stream-state").language_counts()


def stream_state_export(spark, sf_dir):
    """Seen ids and all counters, from the state of the streams."""
    return ranked_run(spark, sf_dir, "stream-state-export").exported_state()


QUERIES = {
    f.__name__: f
    for f in (
        stream_raw, stream_first_seen, stream_enrich, stream_retry, stream_rankings, stream_projects,
        stream_history, stream_resume, stream_intake, stream_unfit, stream_quarantine,
        stream_publish_log, stream_bounded, stream_state, stream_state_export,
    )
}
