"""What the registered streams leave on disk: their topics, shuffles and tables."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from repotide.operators import dedupe, delivery, rankings
from repotide.plans import stream_queries, views
from repotide.session import conf_set
from repotide.sources import topics
from repotide.streaming import live
from repotide.streaming.tables import BatchTable

ORDERS = 400


@pytest.fixture
def tables(spark, tmp_path):
    """Orders with any number of lines, some of which come twice or have no number, and events."""
    orders = spark.range(ORDERS).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "substr('FOP', 1 + id % 3, 1) as o_orderstatus",
        "id * 1000.5 as o_totalprice", "timestamp'2024-01-01' as o_orderdate", "concat(id % 5, '-X') as o_orderpriority",
    )
    lines = spark.range(4 * ORDERS).selectExpr("id % (id % 400 + 1) as l_orderkey", "cast(nullif(id % 5, 0) as int) as l_linenumber")
    events = spark.range(90).selectExpr("id as event_id", "if(id % 2 = 0, 'error', 'click') as event_type")
    root = tmp_path / "sf"
    for name, frame in (("orders", orders), ("lineitem", lines.union(lines.limit(50))), ("events", events)):
        frame.write.parquet(str(root / f"{name}.parquet"))
    return str(root)


def messages(frame):
    return sorted(r[0] for r in frame.select("value").collect())


def in_topic(spark, path):
    return messages(spark.read.text(path))


def topic_bytes(path):
    return sum(f.stat().st_size for f in Path(path).glob("part-*"))


def test_an_envelope_topic_holds_all_messages_in_little_space(spark, tables, tmp_path):
    path = str(tmp_path / "topic")
    stream_queries.envelope_topic(spark, tables, path)
    sent = views.deliveries(spark, tables)
    packed = delivery.pack_envelopes(sent.distinct(), "seq", 100).select("value")
    lone = delivery.keyed_messages(sent).select("value")
    expected = messages(packed.unionByName(lone).unionByName(views.poison(spark, tables)))
    assert in_topic(spark, path) == expected
    assert topic_bytes(path) < sum(len(m) for m in expected) / 3


def test_a_topic_in_parts_is_the_same_topic(spark, tables, tmp_path):
    sent, poison = views.deliveries(spark, tables), views.poison(spark, tables)
    stream_queries.publish(spark, tables, sent, str(tmp_path / "whole"))
    parts = stream_queries.delivered_parts(spark, tables)
    stream_queries.publish_parts(parts, poison, str(tmp_path / "parts"))
    assert in_topic(spark, str(tmp_path / "parts")) == in_topic(spark, str(tmp_path / "whole"))
    # The lines of one order are in any part, so later batches bring repeats.
    a, b = ({r["seq"] for r in part.collect()} for part in parts)
    assert a & b and min(parts[0].count(), parts[1].count()) > ORDERS


def test_a_large_topic_has_more_files_and_no_more_batches(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "FILE_MESSAGES", 50)
    path = str(tmp_path / "topic")
    stream_queries.publish(spark, tables, views.deliveries(spark, tables), path)
    assert len(list(Path(path).glob("part-*"))) > 2 * stream_queries.topic_files(spark)
    taken = []
    query = (
        stream_queries.subscribe(spark, path).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c"))
        .foreachBatch(lambda batch, n: taken.append(batch.count())).start()
    )
    query.awaitTermination()
    assert len(taken) == stream_queries.BATCHES and sum(taken) == len(in_topic(spark, path))


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in Path(d).glob("*/shuffle_*")}


def test_a_batch_leaves_no_shuffle_files(spark, tmp_path, rows):
    table = BatchTable(spark, str(tmp_path / "t"), "k bigint, n bigint, fit boolean", split_by=("fit",))
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    table.write(counted.withColumn("fit", F.col("k") > 2), 0)
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    # Queries that come later keep theirs, and the rows are all there.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert rows(table.at(0)) == [(k, 100, k > 2) for k in range(10)]


def test_a_setting_holds_inside_alone(spark):
    with pytest.raises(ZeroDivisionError), conf_set(spark, "spark.sql.some.setting", "7"):
        assert spark.conf.get("spark.sql.some.setting") == "7"
        1 / 0
    assert spark.conf.get("spark.sql.some.setting", None) is None
    with conf_set(spark, "spark.sql.session.timeZone", "UTC"):
        pass
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_slices_make_one_part_that_counts_when_all_are_there(spark, tmp_path, rows):
    table = BatchTable(spark, str(tmp_path / "t"), "k bigint, n bigint")
    counted = spark.range(300).selectExpr("nullif(id % 100, 7) as k").groupBy("k").agg(F.count("*").alias("n"))
    # The first slice is stored, the second fails.
    second = F.pmod(F.xxhash64("k"), F.lit(3)) == 1
    failing = counted.withColumn("n", F.when(second, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        table.write(failing, 0, slices=3, key="k")
    assert not table.has(0) and list((tmp_path / "t" / "level=0" / "batch_id=0").glob("*.parquet"))
    found = rows(table.write(counted, 0, slices=3, key="k"))
    assert table.has(0) and found == rows(counted) and len(found) == 100


def test_repeats_are_told_in_slices(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(live, "SLICE_RECORDS", 100)
    sent = spark.range(450).selectExpr(
        "id as seq", "id % 90 as repo_id", "concat('n', id % 30) as full_name", "concat('l', id % 7) as language",
        "id % 31 as commit_count", "id % 2 = 0 as has_tests", "id % 3 = 0 as has_ci",
    )
    topics.publish(sent, str(tmp_path / "topic"))
    run, slices = live.LiveRankings(spark, str(tmp_path / "tables")), []
    write = run.first_seen.arrived.write
    run.first_seen.arrived.write = lambda *a, **b: slices.append(b["slices"]) or write(*a, **b)
    run.run(topics.open_topic(spark, str(tmp_path / "topic")))
    assert slices == [live.SLICES]
    expected = rankings.all_rankings(dedupe.first_seen(sent, ["repo_id"], ["seq"]), run.top_n)
    assert rows(run.current(), "question", "rk", "name", "count") == rows(expected)
