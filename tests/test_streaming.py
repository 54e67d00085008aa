import json
import random

import pytest
from pyspark.sql import functions as F

from repotide.operators import dedupe, rankings
from repotide.schemas import RANKED_REPO
from repotide.sources import topics
from repotide.streaming import flows, live
from repotide.streaming.enrichment import LiveEnrichment
from repotide.streaming.first_seen import FirstSeen
from repotide.streaming.intake import Intake
from repotide.streaming.runs import write_batch
from repotide.streaming.tables import BatchTable, Newest, cover


def record(seq, repo_id, name="n", language="P", commits=None, tests=False, ci=False):
    return dict(zip(RANKED_REPO.names, (seq, repo_id, name, language, commits, tests, ci)))


class Topic:
    """A topic that is written message by message, one file per call."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        root.mkdir()

    def send(self, *messages):
        text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
        (self.root / f"part-{self.files:05d}.txt").write_text(text + "\n")
        self.files += 1

    def messages(self):
        return topics.open_topic(self.spark, str(self.root))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def first_seen(spark, tmp_path, **options):
    first = FirstSeen(spark, str(tmp_path / "tables"), RANKED_REPO, **options)
    return first, Intake(spark, str(tmp_path / "tables"), topics.judge_messages, RANKED_REPO, first.take)


def test_each_id_appears_once_in_the_batch_that_brings_it(spark, tmp_path, topic, rows):
    def run():
        first, intake = first_seen(spark, tmp_path)
        intake.run(topic.messages())
        return first, intake.newest.get()

    # Inside a batch the lowest seq wins, whatever the order of the messages.
    topic.send(record(3, 1, language="late"), record(1, 1, language="first"), record(2, 2))
    first, _ = run()
    assert first.state == {"rows": 2, "written": 2}
    # A later batch never changes the choice, even with a lower seq.
    topic.send(record(0, 1, language="too late"), record(5, 3), record(6, 3))
    first, _ = run()
    assert first.state == {"rows": 3, "written": 1}
    # Repeats alone write no state.
    topic.send(record(7, 2), record(8, 1), record(9, 1))
    first, newest = run()
    assert first.state == {"rows": 3, "written": 0}
    found = [(n, *r) for n in range(newest + 1) for r in rows(first.first.at(n), "repo_id", "seq", "language")]
    assert found == [(0, 1, 1, "first"), (0, 2, 2, "P"), (1, 3, 5, "P")]


def test_the_state_holds_keys_and_no_records(spark, tmp_path, topic):
    topic.send(record(1, 1, name="n" * 10_000))
    first, intake = first_seen(spark, tmp_path)
    intake.run(topic.messages())
    held = spark.read.format("statestore").load(str(tmp_path / "tables" / "_first"))
    (row,) = held.collect()
    assert row["key"].asDict() == {"repo_id": 1} and len(str(row["value"])) < 100


def test_a_bounded_memory_knows_what_came_lately(spark, tmp_path, topic, rows):
    topic.send(record(1, 1), record(2, 2))
    first, intake = first_seen(spark, tmp_path, forget_after="2 days")
    intake.run(topic.messages())
    topic.send(record(3, 2), record(4, 3))
    intake.run(topic.messages())
    assert rows(first.first.read(intake.newest.get()), "repo_id", "seq") == [(1, 1), (2, 2), (3, 4)]


def test_a_run_stops_at_its_bound_and_goes_on_later(spark, tmp_path, topic, rows):
    def run(bound):
        run = live.LiveRankings(spark, str(tmp_path / "tables"), top_n=9, max_repos=bound)
        run.run(topic.messages())
        return run

    topic.send(*(record(i, i, language="P") for i in (5, 3, 1, 4)))
    found = run(3)
    assert rows(found.language_rankings(), "name", "count") == [("P", 3)]
    topic.send(record(2, 2, language="Q"), record(9, 5, language="Q"))
    found = run(3)
    assert rows(found.snapshots(), "batch_id", "processed_unique") == [(0, 3), (1, 3)]
    # What was held back comes first, in the order of its arrival.
    topic.send(record(10, 6, language="R"))
    found = run(4)
    assert rows(found.first_seen.first.at(2), "repo_id") == [(5,)]
    topic.send(record(11, 6, language="R"))
    found = run(None)
    assert rows(found.first_seen.first.at(3), "repo_id") == [(2,), (6,)]
    assert found.snapshots().orderBy("batch_id").collect()[-1]["processed_unique"] == 6


def test_rankings_resume_and_equal_the_batch_answer(spark, tmp_path, topic, rows):
    root = str(tmp_path / "tables")
    sent = [record(i, i % 40, f"n{i % 40}", f"l{i % 40 % 6}", i % 40 * 7 % 31, i % 4 == 0, i % 8 == 0)
            for i in range(120)]
    for n, start in enumerate((0, 30, 90)):
        topic.send(*sent[start:start + 60], "no record")
        # A new object each time, as after a restart.
        run = live.LiveRankings(spark, root, top_n=4)
        run.run(topic.messages())
        known = spark.createDataFrame(sent[:start + 60], RANKED_REPO)
        expected = rankings.all_rankings(dedupe.first_seen(known, ["repo_id"], ["seq"]), 4)
        assert rows(run.current(), "question", "rk", "name", "count") == rows(expected)
        assert rows(run.history().filter(f"batch_id = {n}").drop("batch_id")) == rows(expected)
    unique = dedupe.first_seen(spark.createDataFrame(sent, RANKED_REPO), ["repo_id"], ["seq"])
    assert rows(run.exported_state()) == rows(rankings.counter_state(unique))
    assert rows(run.unfit(), "payload") == [("no record",)] * 3
    assert run.language_counts().agg(F.sum("projects")).first()[0] == 40
    log = run.snapshots().orderBy("batch_id").collect()
    assert [r["top_n"] for r in log] == [4, 4, 4] and log[-1]["processed_unique"] == 40
    assert [r["recorded_at"] for r in log] == sorted(r["recorded_at"] for r in log)


def test_a_project_that_sinks_makes_room_for_one_outside_the_ranking(spark, tmp_path, topic, rows):
    run = live.LiveRankings(spark, str(tmp_path / "tables"), top_n=2, reserve=1)
    topic.send(record(1, 1, "a", commits=9), record(2, 2, "b", commits=8), record(3, 3, "c", commits=7))
    run.run(topic.messages())
    assert rows(run.project_ranking(), "rk", "name", "count") == [(1, "a", 9), (2, "b", 8)]
    topic.send(record(4, 4, "a", commits=1))
    run.run(topic.messages())
    assert rows(run.project_ranking(), "rk", "name", "count") == [(1, "b", 8), (2, "c", 7)]
    topic.send(record(5, 5, "d", commits=20), record(6, 6, "b", commits=30))
    run.run(topic.messages())
    assert rows(run.project_ranking(), "rk", "name", "count") == [(1, "b", 30), (2, "d", 20)]
    assert run.recomputed == []


def test_the_reserve_ranks_like_all_names(spark, tmp_path):
    """Counts rise and fall at random; names outside the reserve are asked for only when it runs out."""
    rng = random.Random(5)
    reserve = live.Reserve(BatchTable(spark, str(tmp_path / "reserve"), live.RESERVE), top_n=3, extra=3)
    counts, asked = {}, []
    for n in range(14):
        names = rng.sample([f"n{i}" for i in range(40)], 40 if n == 0 else 5)
        # Late batches let what is high fall, until the reserve runs out.
        high = sorted(counts, key=lambda k: -counts[k])[:4]
        changed = {k: rng.randrange(20) for k in names} | ({k: 0 for k in high} if n > 6 else {})
        counts |= changed
        frame = spark.createDataFrame(list(changed.items()), "name string, count bigint")
        everything = spark.createDataFrame(list(counts.items()), "name string, count bigint")
        kept, again = reserve.update(frame, lambda e=everything: e, n)
        asked.append(again)
        best = sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:3]
        found = sorted(((r["name"], r["count"]) for r in kept.filter("not floor").collect()), key=lambda p: (-p[1], p[0]))
        assert found[:3] == best and len(found) <= 12
    assert not any(asked[:7]) and any(asked[7:]) and not all(asked[7:])


def test_batches_are_covered_by_few_parts(spark, tmp_path, rows):
    for n in range(700):
        parts = cover(n)
        sizes = [8**level for level, _ in parts]
        assert sum(sizes) == n + 1 and len(parts) <= 7 * 4
        ends = [end for _, end in parts]
        assert ends == [sum(sizes[:i + 1]) - 1 for i in range(len(sizes))]
    table = BatchTable(spark, str(tmp_path / "t"), "x bigint", fan=2)
    for n in range(7):
        table.write(spark.createDataFrame([(n,)], "x bigint"), n)
    assert rows(table.read(6)) == [(n,) for n in range(7)] and rows(table.read(3)) == [(n,) for n in range(4)]
    assert len({f.split("batch_id=")[0] for f in table.read(6).inputFiles()}) == 3
    # A replay changes nothing.
    table.write(spark.createDataFrame([(99,)], "x bigint"), 3)
    assert rows(table.read(6)) == [(n,) for n in range(7)]


def test_the_newest_number_survives_a_broken_write(spark, tmp_path):
    newest = Newest(spark, str(tmp_path / "newest"))
    assert newest.get() == -1
    newest.set(0)
    newest.set(1)
    assert newest.get() == 1
    for file in (tmp_path / "newest" / "slot=1").glob("*"):
        file.unlink()
    assert newest.get() == 0


def test_a_replayed_batch_leaves_its_first_result(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    one = spark.createDataFrame([(1,)], "x int")
    two = spark.createDataFrame([(2,)], "x int")
    assert rows(write_batch(one, out, 0)) == [(1,)]
    assert rows(write_batch(two, out, 0)) == [(1,)]


def test_nothing_is_sent_twice_over_runs(spark, tmp_path, topic, rows):
    done = spark.createDataFrame([(1,)], "repo_id bigint")
    root = str(tmp_path / "out")
    topic.send(record(1, 1), record(2, 2), record(3, 2), "nothing")
    flows.publish_topic(topic.messages(), RANKED_REPO, done, root)
    topic.send(record(4, 2), record(5, 3))
    intake = flows.publish_topic(topic.messages(), RANKED_REPO, done, root)
    assert rows(flows.read_log(spark, f"{root}/log")) == [(2,), (3,)]
    sent = [json.loads(r["value"]) for r in spark.read.parquet(f"{root}/sent").collect()]
    assert sorted(m["seq"] for m in sent) == [2, 5]
    assert rows(intake.unfit()) == [("nothing", "no record")]


def test_bad_messages_are_set_aside_and_the_others_go_on(spark, tmp_path, topic, rows):
    topic.send("garbage", {"repo_id": 1}, "", "[1]")
    out = str(tmp_path / "out")
    flows.quarantine_topic(topics.open_topic(spark, str(topic.root)), out, str(tmp_path / "c"))
    found = spark.read.parquet(out)
    assert rows(found.filter("reason = 'invalid json'"), "line", "status") == [
        ("[1]", "unfit"), ("garbage", "unfit")
    ]
    assert found.count() == 3


REPOS = "repo_id bigint, full_name string, default_branch string"
EVIDENCE = "full_name string, branch string, test_evidence string, ci_evidence string"


def test_stream_enrichment_equals_the_batch_join(spark, tmp_path, rows):
    from repotide.operators.enrich import enrich

    repos = spark.createDataFrame([(1, "a", "main"), (2, "b", None)], REPOS)
    stats = spark.createDataFrame([("a", 5)], "full_name string, commit_count bigint")
    evidence = spark.createDataFrame([("b", None, "tests", None)], EVIDENCE)
    path = str(tmp_path / "topic")
    topics.publish(repos, path)
    run = LiveEnrichment(spark, str(tmp_path / "out"), repos.schema, stats, evidence)
    run.run(topics.open_topic(spark, path))
    assert rows(run.enriched()) == rows(enrich(repos, stats, evidence))


def test_a_failed_lookup_says_nothing_until_it_is_answered(spark, tmp_path, topic, rows):
    repos = spark.createDataFrame([], REPOS).schema
    stats = spark.createDataFrame([("a", 5), ("b", 6)], "full_name string, commit_count bigint")
    evidence = spark.createDataFrame([("a", "main", "pytest.ini", None)], EVIDENCE)
    failed = spark.createDataFrame(
        [("a", "main", "tests"), ("b", "main", "tests"), ("b", "main", "Jenkinsfile"), ("a", "old", "spec"), ("z", "main", "test")],
        "full_name string, branch string, path string",
    )
    answers = Topic(spark, tmp_path / "answers")
    run = LiveEnrichment(spark, str(tmp_path / "out"), repos, stats, evidence, failed)

    def step():
        run.run(topics.open_topic(spark, str(topic.root)), topics.open_topic(spark, str(answers.root)))
        return rows(run.enriched(), "repo_id", "commit_count", "test_evidence", "ci_evidence"), rows(run.pending(), "repo_id")

    def answer(name, path, status):
        return {"full_name": name, "branch": "main", "path": path, "status": status}

    topic.send(*({"repo_id": i, "full_name": n, "default_branch": "main"} for i, n in enumerate("abc")), "junk")
    topic.send({"repo_id": 9, "full_name": None, "default_branch": None})
    answers.send(answer("a", "tests", 503), '{"status": 200}')
    assert step() == ([(2, None, None, None), (9, None, None, None)], [(0,), (1,)])
    # A second failure changes nothing, one answer of two neither.
    answers.send(answer("a", "tests", 429), answer("b", "tests", 404))
    assert step() == ([(2, None, None, None), (9, None, None, None)], [(0,), (1,)])
    answers.send(answer("a", "tests", 200))
    # The answer found a better path than the one known.
    assert step()[0] == [(0, 5, "tests", None), (2, None, None, None), (9, None, None, None)]
    answers.send(answer("b", "Jenkinsfile", 200), answer("a", "tests", 503))
    assert step() == ([(0, 5, "tests", None), (1, 6, None, "Jenkinsfile"), (2, None, None, None), (9, None, None, None)], [])
    # Answered before its repository comes.
    answers.send(answer("z", "test", 404))
    step()
    topic.send({"repo_id": 30, "full_name": "z", "default_branch": "main"})
    found, waiting = step()
    assert (30, None, None, None) in found and len(found) == 5 and not waiting
    assert rows(run.unfit()) == [("junk", "no record"), ('{"status":200}', "no lookup")]


def test_following_a_topic_ranks_what_arrives_later(spark, tmp_path, topic, rows):
    run = live.LiveRankings(spark, str(tmp_path / "tables"), top_n=3)
    topic.send(record(1, 1, language="P"))
    query = run.follow(topic.messages(), every="1 second")
    try:
        query.processAllAvailable()
        assert rows(run.language_rankings(), "name", "count") == [("P", 1)]
        topic.send(record(2, 2, language="P"), record(3, 1, language="Q"))
        query.processAllAvailable()
        assert rows(run.language_rankings(), "name", "count") == [("P", 2)]
    finally:
        query.stop()


def test_a_step_that_broke_off_is_taken_up_again(spark, tmp_path, topic, rows):
    """The counters fail once; the next run replays the batch, and nothing counts twice."""
    topic.send(record(1, 1, commits=4), record(2, 2))
    run = live.LiveRankings(spark, str(tmp_path / "tables"))
    run.first_seen.deliver = lambda new, batch_id: 1 / 0
    with pytest.raises(Exception):
        run.run(topic.messages())
    topic.send(record(3, 3), record(4, 1))
    run = live.LiveRankings(spark, str(tmp_path / "tables"))
    run.run(topic.messages())
    assert run.snapshots().agg(F.max("processed_unique")).first()[0] == 3
    assert rows(run.language_rankings(), "name", "count") == [("P", 3)]


def test_messages_read_back_as_they_were_published(spark, tmp_path, rows):
    path = str(tmp_path / "topic")
    sent = spark.createDataFrame([record(1, 2, None, "", 0, True, None)], RANKED_REPO)
    topics.publish(sent, path)
    assert rows(topics.parse_messages(spark.read.text(path), RANKED_REPO)) == rows(sent)


def test_messages_that_hold_no_record_are_set_apart(spark, rows):
    good = '{"seq":1,"repo_id":"7","full_name":"a/b"}'
    bad = ["garbage", "[1,2]", '{"seq":9,"repo_id":"x"}', '{"repo_id":7.9}', good + "," + good, good + " tail"]
    messages = spark.createDataFrame([(m,) for m in [good, '{"repo_id":8.0}', " ", *bad]], "value string")
    assert rows(topics.parse_messages(messages, RANKED_REPO), "repo_id") == [(7,), (8,)]
    assert rows(topics.unfit_messages(messages, RANKED_REPO)) == sorted([(m,) for m in bad], key=repr)
