import datetime as dt

from pyspark.sql import functions as F

from repotide.operators import history

REPO = (
    "snapshot string, seq bigint, repo_id bigint, full_name string, language string,"
    " commit_count bigint, has_tests boolean, has_ci boolean"
)


def test_counters_hold_between_changes(spark, rows):
    repos = spark.createDataFrame(
        [
            ("d1", 1, 1, "a", "P", 5, True, True),
            ("d3", 2, 2, "a", "P", 1, False, False),
            ("d3", 3, 3, "b", "Q", 3, True, False),
        ],
        REPO,
    )
    arrivals = spark.createDataFrame([("d1",), ("d2",), ("d3",), ("d3",)], "snapshot string")
    found = history.history_ranks(repos, arrivals, 5)
    assert rows(found.filter("snapshot = 'd2'"), "question", "rk", "name", "count") == [
        ("q1_languages", 1, "P", 1), ("q2_projects", 1, "a", 5),
        ("q3_tests", 1, "P", 1), ("q4_tests_ci", 1, "P", 1),
    ]
    assert rows(found.filter("snapshot = 'd3'"), "question", "rk", "name", "count") == [
        ("q1_languages", 1, "P", 2), ("q1_languages", 2, "Q", 1),
        ("q2_projects", 1, "b", 3), ("q2_projects", 2, "a", 1),
        ("q3_tests", 1, "P", 1), ("q3_tests", 2, "Q", 1), ("q4_tests_ci", 1, "P", 1),
    ]


def ranks(spark, *snapshots):
    rows = [
        (f"d{i}", "q", rk + 1, name, 1) for i, names in enumerate(snapshots) for rk, name in enumerate(names)
    ]
    return spark.createDataFrame(rows, "snapshot string, question string, rk bigint, name string, count bigint")


def test_rank_change_is_positive_when_a_name_climbs(spark, rows):
    found = history.rank_changes(ranks(spark, "ab", "ba"))
    assert rows(found, "snapshot", "name", "rank_change") == [
        ("d0", "a", None), ("d0", "b", None), ("d1", "a", -1), ("d1", "b", 1)
    ]


def test_convergence_is_the_last_change(spark, rows):
    assert rows(history.convergence(ranks(spark, "ab", "ba", "ab", "ab", "ab"))) == [("q", "d2", 3, 5)]


def at(minute, second=0):
    return dt.datetime(2028, 2, 29, 12, minute, second)


def test_latency_skips_missing_stamps(spark, rows):
    df = spark.createDataFrame(
        [("a", at(0), at(0, 30)), ("a", at(1), at(2, 30)), ("a", at(1), None), ("a", None, at(1))],
        "g string, emitted timestamp, received timestamp",
    )
    assert rows(history.latency(df, "emitted", "received", ["g"])) == [("a", 2, 60.0)]


def test_throughput_per_minute(spark, rows):
    df = spark.createDataFrame([(at(0),), (at(0, 59),), (at(2),)], "ts timestamp")
    assert rows(history.throughput(df, "ts")) == [
        ("2028-02-29 12:00:00", 2), ("2028-02-29 12:02:00", 1)
    ]


def test_backlog_counts_what_is_not_processed(spark, rows):
    sent = spark.createDataFrame([(1, at(0)), (2, at(0)), (3, at(1))], "repo_id bigint, ts timestamp")
    done = sent.filter("repo_id = 1")
    assert rows(history.backlog(sent, done, "repo_id", "ts"), "n") == [(1,), (1,)]


def test_backlog_depth_carries_over_midnight(spark, rows):
    next_day = at(5) + dt.timedelta(days=1)
    df = spark.createDataFrame(
        [(at(0), at(1)), (at(0), next_day), (at(1), None)], "sent timestamp, taken timestamp"
    )
    assert rows(history.backlog_depth(df, "sent", "taken")) == [
        ("2028-02-29 12:00:00", 2), ("2028-02-29 12:01:00", 2), ("2028-03-01 12:05:00", 1)
    ]
    assert history.backlog_depth(df, "sent", "taken").select(F.max("waiting")).first()[0] == 2
