import pytest
from pyspark.sql import functions as F

from repotide.operators import dedupe, rankings

SCHEMA = (
    "seq bigint, repo_id bigint, full_name string, language string,"
    " commit_count bigint, has_tests boolean, has_ci boolean"
)


def repos(spark, *records):
    """Records as (repo_id, full_name, language, commits, tests, ci), in arrival order."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(records)], SCHEMA)


def unique(df):
    return dedupe.first_seen(df, ["repo_id"], ["seq"])


def question(df, name):
    picked = df.filter(F.col("question") == name).orderBy("rk")
    return [(r["name"], r["count"]) for r in picked.collect()]


def test_a_repeated_id_counts_once_and_the_first_record_wins(spark):
    df = repos(
        spark,
        (1, "a/b", "Python", None, False, False),
        (1, "a/b", "Rust", 9, True, True),
    )
    ranked = rankings.all_rankings(unique(df))
    assert question(ranked, "q1_languages") == [("Python", 1)]
    assert question(ranked, "q2_projects") == []
    assert question(ranked, "q3_tests") == []


def test_null_and_empty_language_are_unknown_but_blank_is_not(spark):
    df = repos(
        spark,
        (1, "a", None, None, False, False),
        (2, "b", "", None, False, False),
        (3, "c", " ", None, False, False),
    )
    assert question(rankings.all_rankings(df), "q1_languages") == [("Unknown", 2), (" ", 1)]


def test_zero_commits_rank_and_unknown_commits_do_not(spark):
    df = repos(
        spark,
        (1, "a", "P", 42, False, False),
        (2, "b", "P", 0, False, False),
        (3, "c", "P", None, False, False),
    )
    assert question(rankings.all_rankings(df), "q2_projects") == [("a", 42), ("b", 0)]


def test_missing_name_ranks_under_the_id(spark):
    df = repos(spark, (7, None, "P", 5, False, False), (8, "", "P", 4, False, False))
    assert question(rankings.all_rankings(df), "q2_projects") == [("7", 5), ("8", 4)]


def test_a_shared_name_takes_the_later_count(spark):
    df = repos(spark, (1, "a", "P", 50, False, False), (2, "a", "P", 3, False, False))
    assert question(rankings.all_rankings(df), "q2_projects") == [("a", 3)]


def test_ci_counts_only_with_tests(spark):
    df = repos(
        spark,
        (1, "a", "P", None, True, False),
        (2, "b", "P", None, True, True),
        (3, "c", "P", None, False, True),
        (4, "d", "P", None, None, None),
    )
    ranked = rankings.all_rankings(df)
    assert question(ranked, "q3_tests") == [("P", 2)]
    assert question(ranked, "q4_tests_ci") == [("P", 1)]


@pytest.mark.parametrize("n, expected", [(2, [("Rust", 9), ("Python", 5)]), (0, [])])
def test_top_n(spark, n, expected):
    counts = spark.createDataFrame(
        [("Python", 5), ("Rust", 9), ("Go", 1)], "name string, count bigint"
    )
    top = rankings.top_ranked(counts, n).orderBy("rk").collect()
    assert [(r["name"], r["count"]) for r in top] == expected


def test_negative_n_is_refused(spark):
    counts = spark.createDataFrame([("a", 1)], "name string, count bigint")
    with pytest.raises(ValueError):
        rankings.top_ranked(counts, -1)


def test_ties_rank_by_name(spark):
    counts = spark.createDataFrame([("b", 1), ("a", 1)], "name string, count bigint")
    assert [r["name"] for r in rankings.top_ranked(counts, 2).orderBy("rk").collect()] == ["a", "b"]


def test_beyond_the_planner_threshold_the_ranking_is_still_exact(spark):
    counts = spark.range(5000).select(
        F.lit("q").alias("question"), F.col("id").cast("string").alias("name"), F.col("id").alias("count")
    )
    ranked = rankings.rank_questions(counts, 1500)
    assert ranked.count() == 1500
    assert ranked.agg(F.min("count"), F.max("rk")).first() == (3500, 1500)


def test_single_questions_agree_with_the_combined_pass(spark):
    df = spark.range(500).select(
        F.col("id").alias("seq"),
        (F.col("id") % 300).alias("repo_id"),
        F.concat(F.lit("n"), (F.col("id") % 40).cast("string")).alias("full_name"),
        F.concat(F.lit("l"), (F.col("id") % 7).cast("string")).alias("language"),
        (F.col("id") * 37 % 101).alias("commit_count"),
        (F.col("id") % 3 == 0).alias("has_tests"),
        (F.col("id") % 2 == 0).alias("has_ci"),
    )
    combined = rankings.all_rankings(unique(df), 5)
    for name, single in {
        "q1_languages": rankings.top_languages(unique(df), "projects", 5),
        "q2_projects": rankings.top_projects(unique(df), 5),
        "q3_tests": rankings.top_languages(unique(df), "with_tests", 5),
        "q4_tests_ci": rankings.top_languages(unique(df), "with_tests_ci", 5),
    }.items():
        assert question(combined, name) == [
            (r["name"], r["count"]) for r in single.orderBy("rk").collect()
        ]


def test_nested_results_list_entries_in_rank_order(spark):
    ranked = spark.createDataFrame(
        [("q", 2, "b", 1), ("q", 1, "a", 4)], "question string, rk bigint, name string, count bigint"
    )
    (row,) = rankings.nested_results(ranked).collect()
    assert [tuple(e) for e in row["entries"]] == [("a", 4), ("b", 1)]


def test_counter_state_holds_ids_and_all_counters(spark, rows):
    df = repos(spark, (5, "a", "P", 1, True, True))
    assert rows(rankings.counter_state(df)) == [
        ("q1_languages", "P", 1),
        ("q2_projects", "a", 1),
        ("q3_tests", "P", 1),
        ("q4_tests_ci", "P", 1),
        ("seen", "5", 1),
    ]
