"""The four rankings over distinct repositories.

Input rows are distinct by ``repo_id`` (see :mod:`repotide.operators.dedupe`)
and carry ``seq``, their place in arrival order. Ties rank by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repotide.functions.columns import is_true, language_label, project_label
from repotide.operators.dedupe import GROUP_LIMIT_THRESHOLD, limit_per_group
from repotide.schemas import (
    DEFAULT_TOP_N,
    Q_LANGUAGES,
    Q_PROJECTS,
    Q_TESTS,
    Q_TESTS_CI,
)


def language_counts(repos: DataFrame) -> DataFrame:
    """Projects, projects with tests, and with tests and CI, per language."""
    tests = is_true("has_tests")
    return repos.groupBy(language_label().alias("name")).agg(
        F.count("*").alias("projects"),
        F.count_if(tests).alias("with_tests"),
        F.count_if(tests & is_true("has_ci")).alias("with_tests_ci"),
    )


def project_commits(repos: DataFrame) -> DataFrame:
    """Latest known commit count per project name; ``seq`` of that record."""
    return (
        repos.filter(F.col("commit_count").isNotNull())
        .groupBy(project_label().alias("name"))
        .agg(
            F.max_by("commit_count", "seq").alias("count"),
            F.max("seq").alias("seq"),
        )
    )


def top_ranked(counts: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """``(rk, name, count)`` of the ``n`` largest counts.

    The limit comes first; only the surviving ``n`` rows are numbered.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    order = [F.desc("count"), F.asc("name")]
    top = counts.select("name", "count").orderBy(*order).limit(n)
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return top.select(number.cast("bigint").alias("rk"), "name", "count")


def top_languages(repos: DataFrame, measure: str = "projects", n: int = DEFAULT_TOP_N) -> DataFrame:
    counts = language_counts(repos).select("name", F.col(measure).alias("count"))
    return top_ranked(counts.filter(F.col("count") > 0), n)


def top_projects(repos: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    return top_ranked(project_commits(repos), n)


def counters(repos: DataFrame, *within: str) -> DataFrame:
    """All counters of the four questions in one aggregation.

    Each repository feeds its language and, given a commit count, its project
    name; ``kind`` tells the two apart. Counters are kept per ``within`` group.
    """
    tests = is_true("has_tests")
    fed = repos.select(
        *within,
        "seq",
        "commit_count",
        tests.alias("tests"),
        (tests & is_true("has_ci")).alias("tests_ci"),
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit("language").alias("kind"), language_label().alias("name")),
                    F.when(
                        F.col("commit_count").isNotNull(),
                        F.struct(F.lit("project").alias("kind"), project_label().alias("name")),
                    ),
                )
            )
        ).alias("fed"),
    )
    return fed.groupBy(*within, "fed.kind", "fed.name").agg(
        F.count("*").alias("projects"),
        F.count_if("tests").alias("with_tests"),
        F.count_if("tests_ci").alias("with_tests_ci"),
        F.max_by("commit_count", "seq").alias("commits"),
    )


def unpivot_questions(counted: DataFrame, *within: str) -> DataFrame:
    """``(question, name, count)`` rows of :func:`counters`; zero counts have none."""
    is_language = F.col("kind") == "language"

    def languages(measure: str):
        return F.when(is_language & (F.col(measure) > 0), F.col(measure))

    measures = F.array(
        _measure(Q_LANGUAGES, languages("projects")),
        _measure(Q_TESTS, languages("with_tests")),
        _measure(Q_TESTS_CI, languages("with_tests_ci")),
        _measure(Q_PROJECTS, F.when(~is_language, F.col("commits"))),
    )
    return (
        counted.select(*within, "name", F.explode(measures).alias("m"))
        .select(*within, "m.question", "name", "m.count")
        .filter(F.col("count").isNotNull())
    )


def question_counts(repos: DataFrame) -> DataFrame:
    return unpivot_questions(counters(repos))


def _measure(question: str, count):
    return F.struct(F.lit(question).alias("question"), count.alias("count"))


def rank_questions(
    counts: DataFrame, n: int = DEFAULT_TOP_N, within: tuple[str, ...] = ()
) -> DataFrame:
    """Top ``n`` per question (and per ``within`` group) of ``question_counts`` rows."""
    if n < 0:
        raise ValueError("n must not be negative")
    groups = [*within, "question"]
    order = [F.desc("count"), F.asc("name")]
    if n > GROUP_LIMIT_THRESHOLD:
        counts = limit_per_group(counts, groups, order, n)
    window = Window.partitionBy(*groups).orderBy(*order)
    return (
        counts.withColumn("rk", F.row_number().over(window))
        .filter(F.col("rk") <= n)
        .select(*groups, F.col("rk").cast("bigint").alias("rk"), "name", "count")
    )


def all_rankings(repos: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Tall ``(question, rk, name, count)`` of the four questions."""
    return rank_questions(question_counts(repos), n)


def nested_results(rankings: DataFrame) -> DataFrame:
    """One row per question with its list ``[{name, count}]`` in rank order."""
    entries = F.array_sort(F.collect_list(F.struct("rk", "name", "count")))
    return rankings.groupBy("question").agg(
        F.transform(entries, lambda e: F.struct(e["name"], e["count"])).alias("entries")
    )


def seen_ids(repos: DataFrame) -> DataFrame:
    """All ids in order, sorted over all tasks."""
    return repos.select("repo_id").orderBy("repo_id")


def counter_state(repos: DataFrame) -> DataFrame:
    """The full counters behind the rankings plus every seen id, tall."""
    seen = repos.select(
        F.lit("seen").alias("section"),
        F.col("repo_id").cast("string").alias("name"),
        F.lit(1).cast("bigint").alias("count"),
    )
    counters = question_counts(repos).select(F.col("question").alias("section"), "name", "count")
    return seen.unionByName(counters)
