"""Commit counts and test/CI evidence, joined to repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotide.functions.columns import (
    as_col,
    commit_count,
    decode_content,
    mentions_test_tool,
)
from repotide.schemas import CI_PATHS, TEST_CONFIG_FILES, TEST_DIRECTORIES, TEST_PATHS


def commit_stats(responses: DataFrame) -> DataFrame:
    """``(full_name, commit_count)`` from one stored response per repository."""
    return responses.select(
        "full_name", commit_count("status", "link", "body").alias("commit_count")
    )


def _priority(path: Column, paths: list[str]) -> Column:
    """1-based place of ``path`` in ``paths``; 0 when it is not one of them."""
    return F.array_position(F.array(*[F.lit(p) for p in paths]), path).cast("int")


def path_evidence(contents: DataFrame) -> DataFrame:
    """First existing test path and CI path per ``(full_name, branch)``.

    ``contents`` has one row per existing path with its base64 ``content`` (null
    for directories). A test configuration file counts only when its whole text
    names a test tool. Only the place in the priority list is aggregated, two
    ints per repository, and turned back into the path afterwards.
    """
    path = F.col("path")
    # Only these files are decoded, each once for all words.
    config_text = F.when(path.isin(TEST_CONFIG_FILES), decode_content("content"))
    names_tool = mentions_test_tool("_text")
    test_place = F.when(
        path.isin(TEST_DIRECTORIES) | (path.isin(TEST_CONFIG_FILES) & names_tool),
        _priority(path, TEST_PATHS),
    )
    ci_place = F.when(path.isin(CI_PATHS), _priority(path, CI_PATHS))
    return (
        contents.filter(path.isin(TEST_PATHS + CI_PATHS))
        .withColumn("_text", config_text)
        .groupBy("full_name", "branch")
        .agg(F.min(test_place).alias("t"), F.min(ci_place).alias("c"))
        .select(
            "full_name",
            "branch",
            _path_at(TEST_PATHS, "t").alias("test_evidence"),
            _path_at(CI_PATHS, "c").alias("ci_evidence"),
        )
        .filter(F.col("test_evidence").isNotNull() | F.col("ci_evidence").isNotNull())
    )


def best_evidence(*found: DataFrame) -> DataFrame:
    """The foremost of the paths that several lookups of a place have found."""
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return (
        whole.groupBy("full_name", "branch")
        .agg(
            F.min(_priority(F.col("test_evidence"), TEST_PATHS)).alias("t"),
            F.min(_priority(F.col("ci_evidence"), CI_PATHS)).alias("c"),
        )
        .select(
            "full_name",
            "branch",
            _path_at(TEST_PATHS, "t").alias("test_evidence"),
            _path_at(CI_PATHS, "c").alias("ci_evidence"),
        )
    )


def _path_at(paths: list[str], place: str) -> Column:
    return F.get(F.array(*[F.lit(p) for p in paths]), F.col(place) - 1)


def failed_lookups(statuses: DataFrame) -> DataFrame:
    """Path lookups whose outcome is unknown: neither found nor 404."""
    return statuses.filter((F.col("status") >= 400) & (F.col("status") != 404))


def split_unknown(repos: DataFrame, statuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repositories whose lookups all have an outcome, and those to be tried again.

    A lookup that failed tells nothing, so its repository is neither enriched
    nor counted now; it comes back when a later try succeeds. ``statuses`` has
    one row per lookup, with ``full_name``, ``branch`` and ``status``.
    """
    unknown = failed_lookups(statuses).select(
        "full_name", F.col("branch").alias("default_branch")
    ).distinct()
    keys = ["full_name", "default_branch"]
    return repos.join(unknown, keys, "left_anti"), repos.join(unknown, keys, "left_semi")


def with_defaults(repos: DataFrame) -> DataFrame:
    """Enrichment columns of a run with lookups switched off."""
    return repos.withColumns(
        {
            "commit_count": F.lit(None).cast("bigint"),
            "has_tests": F.lit(False),
            "has_ci": F.lit(False),
        }
    )


def enrich(repos: DataFrame, stats: DataFrame, evidence: DataFrame) -> DataFrame:
    """Left join both lookups; every repository stays, once.

    Both lookups are unique per key before the shuffle, so only ``repos`` can be
    skewed, which the skew-join split handles on that side. Null names match
    nothing and are spread instead of meeting in one task.
    """
    name = as_col("full_name")
    spread = F.coalesce(name, F.concat(F.lit("\u0000"), F.col("repo_id").cast("string")))
    keyed = repos.withColumn("_name", spread)
    by_name = stats.select(F.col("full_name").alias("_name"), "commit_count")
    by_branch = evidence.select(
        F.col("full_name").alias("_name"),
        F.col("branch").alias("_branch"),
        "test_evidence",
        "ci_evidence",
    ).alias("e")
    joined = keyed.join(by_name, "_name", "left").alias("r")
    same_place = (F.col("r._name") == F.col("e._name")) & F.col("default_branch").eqNullSafe(
        F.col("e._branch")
    )
    return joined.join(by_branch, same_place, "left").select(
        *[F.col(f"r.{c}") for c in repos.columns],
        F.col("r.commit_count"),
        F.col("test_evidence").isNotNull().alias("has_tests"),
        F.col("ci_evidence").isNotNull().alias("has_ci"),
        "test_evidence",
        "ci_evidence",
    )
