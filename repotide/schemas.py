"""Record schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# A normalized repository record, in field order.
RAW_REPO = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stars", T.LongType()),
        T.StructField("forks", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("pushed_at", T.StringType()),
        T.StructField("size_kb", T.LongType()),
        T.StructField("default_branch", T.StringType()),
        T.StructField("crawl_day", T.StringType()),
        T.StructField("archived", T.BooleanType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("open_issues_count", T.LongType()),
        T.StructField("emitted_at", T.StringType()),
    ]
)

# The record fields whose absence is an error.
REQUIRED_FIELDS = [
    "repo_id",
    "full_name",
    "language",
    "stars",
    "forks",
    "created_at",
    "updated_at",
    "pushed_at",
    "size_kb",
    "default_branch",
    "crawl_day",
]

ENRICHED_REPO = T.StructType(
    RAW_REPO.fields
    + [
        T.StructField("commit_count", T.LongType()),
        T.StructField("has_tests", T.BooleanType()),
        T.StructField("has_ci", T.BooleanType()),
    ]
)

# What the rankings need of an enriched record, and its place in arrival order.
RANKED_REPO = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("repo_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("commit_count", T.LongType()),
        T.StructField("has_tests", T.BooleanType()),
        T.StructField("has_ci", T.BooleanType()),
    ]
)

# One item of a search result page.
SEARCH_ITEM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("forks_count", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("pushed_at", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("default_branch", T.StringType()),
        T.StructField("archived", T.BooleanType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("open_issues_count", T.LongType()),
    ]
)

# Lookup paths in priority order, and the words a test
# configuration file must mention.
TEST_DIRECTORIES = ["tests", "test", "spec", "__tests__"]
TEST_CONFIG_FILES = ["pytest.ini", "package.json", "pom.xml", "Cargo.toml"]
TEST_PATHS = TEST_DIRECTORIES + TEST_CONFIG_FILES
CI_PATHS = [
    ".github/workflows",
    ".gitlab-ci.yml",
    ".travis.yml",
    "Jenkinsfile",
    ".circleci/config.yml",
]
TEST_WORDS = ["pytest", "unittest", "jest", "junit", "rspec", "go test", "cargo test"]

# Search results one query can return, and ranking length.
SEARCH_CAP = 1000
DEFAULT_TOP_N = 10
DEFAULT_MAX_RETRIES = 3
DEFAULT_FLUSH_EVERY = 100

UNKNOWN_LANGUAGE = "Unknown"
UNKNOWN_LANGUAGE_IN_REPORT = "UNKNOWN"

# Ranking questions.
Q_LANGUAGES = "q1_languages"
Q_PROJECTS = "q2_projects"
Q_TESTS = "q3_tests"
Q_TESTS_CI = "q4_tests_ci"
