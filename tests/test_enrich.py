import base64

import pytest

from repotide.functions import columns as C
from repotide.operators import enrich

LINK = (
    '<https://api.example/r?per_page=1&page=2>; rel="next", '
    '<https://api.example/r?per_page=1&page=58>; rel="last"'
)
ONLY_NEXT = '<https://api.example/r?page=2>; rel="next"'


@pytest.mark.parametrize("header, last, following", [
    (LINK, 58, "https://api.example/r?per_page=1&page=2"),
    (ONLY_NEXT, None, "https://api.example/r?page=2"),
    ("", None, None),
    ('<https://api.example/r>; rel="last"', None, None),
])
def test_link_header(spark, header, last, following):
    row = spark.createDataFrame([(header,)], "h string").select(
        C.last_page("h"), C.link_url("h", "next")
    ).first()
    assert tuple(row) == (last, following)


@pytest.mark.parametrize("status, link, body, expected", [
    (200, LINK, "[]", 58),
    (200, "", '[{"sha":"a"}]', 1),
    (200, "", "[]", 0),
    (200, "", '{"message":"x"}', None),
    (200, "", "no json", None),
    (200, "", "[1] tail", None),
    (200, "", '[1,[2,3]]', 2),
    (409, LINK, "[]", 0),
    (404, LINK, "[]", None),
    (500, "", "[]", None),
])
def test_commit_count(spark, status, link, body, expected):
    df = spark.createDataFrame([(status, link, body)], "status int, link string, body string")
    assert df.select(C.commit_count("status", "link", "body")).first()[0] == expected


@pytest.mark.parametrize("content, text", [
    (base64.b64encode("häst jest".encode()).decode(), "häst jest"),
    (base64.b64encode(b"ab\xffcd").decode(), "abcd"),
    ("cnVu\nIHB5\ndGVzdA==\n", "run pytest"),
    ("abcde", ""),
    (None, ""),
])
def test_decode_content(spark, content, text):
    df = spark.createDataFrame([(content,)], "c string")
    assert df.select(C.decode_content("c")).first()[0] == text


@pytest.mark.parametrize("text, hit", [
    ("we use PyTest", True), ("majestic", True), ("go  test", False), ("go test ./...", True), (None, False),
])
def test_test_words(spark, text, hit):
    assert spark.createDataFrame([(text,)], "t string").select(C.mentions_test_tool("t")).first()[0] is hit


def contents(spark, *found):
    return spark.createDataFrame(
        [(n, b, p, None if t is None else base64.b64encode(t.encode()).decode()) for n, b, p, t in found],
        "full_name string, branch string, path string, content string",
    )


def test_first_path_in_priority_order_is_the_evidence(spark, rows):
    df = contents(
        spark,
        ("a", "main", "spec", None),
        ("a", "main", "tests", None),
        ("a", "main", "Jenkinsfile", ""),
        ("a", "main", ".travis.yml", ""),
        ("b", "main", "package.json", "nothing"),
        ("b", "main", "pom.xml", "uses JUnit"),
        ("c", "main", "package.json", None),
        ("c", "main", "README", "pytest"),
    )
    assert rows(enrich.path_evidence(df)) == [
        ("a", "main", "tests", ".travis.yml"),
        ("b", "main", "pom.xml", None),
    ]


def test_enrichment_keeps_every_repository_and_asks_its_own_branch(spark, rows):
    repos = spark.createDataFrame(
        [(1, "a", "main"), (2, "a", "dev"), (3, "b", None), (4, None, "main"), (5, None, "main")],
        "repo_id bigint, full_name string, default_branch string",
    )
    stats = spark.createDataFrame([("a", 5), ("b", 0)], "full_name string, commit_count bigint")
    evidence = enrich.path_evidence(
        contents(spark, ("a", "main", "test", None), ("b", None, "Jenkinsfile", ""))
    )
    found = enrich.enrich(repos, stats, evidence)
    assert rows(found, "repo_id", "commit_count", "has_tests", "has_ci", "test_evidence") == [
        (1, 5, True, False, "test"),
        (2, 5, False, False, None),
        (3, 0, False, True, None),
        (4, None, False, False, None),
        (5, None, False, False, None),
    ]


def test_defaults_without_lookups(spark, rows):
    repos = spark.createDataFrame([(1,)], "repo_id bigint")
    assert rows(enrich.with_defaults(repos)) == [(1, None, False, False)]


def test_only_a_404_means_absent(spark, rows):
    df = spark.createDataFrame([("a", 200), ("b", 404), ("c", 500)], "full_name string, status int")
    assert rows(enrich.failed_lookups(df), "full_name") == [("c",)]


def test_commit_stats(spark, rows):
    df = spark.createDataFrame(
        [("a", 409, "", "[]")], "full_name string, status int, link string, body string"
    )
    assert rows(enrich.commit_stats(df)) == [("a", 0)]


@pytest.mark.parametrize("data, expected", [
    ("a\ufffdb".encode(), "a\ufffdb"), (b"a\xffb", "ab"), (b"", ""), ("é".encode(), "é"),
])
def test_only_broken_bytes_are_dropped(spark, data, expected):
    df = spark.createDataFrame([(base64.b64encode(data).decode(),)], "c string")
    assert df.select(C.decode_content("c")).first()[0] == expected
