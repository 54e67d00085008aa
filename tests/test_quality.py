import json

import pytest

from repotide.operators import quality
from repotide.schemas import REQUIRED_FIELDS

GOOD = {f: 1 for f in REQUIRED_FIELDS} | {"repo_id": 1, "language": "Python"}


def lines(spark, *texts):
    rows = [(i + 1, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "line_no bigint, line string")


def summary(spark, *texts):
    row = quality.line_summary(lines(spark, *texts)).first()
    return tuple(row)


def test_one_good_line(spark):
    assert summary(spark, GOOD) == (1, 0, 0, 0, False)


def test_two_incomplete_lines_with_one_id(spark):
    bad = {"repo_id": 1, "full_name": "a/b"}
    assert summary(spark, bad, bad) == (2, 1, 2, 0, True)


def test_no_lines(spark):
    assert summary(spark) == (0, 0, 0, 0, False)


@pytest.mark.parametrize("text, valid", [
    ('{"a": 1}', True), ('  {"a": 1}\t', True), ("{}", True), ('{"a": {"b": [1]}}', True),
    ("[1]", False), ("1", False), ('"x"', False), ("null", False), ("{", False),
    ('{"a": 1} xyz', False), ('{"a": 1} {"b": 2}', False), ('{"a": 1}, {"b": 2}', False),
    ("{'a': 1}", False), ("not json", False),
])
def test_a_record_is_exactly_one_json_object(spark, text, valid):
    (row,) = quality.parse_lines(lines(spark, text)).collect()
    assert row["is_record"] is valid


def test_a_present_null_is_not_missing(spark):
    record = dict(GOOD, language=None)
    del record["stars"], record["forks"]
    (row,) = quality.parse_lines(lines(spark, record)).collect()
    assert row["missing"] == "forks, stars"


def test_key_is_the_id_unless_it_is_zero(spark):
    found = quality.parse_lines(lines(
        spark, {"repo_id": 5}, {"repo_id": 0, "full_name": "A/B"}, {"full_name": "C/D"}, {"x": 1},
        {"full_name": None},
    )).orderBy("line_no").collect()
    assert [r["key"] for r in found] == ["5", "a/b", "c/d", "", "none"]


def test_diagnostics_number_all_lines_and_flag_every_repeat(spark, rows):
    df = lines(spark, GOOD, "", GOOD, "oops", {"x": 1}, {"y": 2}, GOOD)
    found = quality.line_diagnostics(df)
    assert rows(found, "line_no", "invalid_json", "is_duplicate") == [
        (1, False, False), (3, False, True), (4, True, False), (5, False, False),
        (6, False, True), (7, False, True),
    ]


def test_language_preview_uses_its_own_label(spark):
    df = lines(spark, GOOD, dict(GOOD, language=None), dict(GOOD, language=""), "oops")
    top = quality.language_preview(df).orderBy("rk").collect()
    assert [tuple(r) for r in top] == [(1, "UNKNOWN", 2), (2, "Python", 1)]


def test_judge_lines_tells_why(spark, rows):
    df = lines(spark, GOOD, "oops", {"repo_id": 1})
    reasons = dict(rows(quality.judge_lines(df, ("line_no",))))
    assert reasons[1] is None and reasons[2] == "invalid json"
    assert reasons[3].startswith("missing: crawl_day, created_at")
