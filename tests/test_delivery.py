import json

import pytest
from pyspark.sql import types as T

from repotide.operators import delivery
from repotide.schemas import RAW_REPO
from repotide.sources import published, records, topics

SCHEMA = T.StructType([T.StructField("repo_id", T.LongType()), T.StructField("name", T.StringType())])


def test_message_is_keyed_by_id_with_sorted_fields_and_nulls(spark):
    df = spark.createDataFrame([("x", 7, None)], "name string, repo_id bigint, language string")
    (row,) = delivery.keyed_messages(df).collect()
    assert tuple(row) == ("7", '{"language":null,"name":"x","repo_id":7}')


@pytest.mark.parametrize("size, expected", [(100, [5]), (2, [2, 2, 1]), (1, [1] * 5)])
def test_envelopes_hold_at_most_their_size_in_order(spark, size, expected):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(5)], SCHEMA)
    packed = delivery.pack_envelopes(df, "repo_id", size).orderBy("envelope").collect()
    bodies = [json.loads(r["value"])["records"] for r in packed]
    assert [len(b) for b in bodies] == expected
    assert [r["repo_id"] for b in bodies for r in b] == list(range(5))


def test_envelope_size_is_positive(spark):
    with pytest.raises(ValueError):
        delivery.pack_envelopes(spark.createDataFrame([], SCHEMA), "repo_id", 0)


@pytest.mark.parametrize("value, expected", [
    ('{"records":[{"repo_id":1,"name":"a"},{"repo_id":"2"}]}', [(1, "a", None), (2, None, None)]),
    ('{"repo_id":3,"name":"c","extra":[1]}', [(3, "c", None)]),
    ('{"records":[]}', []),
    ('{"records":{"repo_id":4}}', [(None, None, "no repo_id")]),
    ('{"records":[{"name":"x"},{"repo_id":5}]}', [(5, None, None), (None, "x", "no repo_id")]),
    ('[{"repo_id":1}]', [(None, None, "not an object")]),
    ("17", [(None, None, "not an object")]),
    ("garbage", [(None, None, "not an object")]),
    ('{"repo_id":1} tail', [(None, None, "not an object")]),
])
def test_envelopes_and_lone_records_unpack(spark, rows, value, expected):
    df = spark.createDataFrame([(value,)], "value string")
    found = delivery.unpack_envelopes(df, SCHEMA)
    assert rows(found, "repo_id", "name", "error") == sorted(expected, key=repr)
    assert all((r["payload"] == value) == (r["error"] is not None) for r in found.collect())


def test_a_commit_count_that_is_no_number_goes_to_quarantine_whole(spark):
    schema = T.StructType([*SCHEMA.fields, T.StructField("commit_count", T.LongType())])
    values = ['{"repo_id":1,"commit_count":"x"}', '{"repo_id":2,"commit_count":"12"}',
              '{"repo_id":3,"commit_count":null}', '{"repo_id":4.0,"commit_count":5}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    found = delivery.unpack_envelopes(df, schema).orderBy("repo_id").collect()
    assert [(r["repo_id"], r["commit_count"], r["error"]) for r in found] == [
        (1, None, "bad commit_count"), (2, 12, None), (3, None, None), (4, 5, None)
    ]


def attempts(spark, *outcomes):
    rows = [(i, n, ok == "+") for i, tried in enumerate(outcomes) for n, ok in enumerate(tried)]
    return spark.createDataFrame(rows, "repo_id bigint, attempt bigint, ok boolean")


@pytest.mark.parametrize("outcomes, max_retries, expected", [
    (["--+"], 3, (1, 2, 0, 0)),
    (["---"], 2, (0, 3, 1, 0)),
    (["+", "--+", "----", "-"], 3, (2, 7, 1, 0)),
    ([], 3, (0, 0, 0, 0)),
])
def test_delivery_totals(spark, outcomes, max_retries, expected):
    found = delivery.delivery_totals(attempts(spark, *outcomes), max_retries=max_retries)
    assert tuple(found.first()) == expected


def test_skipped_records_are_counted_apart(spark):
    skipped = spark.createDataFrame([(8,), (9,)], "repo_id bigint")
    assert tuple(delivery.delivery_totals(attempts(spark, "-+"), skipped).first()) == (1, 1, 0, 2)


def test_ids_published_before_are_skipped(spark, tmp_path, rows):
    path = str(tmp_path / "published")
    sent = spark.createDataFrame([(1,), (2,)], "repo_id bigint")
    assert published.read_published(spark, path).isEmpty()
    published.save_published(sent.filter("repo_id = 1"), path)
    assert rows(published.unpublished(sent, published.read_published(spark, path))) == [(2,)]


def test_published_document_of_another_run(spark, tmp_path, rows):
    document = tmp_path / "ids.json"
    document.write_text('{\n "published_repo_ids": [1, 5]\n}')
    assert rows(published.read_published_document(spark, str(document))) == [(1,), (5,)]


RECORD = {
    "repo_id": 41, "full_name": "lab/loom", "language": "Nim", "stars": 13, "forks": 6,
    "created_at": "2003-04-05T06:07:08Z", "updated_at": "2013-03-04T05:06:07Z",
    "pushed_at": "2023-01-02T03:04:05Z", "size_kb": 19, "default_branch": "trunk",
    "crawl_day": "2023-01-03",
}


def test_scan_skips_blank_lines_and_ignores_new_fields(spark, tmp_path):
    path = tmp_path / "slice.ndjson"
    path.write_text(json.dumps(RECORD | {"novel": 1}) + "\n\n   \n")
    (row,) = records.read_records(spark, str(path)).collect()
    assert row.asDict() == {f: RECORD.get(f) for f in RAW_REPO.names}


def test_checked_scan_sets_bad_lines_aside(spark, tmp_path, rows):
    path = tmp_path / "slice.ndjson"
    path.write_text(json.dumps(RECORD) + '\n{"full_name":""}\n{oops\n')
    good, bad = records.read_records(spark, str(path)), records.bad_lines(spark, str(path))
    assert rows(good, "repo_id") == [(41,)] and bad.count() == 2


def test_written_records_have_sorted_keys_and_a_stamp(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([RECORD], RAW_REPO)
    records.write_records(df, path)
    records.write_records(df, path)
    (line,) = spark.read.text(path).collect()
    found = json.loads(line[0])
    assert list(found) == sorted(RAW_REPO.names)
    assert found["emitted_at"].endswith("Z") and found["topics"] is None
    (back,) = records.read_records(spark, path).drop("emitted_at").collect()
    assert back["full_name"] == "lab/loom"


def test_tap_is_bounded_and_narrow(spark):
    df = spark.createDataFrame([RECORD, RECORD | {"repo_id": 2}], RAW_REPO)
    tapped = records.tap(df, 1)
    assert tapped.columns == ["repo_id", "full_name", "stars", "language"] and tapped.count() == 1


def test_a_topic_keeps_growing(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = spark.createDataFrame([RECORD], RAW_REPO)
    topics.publish(df, path)
    topics.publish(df, path, files=2)
    assert spark.read.text(path).count() == 2
