import json

from pyspark.sql import functions as F

from repotide.sources import pages


def stored(spark, *payloads, query="q"):
    return spark.createDataFrame(
        [
            (query, i + 1, p if p is None or isinstance(p, str) else json.dumps(p))
            for i, p in enumerate(payloads)
        ],
        "query string, page_no bigint, payload string",
    )


# Every field has a value of its own, so that swapped fields show.
ITEM = {
    "id": 71, "full_name": "lab/kiln", "language": "Zig", "stargazers_count": 17, "forks_count": 5,
    "created_at": "2001-02-03T04:05:06Z", "updated_at": "2011-12-13T14:15:16Z",
    "pushed_at": "2021-10-11T09:08:07Z", "size": 23, "default_branch": "trunk",
    "archived": True, "topics": ["ovens", "clay"], "open_issues_count": 29, "score": 0.5,
}


def test_the_three_payload_forms(spark, rows):
    df = stored(spark, {"total_count": 2, "items": [{"id": 1}, {"id": 2}]}, [{"id": 3}], {"id": 4},
                {"items": []})
    assert rows(pages.page_items(df), "page_no", "position", "id") == [
        (1, 0, 1), (1, 1, 2), (2, 0, 3), (3, 0, 4)
    ]


def test_metadata_is_that_of_the_first_object_page(spark, rows):
    df = stored(
        spark,
        [{"id": 1}],
        {"total_count": 4321, "incomplete_results": True, "items": []},
        {"total_count": 7, "items": []},
    )
    assert rows(pages.page_metadata(df)) == [("q", 4321, True)]


def test_malformed_total_is_null_and_missing_flag_is_false(spark, rows):
    df = stored(spark, {"total_count": "many", "items": []})
    meta = pages.page_metadata(df)
    assert rows(meta) == [("q", None, False)]
    assert rows(pages.completeness(meta)) == [("q", False, False)]


def test_cap_is_inclusive_and_gates_completeness(spark, rows):
    meta = spark.createDataFrame(
        [("a", 1000, False), ("b", 1001, False), ("c", None, True)],
        "query string, total_count bigint, incomplete_results boolean",
    )
    flags = pages.completeness(meta)
    assert rows(flags) == [("a", False, False), ("b", True, False), ("c", False, True)]
    assert rows(pages.crawl_gate(flags)) == [(1, 1, False)]
    assert rows(pages.crawl_gate(flags.filter("query = 'a'"))) == [(0, 0, True)]


def test_normalize_renames_and_stamps_the_slice_day(spark):
    items = pages.page_items(stored(spark, {"items": [ITEM]}))
    (row,) = pages.normalize_items(items, F.lit("2021-10-12")).collect()
    assert row.asDict() == {
        "repo_id": 71, "full_name": "lab/kiln", "language": "Zig", "stars": 17, "forks": 5,
        "created_at": "2001-02-03T04:05:06Z", "updated_at": "2011-12-13T14:15:16Z",
        "pushed_at": "2021-10-11T09:08:07Z", "size_kb": 23, "default_branch": "trunk",
        "crawl_day": "2021-10-12", "archived": True, "topics": ["ovens", "clay"],
        "open_issues_count": 29, "emitted_at": None,
    }


def test_payloads_that_are_no_pages_are_errors_and_no_items(spark, rows):
    df = stored(
        spark, "not json", {"message": "slow down"}, {"items": None}, "[", [1], {"items": []},
        [{"id": "5"}], {"items": [{"id": 8}, {"full_name": "x"}]}, None,
    )
    assert rows(pages.page_items(df), "page_no", "id") == [(7, 5), (8, 8)]
    assert rows(pages.page_errors(df), "page_no", "reason") == [
        *((i, "unreadable") for i in range(1, 6)), (8, "item without id"), (9, "unreadable")
    ]
    gate = pages.crawl_gate(pages.completeness(pages.page_metadata(df)), pages.page_errors(df))
    assert rows(gate, "page_errors", "complete") == [(7, False)]


def test_a_page_with_something_behind_it_is_an_error(spark, rows):
    df = stored(spark, '{"id":7} x', '{"id":7}] x', '[{"id":3}] y', "[{\"id\":3}], [1]", '{"id":7},{"id":8}',
                '{"items":[{"id":1}]}{', ' {"id": 9} ', ' [ {"id":10} ] ', "", "  ")
    assert rows(pages.page_items(df), "page_no", "id") == [(7, 9), (8, 10)]
    assert rows(pages.page_errors(df), "page_no") == [(i,) for i in (1, 10, 2, 3, 4, 5, 6, 9)]
