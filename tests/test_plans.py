"""What the plans of the registered queries must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from repotide.plans import batch_queries

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(batch_queries.QUERIES)


def plan_of(spark, name):
    frame = entry.queries()[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


def count(pattern, plan):
    return len(re.findall(pattern, plan))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|InPandas|Arrow", plan)


@pytest.mark.parametrize("name, scans, shuffles", [
    ("q1_languages", 1, 2),
    ("q2_projects", 1, 2),
    ("rankings_all", 1, 3),
    ("union_fields_first_seen", 1, 1),
    ("dedupe_accounting", 1, 3),
    ("adaptive_ranges", 1, 3),
    ("path_first_match", 1, 1),
    ("validate_summary", 1, 1),
    ("page_metadata", 1, 2),
    ("keyed_messages", 1, 0),
    ("slice_calendar", 1, 0),
])
def test_scans_and_shuffles(spark, name, scans, shuffles):
    plan = plan_of(spark, name)
    assert count("FileScan parquet", plan) == scans
    assert count("Exchange hashpartitioning", plan) == shuffles


@pytest.mark.parametrize("name", ["q1_languages", "first_seen", "slice_dedupe", "slice_limit", "rankings_all"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert count(r"WindowGroupLimit .*Partial", plan) >= 1


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(spark, "range_predicate")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(value" in pushed and "LessThan(ts" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(spark, "q2_projects")).group(1)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "user_id", "props"}


@pytest.mark.parametrize("name", ["validate_summary", "language_preview", "page_items", "page_metadata"])
def test_json_is_parsed_once(spark, name):
    assert count(r"from_json\(", plan_of(spark, name)) <= (3 if name == "page_items" else 1)


def test_history_repeats_no_name_for_every_snapshot(spark):
    """A thousand names over thirty snapshots: rows follow changes, not spans."""
    from repotide.operators import history
    repos = spark.range(1000).selectExpr(
        "id as seq", "id as repo_id", "concat('p', id) as full_name", "concat('l', id) as language",
        "id as commit_count", "true as has_tests", "true as has_ci", "lpad(id % 30, 2, '0') as snapshot",
    )
    snapshots = history.number_snapshots(repos)
    held = history.held_counts(repos, snapshots)
    nodes = held.selectExpr("idx", "until").withColumn("n", history.covering_nodes("idx", "until"))
    assert held.count() == 4000
    assert nodes.selectExpr("max(size(n))").first()[0] <= 8
