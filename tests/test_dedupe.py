import pytest
from pyspark.sql import functions as F

from repotide.functions.columns import record_key
from repotide.operators import dedupe
from repotide.operators.joins import salted_lookup

CRAWL = "date_field string, rank int, day string, pos int, repo_id bigint"
SLICE = ["date_field", "rank", "day"]


def order():
    return [F.desc("day"), F.asc("rank"), F.asc("pos")]


def crawl(spark, *rows):
    return spark.createDataFrame(list(rows), CRAWL)


def test_record_key_falls_back_to_the_lower_cased_name(spark, rows):
    df = spark.createDataFrame([(1, "A/B"), (None, "C/D")], "repo_id bigint, full_name string")
    assert rows(df.select(record_key())) == [("1",), ("c/d",)]


def test_repeat_inside_one_slice(spark):
    df = crawl(spark, ("created", 0, "d", 0, 1), ("created", 0, "d", 1, 1), ("created", 0, "d", 2, 2))
    unique = dedupe.first_seen(df, ["repo_id"], order())
    assert sorted(r["pos"] for r in unique.collect()) == [0, 2]
    (row,) = dedupe.dedupe_accounting(df, SLICE, "repo_id", order()[:2]).collect()
    assert row[3:] == (3, 1, 0, 2)


def test_two_fields_share_repositories(spark):
    both = [(f, r, "d", i, i) for r, f in enumerate(("created", "pushed")) for i in (1, 2)]
    extra = [("created", 0, "d", 3, 3), ("pushed", 1, "d", 4, 4)]
    counts = dedupe.dedupe_accounting(crawl(spark, *both, *extra), SLICE, "repo_id", order()[:2])
    total = counts.agg(*[F.sum(c) for c in ("fetched", "duplicate_in_slice", "duplicate_global", "emitted")])
    assert tuple(total.first()) == (6, 0, 2, 4)


def test_newest_day_and_created_come_first(spark):
    df = crawl(spark, ("pushed", 1, "2028-02-29", 0, 1), ("created", 0, "2028-02-28", 0, 1),
               ("created", 0, "2028-02-29", 9, 1))
    (row,) = dedupe.first_seen(df, ["repo_id"], order()).collect()
    assert (row["day"], row["date_field"]) == ("2028-02-29", "created")


def test_slice_limit_comes_before_and_global_limit_after_deduplication(spark):
    df = crawl(spark, *[("created", 0, "d", i, i // 2) for i in range(8)])
    limited = dedupe.limit_per_group(df, SLICE, order(), 4)
    assert dedupe.first_seen(limited, ["repo_id"], order()).count() == 2
    unique = dedupe.first_seen(df, ["repo_id"], order())
    assert [r["repo_id"] for r in dedupe.limit_rows(unique, order(), 3).collect()] == [0, 1, 2]


def test_large_limits_are_exact(spark):
    df = spark.range(9000).select((F.col("id") % 2).alias("g"), "id")
    kept = dedupe.limit_per_group(df, ["g"], ["id"], 2500)
    assert kept.groupBy("g").agg(F.count("*"), F.max("id")).orderBy("g").collect() == [
        (0, 2500, 4998),
        (1, 2500, 4999),
    ]


@pytest.mark.parametrize("limit", [dedupe.limit_rows, lambda df, o, n: dedupe.limit_per_group(df, ["repo_id"], o, n)])
def test_limits_below_one_are_refused(spark, limit):
    with pytest.raises(ValueError):
        limit(crawl(spark), order(), 0)


def test_tightest_limit_skips_unset_ones():
    assert dedupe.tightest_limit(None, 5, 3) == 3
    assert dedupe.tightest_limit(None) is None


def test_without_ignores_repeats_in_the_done_ids(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (2,)], "repo_id bigint")
    done = spark.createDataFrame([(1,), (1,)], "repo_id bigint")
    assert rows(dedupe.without(df, done, "repo_id")) == [(2,), (2,)]


@pytest.mark.parametrize("min_hot_rows", [1, 100, 10_000])
def test_salted_lookup_equals_a_plain_join(spark, rows, min_hot_rows):
    left = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    salted = salted_lookup(left, lookup, ["k"], counts, "id", min_hot_rows, salts=4)
    assert rows(salted, "id", "k", "v") == rows(left.join(lookup, "k"), "id", "k", "v")
