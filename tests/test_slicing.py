import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repotide.functions.columns import day_expression, query_text, slice_id, slice_suffix
from repotide.operators import slicing
from repotide.sources.slices import SLICE_KEYS, SliceStore

# A leap day two days back: the calendar crosses a month's end.
DAY = dt.date(2028, 3, 1)


def test_calendar_runs_from_newest_to_oldest(spark):
    asked = spark.createDataFrame([(DAY, 4, "pushed")], "end_date date, days int, mode string")
    found = slicing.slice_calendar(asked).orderBy("day_rank").collect()
    assert [r["crawl_day"] for r in found] == ["2028-03-01", "2028-02-29", "2028-02-28", "2028-02-27"]
    assert {r["date_field"] for r in found} == {"pushed"}


def test_combined_mode_gives_created_then_pushed(spark):
    asked = spark.createDataFrame([(DAY, 2, "created-or-pushed")], "end_date date, days int, mode string")
    found = slicing.slice_calendar(asked).orderBy("day_rank", "field_rank").collect()
    assert [r["date_field"] for r in found] == ["created", "pushed"] * 2


def test_query_text(spark):
    row = spark.range(1).select(
        query_text(F.lit("created"), F.lit("1999-12-31"), F.lit("\ttopic:etl  fork:true")),
        query_text(F.lit("pushed"), day_expression(F.lit("1999-12-31")), F.lit(None)),
    ).first()
    assert tuple(row)[1] == "pushed:1999-12-31T00:00:00Z..1999-12-31T23:59:59Z"
    assert row[0].startswith("created:1999-12-31 ") and row[0].endswith("topic:etl  fork:true")


def test_slice_suffix_and_collision_free_id(spark):
    raw = ["forks:>=7 mirror:true", "size:>9", "size:<9", "", None, " !! "]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    found = df.select(slice_suffix("s"), slice_id("s")).collect()
    assert [r[0] for r in found] == ["_forks___7_mirror_true", "_size__9", "_size__9", "", "", ""]
    assert found[1][1] != found[2][1]


def halve(counts, cap, s=0, e=86_399):
    """Leaf ranges by plain recursion."""
    n = sum(c for sec, c in counts.items() if s <= sec <= e)
    if n <= cap or s == e:
        return [(s, e, n)]
    mid = s + (e - s) // 2
    return halve(counts, cap, s, mid) + halve(counts, cap, mid + 1, e)


second = st.one_of(
    st.integers(0, 86_399), st.sampled_from([0, 1, 43_199, 43_200, 86_398, 86_399])
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(second, st.integers(1, 30), min_size=1, max_size=20), min_size=1, max_size=3),
       st.integers(1, 25))
def test_ranges_equal_recursive_halving(spark, days, cap):
    dates = [DAY + dt.timedelta(days=i) for i in range(len(days))]
    rows = [(d, s, n) for d, counts in zip(dates, days) for s, n in counts.items()]
    seconds = spark.createDataFrame(rows, "day date, sec int, n bigint")
    leaves = slicing.adaptive_ranges(seconds, cap).collect()
    for date, counts in zip(dates, days):
        found = sorted((r["s"], r["e"], r["n"]) for r in leaves if r["day"] == date)
        assert found == halve(counts, cap)
        # They tile the day.
        assert found[0][0] == 0 and found[-1][1] == 86_399
        assert all(a[1] + 1 == b[0] for a, b in zip(found, found[1:]))


def test_one_cut_makes_two_halves_within_the_cap(spark):
    seconds = spark.createDataFrame([(DAY, 43_199, 600), (DAY, 43_200, 999)], "day date, sec int, n bigint")
    summary = slicing.range_summary(slicing.adaptive_ranges(seconds)).first()
    assert (summary["leaves"], summary["splits"], summary["over_cap"]) == (2, 1, 0)


def test_a_full_second_cannot_be_cut(spark):
    seconds = spark.createDataFrame([(DAY, 5, 1500)], "day date, sec int, n bigint")
    leaves = slicing.adaptive_ranges(seconds)
    (over,) = leaves.filter("over_cap").collect()
    assert (over["s"], over["e"], over["n"]) == (5, 5, 1500)


def test_range_queries_name_whole_seconds(spark):
    seconds = spark.createDataFrame([(DAY, 5, 1)], "day date, sec int, n bigint")
    leaves = slicing.adaptive_ranges(seconds, 5)
    (row,) = slicing.range_queries(leaves, "pushed", "stars:>=100").collect()
    assert row["query"] == "pushed:2028-03-01T00:00:00Z..2028-03-01T23:59:59Z stars:>=100"


def test_every_row_is_assigned_to_its_leaf(spark):
    rows = spark.range(600).select(
        "id", F.lit(DAY).alias("day"),
        F.when(F.col("id") % 3 == 0, 777).otherwise((F.col("id") * 7919) % 86_400).cast("int").alias("sec"),
    )
    seconds = slicing.second_counts(rows)
    assigned = slicing.assign_ranges(rows, seconds, "id", 20, min_hot_rows=50)
    assert assigned.count() == 600
    assert assigned.filter("sec < s or sec > e").isEmpty()
    leaves = slicing.adaptive_ranges(seconds, 20).filter("n > 0").select("s", "e", "n")
    counted = assigned.groupBy("s", "e").agg(F.count("*").alias("n"))
    assert counted.exceptAll(leaves).isEmpty() and leaves.exceptAll(counted).isEmpty()


def store_rows(spark, *rows):
    return spark.createDataFrame(
        list(rows), "date_field string, crawl_day string, query_key string, repo_id bigint, pos int"
    )


def test_slice_store_dedupes_lists_and_replaces(spark, tmp_path, rows):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    one, two = ("created", "2028-02-29", "all"), ("pushed", "2028-02-29", "all")
    wanted = spark.createDataFrame([one, two], keys)
    assert store.hits(wanted).isEmpty() and store.misses(wanted).count() == 2

    first = spark.createDataFrame([one], keys)
    store.write(store_rows(spark, (*one, 1, 0), (*one, 1, 1), (*one, 2, 2)), first, ["pos"])
    assert rows(store.read(wanted), "repo_id", "pos") == [(1, 0), (2, 2)]
    assert rows(store.hits(wanted)) == [one] and rows(store.misses(wanted)) == [two]

    # A slice without rows is complete as well, and other slices stay.
    store.write(store_rows(spark), spark.createDataFrame([two], keys), ["pos"])
    assert store.misses(wanted).isEmpty()
    store.write(store_rows(spark, (*one, 9, 0)), first, ["pos"])
    assert rows(store.read(), "repo_id") == [(9,)]


def test_rows_without_manifest_entry_are_not_read(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    one = ("created", "2028-02-29", "all")
    unlisted = f"{store.rows_path}/version=v1"
    store_rows(spark, (*one, 1, 0)).write.partitionBy(*SLICE_KEYS).parquet(unlisted)
    assert store.read().isEmpty()


def test_provenance(spark, rows):
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    wanted = spark.createDataFrame([("created", "a", "q"), ("created", "b", "q"), ("pushed", "a", "q")], keys)
    manifest = spark.createDataFrame([("created", "a", "q")], keys)
    assert rows(slicing.slice_provenance(wanted, manifest, SLICE_KEYS)) == [
        ("created", 1, 1), ("pushed", 0, 1)
    ]


def test_serving_stores_what_is_missing_and_reuses_what_is_there(spark, tmp_path, rows):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    one, two = ("created", "2028-02-29", "all"), ("pushed", "2028-02-29", "all")
    wanted = spark.createDataFrame([one, two], keys)
    old = store_rows(spark, (*one, 1, 0), (*one, 1, 1))
    store.serve(spark.createDataFrame([one], keys), old, ["pos"])
    new = store_rows(spark, (*one, 7, 0), (*two, 2, 0), (*two, 3, 1))
    assert rows(store.serve(wanted, new, ["pos"]), "repo_id") == [(1,), (2,), (3,)]
    assert store.misses(wanted).isEmpty()
    assert rows(store.serve(wanted, new, ["pos"], refresh=True), "repo_id") == [(2,), (3,), (7,)]


def test_limited_serving_stores_nothing(spark, tmp_path, rows):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    one = ("created", "2028-02-29", "all")
    wanted = spark.createDataFrame([one], keys)
    new = store_rows(spark, (*one, 1, 0), (*one, 1, 1), (*one, 2, 2))
    assert rows(store.serve(wanted, new, ["pos"], limit=2), "repo_id", "pos") == [(1, 0)]
    assert store.misses(wanted).count() == 1


def test_crawl_emits_each_repository_once_stamped_and_stores_it_unstamped(spark, tmp_path, rows):
    from repotide.plans.crawl import crawl_window

    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    one, two = ("created", "2028-02-29", "all"), ("pushed", "2028-02-29", "all")
    wanted = spark.createDataFrame([one, two], keys)
    found = store_rows(spark, *[(*one, i, i) for i in (1, 2, 3)], *[(*two, i, i) for i in (2, 3, 4)])
    order = [F.desc("crawl_day"), F.asc("date_field"), F.asc("pos")]
    emitted = crawl_window(store, wanted, found, ["pos"], order)
    assert rows(emitted, "date_field", "repo_id") == [
        ("created", 1), ("created", 2), ("created", 3), ("pushed", 4)
    ]
    assert emitted.filter("emitted_at is null").isEmpty()
    assert "emitted_at" not in store.read().columns
    assert rows(crawl_window(store, wanted, found, ["pos"], order, limit=2), "repo_id") == [(1,), (2,)]


def test_range_is_inclusive_in_whole_seconds_and_reaches_the_scan(spark, tmp_path, rows):
    path = str(tmp_path / "rows")
    stamps = [dt.datetime(2028, 2, 29, 0, 0, 0), dt.datetime(2028, 2, 29, 0, 0, 9, 999_999),
              dt.datetime(2028, 2, 29, 0, 0, 10), dt.datetime(2028, 2, 28, 23, 59, 59, 999_999)]
    spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, ts timestamp").write.parquet(path)
    bounds = ("2028-02-29T00:00:00Z", "2028-02-29T00:00:09Z")
    found = slicing.rows_in_range(spark.read.parquet(path), "ts", *bounds)
    assert rows(found, "i") == [(0,), (1,)]
    assert rows(slicing.rows_in_range(spark.read.parquet(path), "ts", *bounds, "i > 0"), "i") == [(1,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_different_suffixes_never_share_a_slice(spark):
    from repotide.sources.slices import with_query_key

    asked = spark.createDataFrame([("stars:>10",), ("stars:<10",), ("",)], "query_suffix string")
    assert with_query_key(asked).select("query_key").distinct().count() == 3


def test_reading_prunes_the_days_not_asked_for(spark, tmp_path):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = ", ".join(f"{k} string" for k in SLICE_KEYS)
    slices = [("created", f"2026-05-1{i}", "all") for i in range(5)]
    stored = store_rows(spark, *[(*s, i, 0) for i, s in enumerate(slices)])
    store.write(stored, spark.createDataFrame(slices, keys), ["pos"])
    found = store.read(spark.createDataFrame(slices[1:2], keys))
    assert [r["repo_id"] for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "crawl_day" in plan.split("PartitionFilters: [")[1] and "2026-05-11" in plan


def test_a_refresh_empties_a_slice_and_works_with_a_limit(spark, tmp_path, rows):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, pos int")
    keys = "date_field string, crawl_day string, query_key string"
    one, two = ("created", "2028-02-28", "all"), ("created", "2028-02-29", "all")
    wanted = spark.createDataFrame([one, two], keys)
    old = store_rows(spark, (*one, 1, 0), (*one, 2, 1), (*one, 3, 2), (*two, 4, 0))
    store.serve(wanted, old, ["pos"])
    new = store_rows(spark, (*one, 8, 0), (*one, 9, 1))
    # A limit cuts what is fetched, not what is stored.
    assert rows(store.serve(wanted, new, ["pos"], limit=1), "repo_id") == [(1,), (2,), (3,), (4,)]
    assert rows(store.serve(wanted, new, ["pos"], limit=1, limit_stored=True), "repo_id") == [(1,), (4,)]
    assert rows(store.serve(wanted, new, ["pos"], limit=1, refresh=True), "repo_id") == [(8,)]
    assert rows(store.read(wanted), "repo_id") == [(1,), (2,), (3,), (4,)]
    assert rows(store.serve(wanted, new, ["pos"], refresh=True), "repo_id") == [(8,), (9,)]
    assert rows(store.read(wanted), "repo_id") == [(8,), (9,)] and store.misses(wanted).isEmpty()


def test_records_without_id_are_told_apart_by_name(spark, tmp_path, rows):
    store = SliceStore(spark, str(tmp_path), "repo_id bigint, full_name string, pos int")
    one = ("created", "2028-02-29", "all")
    given = spark.createDataFrame(
        [(*one, None, "x/one", 0), (*one, None, "x/two", 1), (*one, 3, "x/three", 2), (*one, None, "X/One", 3)],
        "date_field string, crawl_day string, query_key string, repo_id bigint, full_name string, pos int",
    )
    served = store.serve(given.select(*SLICE_KEYS), given, ["pos"])
    assert rows(served, "full_name") == [("x/one",), ("x/three",), ("x/two",)]
