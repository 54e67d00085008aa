"""Registered batch queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions import columns as C
from repotide.operators import (
    dedupe,
    delivery,
    enrich,
    history,
    quality,
    rankings,
    slicing,
)
from repotide.operators.counters import Counters
from repotide.plans import crawl, views
from repotide.session import fresh_dir, materialize
from repotide.sources import pages, published, records
from repotide.sources.slices import SLICE_KEYS, SliceStore, with_query_key
from repotide.sources.topics import read_table

# Range cap for the test tables; the default of the operator is the search cap.
RANGE_CAP = 40
CRAWL_SCHEMA = "field_rank int, repo_id bigint, stars bigint, event_id bigint"


def first_seen_repos(spark, sf_dir):
    return dedupe.first_seen(views.raw_repos(spark, sf_dir), ["repo_id"], ["seq"])


# --- rankings -------------------------------------------------------------


def q1_languages(spark, sf_dir):
    return rankings.top_languages(first_seen_repos(spark, sf_dir), "projects")


def q2_projects(spark, sf_dir):
    return rankings.top_projects(first_seen_repos(spark, sf_dir))


def q3_tests(spark, sf_dir):
    return rankings.top_languages(first_seen_repos(spark, sf_dir), "with_tests")


def q4_tests_ci(spark, sf_dir):
    return rankings.top_languages(first_seen_repos(spark, sf_dir), "with_tests_ci")


def rankings_all(spark, sf_dir):
    return rankings.all_rankings(first_seen_repos(spark, sf_dir))


def top_n_param(spark, sf_dir):
    return rankings.all_rankings(first_seen_repos(spark, sf_dir), n=3)


def processed_unique(spark, sf_dir):
    repos = views.raw_repos(spark, sf_dir)
    return repos.groupBy("repo_id").count().agg(F.count("*").alias("processed_unique"))


def state_tables(spark, sf_dir):
    return rankings.counter_state(first_seen_repos(spark, sf_dir))


def seen_ids(spark, sf_dir):
    return rankings.seen_ids(first_seen_repos(spark, sf_dir))


def rankings_read(spark, sf_dir):
    path = fresh_dir(spark, "rankings")
    written = rankings_all(spark, sf_dir)
    written.write.partitionBy("question").parquet(path)
    stored = read_table(spark, path, "rk bigint, name string, count bigint, question string")
    return stored.filter(F.col("question") == "q3_tests")


# --- deduplication --------------------------------------------------------


def first_seen(spark, sf_dir):
    return first_seen_repos(spark, sf_dir).withColumn(
        "emitted_at", C.emit_stamp(F.col("emitted_at"))
    )


def dedupe_key(spark, sf_dir):
    """Error records count as lacking an id, and fall back to their name."""
    k = F.when(F.col("language").isNotNull(), F.col("repo_id"))
    keyed = views.raw_repos(spark, sf_dir).select(C.record_key(k, "full_name").alias("key"))
    return keyed.groupBy("key").agg(F.count("*").alias("n"))


def slice_dedupe(spark, sf_dir):
    return dedupe.first_seen(
        views.crawl_rows(spark, sf_dir),
        ["date_field", "crawl_day", "repo_id"],
        [F.desc("stars"), F.asc("event_id")],
    )


def union_fields_first_seen(spark, sf_dir):
    return dedupe.distinct_records(views.crawl_rows(spark, sf_dir), [], views.crawl_order())


def slice_limit(spark, sf_dir):
    k = dedupe.tightest_limit(None, 7, 12)
    return dedupe.limit_per_group(
        views.crawl_rows(spark, sf_dir),
        ["date_field", "crawl_day"],
        [F.desc("stars"), F.asc("event_id")],
        k,
    )


def global_limit(spark, sf_dir):
    return dedupe.limit_rows(union_fields_first_seen(spark, sf_dir), views.crawl_order(), 25)


def dedupe_accounting(spark, sf_dir):
    return dedupe.dedupe_accounting(
        views.crawl_rows(spark, sf_dir),
        ["date_field", "field_rank", "crawl_day"],
        "repo_id",
        [F.desc("crawl_day"), F.asc("field_rank")],
    ).drop("field_rank")


# --- records and pages ----------------------------------------------------


def scan_records(spark, sf_dir):
    path = fresh_dir(spark, "records")
    records.write_records(views.repo_records(spark, sf_dir), path, stamp=False)
    flat = records.read_records(spark, path).withColumn("topics", F.array_join("topics", "|"))
    return flat.drop("emitted_at")


def emit_ndjson(spark, sf_dir):
    """Deduplicated records as stored, and whether each carries its emit stamp."""
    path = fresh_dir(spark, "emitted")
    raw = views.raw_repos(spark, sf_dir)
    unique = dedupe.first_seen(raw, ["repo_id"], ["seq"]).drop("emitted_at")
    records.write_records(unique, path)
    stored = T.StructType(
        [f for f in unique.schema.fields] + [T.StructField("emitted_at", T.StringType())]
    )
    stamped = F.col("emitted_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$")
    return records.read_records(spark, path, stored).withColumn("emitted_at", stamped)


def tap(spark, sf_dir):
    """How many rows the tap lets through, and of which fields."""
    rows = records.tap(views.repo_records(spark, sf_dir), 20)
    return rows.agg(
        F.count("*").alias("n"), F.count("repo_id").alias("ids"), F.count("stars").alias("stars")
    )


def page_items(spark, sf_dir):
    items = pages.page_items(views.search_pages(spark, sf_dir))
    return items.select(
        "query", "page_no", "id", "full_name", "language", "stargazers_count", "forks_count"
    )


def page_errors(spark, sf_dir):
    return pages.page_errors(views.answered_pages(spark, sf_dir)).drop("payload")


def page_metadata(spark, sf_dir):
    return pages.page_metadata(views.search_pages(spark, sf_dir))


def normalize_items(spark, sf_dir):
    items = pages.page_items(views.search_pages(spark, sf_dir))
    day = F.substring_index("query", ":", -1)
    normal = pages.normalize_items(items, day)
    return normal.withColumn("topics", F.array_join("topics", "|")).drop("emitted_at")


def completeness(spark, sf_dir):
    return pages.completeness(page_metadata(spark, sf_dir))


def crawl_gate(spark, sf_dir):
    return pages.crawl_gate(completeness(spark, sf_dir))


# --- slices ---------------------------------------------------------------


def slice_calendar(spark, sf_dir):
    days = slicing.slice_calendar(views.crawl_requests(spark, sf_dir))
    return days.select(
        "request_id",
        "crawl_day",
        "date_field",
        F.col("day_rank").cast("bigint").alias("day_rank"),
        F.col("field_rank").cast("bigint").alias("field_rank"),
    )


def stored_names(spark, sf_dir):
    """Requested slices under the key they are stored by, and how many requests share each."""
    slices = slicing.slice_calendar(views.crawl_requests(spark, sf_dir))
    return with_query_key(slices).groupBy(*SLICE_KEYS).agg(F.count("*").alias("requests"))


def query_strings(spark, sf_dir):
    queries = slicing.slice_queries(slicing.slice_calendar(views.crawl_requests(spark, sf_dir)))
    return queries.groupBy("query").agg(F.count("*").alias("n"))


def slice_key(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    raw = F.concat(
        F.lit(" "), "p_name", F.lit(" brand:"), "p_brand", F.lit(" size:>="),
        F.col("p_size").cast("string"), F.lit(" "),
    )
    return part.select(
        "p_partkey",
        raw.alias("raw"),
        C.slice_suffix(raw).alias("suffix"),
        C.slice_id(raw).alias("slice_id"),
    )


def slices_cached(spark, sf_dir):
    return slicing.stored_slices(
        views.requested_slices(spark, sf_dir), views.slice_manifest(spark, sf_dir), SLICE_KEYS
    ).select(*SLICE_KEYS)


def slices_missing(spark, sf_dir):
    return slicing.missing_slices(
        views.requested_slices(spark, sf_dir), views.slice_manifest(spark, sf_dir), SLICE_KEYS
    ).select(*SLICE_KEYS)


def slice_provenance(spark, sf_dir):
    return slicing.slice_provenance(
        views.requested_slices(spark, sf_dir), views.slice_manifest(spark, sf_dir), SLICE_KEYS
    )


def slice_write(spark, sf_dir):
    """Store the created slices, then crawl both fields: the stored ones are
    taken as they are and only the missing ones are produced and stored."""
    store = SliceStore(spark, fresh_dir(spark, "slices"), CRAWL_SCHEMA)
    rows = views.crawl_rows(spark, sf_dir).withColumn("query_key", F.lit("all"))
    wanted = materialize(rows.select(*SLICE_KEYS).distinct(), "wanted")
    order = [F.desc("stars"), F.asc("event_id")]
    is_created = F.col("date_field") == "created"
    store.write(rows.filter(is_created), wanted.filter(is_created), order)
    missing = store.misses(wanted)
    store.write(rows.join(missing, SLICE_KEYS, "left_semi"), missing, order)
    return store.read(wanted).select("date_field", "crawl_day", "repo_id", "stars", "event_id")


def slice_union(spark, sf_dir):
    """Stored slices together with the rows of those not stored yet."""
    store = SliceStore(spark, fresh_dir(spark, "slices"), CRAWL_SCHEMA)
    rows = views.crawl_rows(spark, sf_dir).withColumn("query_key", F.lit("all"))
    wanted = materialize(rows.select(*SLICE_KEYS).distinct(), "wanted")
    order = [F.desc("stars"), F.asc("event_id")]
    is_pushed = F.col("date_field") == "pushed"
    store.write(rows.filter(is_pushed), wanted.filter(is_pushed), order)
    served = store.serve(wanted, rows, order)
    return served.select("date_field", "crawl_day", "repo_id", "stars", "event_id")


def crawled(spark, sf_dir, **limits):
    store = SliceStore(spark, fresh_dir(spark, "crawl"), CRAWL_SCHEMA)
    rows = views.crawl_rows(spark, sf_dir).withColumn("query_key", F.lit("all"))
    wanted = materialize(rows.select(*SLICE_KEYS).distinct(), "wanted")
    kept = crawl.crawl_window(
        store, wanted, rows, [F.desc("stars"), F.asc("event_id")], views.crawl_order(), **limits
    )
    return kept.select("date_field", "crawl_day", "repo_id", "stars", "event_id")


def crawl_window(spark, sf_dir):
    """The whole crawl: every slice served and stored, then distinct repositories."""
    return crawled(spark, sf_dir)


def crawl_counters(spark, sf_dir):
    """Counters of a crawl whose created slices are stored already."""
    store = SliceStore(spark, fresh_dir(spark, "counted"), CRAWL_SCHEMA)
    rows = views.crawl_rows(spark, sf_dir).withColumn("query_key", F.lit("all"))
    wanted = materialize(rows.select(*SLICE_KEYS).distinct(), "wanted")
    order = [F.desc("stars"), F.asc("event_id")]
    is_created = F.col("date_field") == "created"
    store.write(rows.filter(is_created), wanted.filter(is_created), order)
    counters = Counters()
    materialize(
        crawl.crawl_window(store, wanted, rows, order, views.crawl_order(), counters=counters), "crawled"
    )
    return spark.createDataFrame(list(counters.totals().items()), "counter string, n bigint")


def ranged_first_seen(spark, sf_dir):
    """The copy of each repository that comes first when busy slices are searched
    range by range: by day, field, start of the leaf range, then place in it."""
    rows = slicing.with_second(
        views.crawl_rows(spark, sf_dir).join(
            views.table(spark, sf_dir, "events").select("event_id", "ts"), "event_id"
        ),
        "ts",
    ).drop("ts")
    return slicing.first_by_range(
        rows, ["date_field", "crawl_day"], [F.desc("crawl_day"), F.asc("field_rank")],
        [F.desc("stars"), F.asc("event_id")], "event_id", RANGE_CAP,
    ).select("date_field", "crawl_day", "repo_id", "stars", "event_id", F.col("s").cast("bigint").alias("range_start"))


def crawl_limited(spark, sf_dir):
    """At most five rows of each slice before, and thirty overall after, deduplication."""
    return crawled(spark, sf_dir, limit_per_slice=5, limit=30)


def day_seconds(spark, sf_dir):
    return slicing.with_second(views.table(spark, sf_dir, "events"), "ts")


def adaptive_ranges(spark, sf_dir):
    leaves = slicing.adaptive_ranges(slicing.second_counts(day_seconds(spark, sf_dir)), RANGE_CAP)
    queried = slicing.range_queries(leaves, "pushed", " stars:>=100")
    return queried.select(
        F.col("day").cast("string").alias("day"), F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"),
        "n", "over_cap", "query",
    )


def range_split_summary(spark, sf_dir):
    leaves = slicing.adaptive_ranges(slicing.second_counts(day_seconds(spark, sf_dir)), RANGE_CAP)
    return slicing.range_summary(leaves).withColumn("day", F.col("day").cast("string"))


def range_assignment(spark, sf_dir):
    rows = day_seconds(spark, sf_dir).select("event_id", "day", "sec")
    seconds = materialize(slicing.second_counts(rows), "seconds")
    assigned = slicing.assign_ranges(rows, seconds, "event_id", RANGE_CAP)
    return assigned.select(
        "event_id",
        F.col("day").cast("string").alias("day"),
        F.col("s").cast("bigint").alias("s"),
        F.col("e").cast("bigint").alias("e"),
    )


def range_predicate(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    found = slicing.rows_in_range(
        events, "ts", "2024-01-10T00:00:00Z", "2024-01-12T11:59:59Z", "value >= 10"
    )
    return found.select("event_id", "user_id", "event_type", "value")


# --- enrichment -----------------------------------------------------------


def commit_count_responses(spark, sf_dir):
    return enrich.commit_stats(views.commit_responses(spark, sf_dir))


def link_next(spark, sf_dir):
    responses = views.commit_responses(spark, sf_dir)
    return responses.select(
        "page_id", C.link_url("link", "next").alias("next_url"), C.last_page("link").alias("last")
    )


def decode_content(spark, sf_dir):
    """Whole texts, wrapped in 60-character lines the way file contents come."""
    documents = views.table(spark, sf_dir, "documents")
    encoded = F.regexp_replace(F.base64(F.col("text").cast("binary")), r"(.{60})", "$1\n")
    return documents.select("doc_id", C.decode_content(encoded).alias("text"))


def keyword_match(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    return documents.select("doc_id", C.mentions_test_tool("text").alias("mentions"))


def path_first_match(spark, sf_dir):
    return enrich.path_evidence(views.repo_contents(spark, sf_dir))


def enrich_join(spark, sf_dir):
    return enrich.enrich(
        views.order_repos(spark, sf_dir),
        views.order_commits(spark, sf_dir),
        enrich.path_evidence(views.repo_contents(spark, sf_dir)),
    )


def enrich_known(spark, sf_dir):
    """Enrichment of the repositories whose lookups all have an outcome."""
    known, _ = enrich.split_unknown(views.order_repos(spark, sf_dir), views.path_statuses(spark, sf_dir))
    return enrich.enrich(
        known.select("repo_id", "full_name", "language", "default_branch"),
        views.order_commits(spark, sf_dir),
        enrich.path_evidence(views.repo_contents(spark, sf_dir)),
    )


def enrich_retry(spark, sf_dir):
    """Repositories to be tried again, as a failed lookup is no answer."""
    _, waiting = enrich.split_unknown(views.order_repos(spark, sf_dir), views.path_statuses(spark, sf_dir))
    return waiting.select("repo_id", "full_name", "default_branch")


def enrich_defaults(spark, sf_dir):
    return enrich.with_defaults(views.order_repos(spark, sf_dir))


def enriched_rankings(spark, sf_dir):
    """Enrichment and rankings in one plan, as a run over stored lookups does."""
    repos = enrich_join(spark, sf_dir).withColumn("seq", F.col("repo_id"))
    return rankings.all_rankings(repos)


# --- messages and hand-off ------------------------------------------------


def keyed_messages(spark, sf_dir):
    return delivery.keyed_messages(views.repo_records(spark, sf_dir).drop("topics"))


def envelope_messages(spark, sf_dir):
    unique = first_seen_repos(spark, sf_dir).drop("emitted_at")
    return delivery.pack_envelopes(unique, "seq", 100)


def envelope_pack(spark, sf_dir):
    """Records per envelope, counted in the packed text."""
    packed = envelope_messages(spark, sf_dir)
    body = F.get_json_object("value", "$.records")
    return packed.select("envelope", F.json_array_length(body).cast("bigint").alias("n"))


def envelope_flatten(spark, sf_dir):
    """Envelopes and lone records from one topic give the same rows."""
    unique = first_seen_repos(spark, sf_dir).drop("emitted_at")
    lone = unique.filter(F.col("language") == "view")
    batched = unique.filter(~F.col("language").eqNullSafe("view"))
    messages = delivery.pack_envelopes(batched, "seq", 100).select("value").unionByName(
        delivery.keyed_messages(lone).select("value")
    )
    rows = delivery.unpack_envelopes(messages, unique.schema)
    return rows.drop("payload")


def published_ids(spark, sf_dir):
    """Ids an earlier run has acknowledged: those of purchases."""
    raw = views.raw_repos(spark, sf_dir)
    return raw.filter(F.col("language") == "purchase").select("repo_id").distinct()


def unpublished(spark, sf_dir):
    path = fresh_dir(spark, "published")
    published.save_published(published_ids(spark, sf_dir), path)
    waiting = published.unpublished(
        first_seen_repos(spark, sf_dir), published.read_published(spark, path)
    )
    return waiting.select("repo_id", "seq", "full_name")


def delivery_accounting(spark, sf_dir):
    """Attempts of records an earlier run has not published; the others are skipped."""
    attempts = views.send_attempts(spark, sf_dir)
    done = views.acknowledged_senders(spark, sf_dir)
    skipped = attempts.join(done, "sender", "left_semi").select("repo_id").distinct()
    return delivery.delivery_totals(attempts.join(done, "sender", "left_anti"), skipped)


def validate_lines(spark, sf_dir):
    return quality.line_diagnostics(views.handoff_lines(spark, sf_dir))


def validate_summary(spark, sf_dir):
    return quality.line_summary(views.handoff_lines(spark, sf_dir))


def language_preview(spark, sf_dir):
    return quality.language_preview(views.handoff_lines(spark, sf_dir))


# --- flow measures and history --------------------------------------------


def throughput(spark, sf_dir):
    return history.throughput(views.raw_repos(spark, sf_dir), "emitted_at")


def flow(spark, sf_dir):
    """Messages with the time they were taken in: some seconds after emission,
    never for errors."""
    waited = F.make_dt_interval(secs=F.col("value"))
    taken = F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp") + waited)
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("emitted_at"),
        taken.alias("received_at"),
    )


def latency(spark, sf_dir):
    return history.latency(flow(spark, sf_dir), "emitted_at", "received_at", ["event_type"])


def backlog(spark, sf_dir):
    """Records whose id has not been seen in the enriched output (ids with tests)."""
    raw = views.raw_repos(spark, sf_dir)
    return history.backlog(raw, raw.filter("has_tests"), "repo_id", "emitted_at")


def backlog_depth(spark, sf_dir):
    return history.backlog_depth(flow(spark, sf_dir), "emitted_at", "received_at")


def daily_ranks(spark, sf_dir):
    day = views.day_text("emitted_at")
    unique = first_seen_repos(spark, sf_dir).withColumn("snapshot", day)
    arrivals = views.raw_repos(spark, sf_dir).select(day.alias("snapshot"))
    return history.history_ranks(unique, arrivals)


def history_snapshots(spark, sf_dir):
    """Append one snapshot per day to the history log and read it whole."""
    path = fresh_dir(spark, "history")
    daily_ranks(spark, sf_dir).write.mode("append").partitionBy("question").parquet(path)
    return read_table(
        spark, path, "snapshot string, rk bigint, name string, count bigint, question string"
    )


def history_ranks(spark, sf_dir):
    return daily_ranks(spark, sf_dir).select("snapshot", "question", "name", "rk")


def rank_stability(spark, sf_dir):
    return history.rank_changes(daily_ranks(spark, sf_dir)).select(
        "snapshot", "question", "name", "rk", "previous_rk", "rank_change"
    )


def convergence(spark, sf_dir):
    return history.convergence(daily_ranks(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        q1_languages, q2_projects, q3_tests, q4_tests_ci, rankings_all, top_n_param,
        processed_unique, state_tables, seen_ids, rankings_read,
        first_seen, dedupe_key, slice_dedupe, union_fields_first_seen, slice_limit,
        global_limit, dedupe_accounting,
        scan_records, emit_ndjson, tap,
        page_items, page_errors, page_metadata, normalize_items, completeness, crawl_gate,
        slice_calendar, stored_names, query_strings, slice_key, slices_cached, slices_missing,
        slice_provenance, slice_write, slice_union, crawl_window, crawl_counters, ranged_first_seen, crawl_limited,
        adaptive_ranges, range_split_summary, range_assignment, range_predicate,
        commit_count_responses, link_next, decode_content, keyword_match,
        path_first_match, enrich_join, enrich_known, enrich_retry, enrich_defaults, enriched_rankings,
        keyed_messages, envelope_pack, envelope_flatten, unpublished, delivery_accounting,
        validate_lines, validate_summary, language_preview,
        throughput, latency, backlog, backlog_depth,
        history_snapshots, history_ranks, rank_stability, convergence,
    )
}
