"""The given tables in the shapes the operators take.

Each view exists twice: as a DataFrame here, and as SQL in
:mod:`repotide.plans.oracle`, written independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repotide.functions.columns import second_text
from repotide.schemas import CI_PATHS, SEARCH_ITEM, TEST_PATHS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def portion(rows: DataFrame, key: list[str], number: int, of: int) -> DataFrame:
    """One of ``of`` parts of a table, which together are the whole."""
    return rows.filter(F.pmod(F.xxhash64(*key), F.lit(of)) == number)


def day_text(ts: str):
    return F.date_format(ts, "yyyy-MM-dd")


def raw_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in arrival order, with repeated ids and colliding names."""
    k = F.col("k")
    return with_k(table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") * 100 + k).alias("repo_id"),
        F.concat(
            F.lit("u"), F.col("user_id").cast("string"), F.lit("/p"), (k % 20).cast("string")
        ).alias("full_name"),
        F.when(F.col("event_type") == "error", None)
        .when(F.col("event_type") == "signup", "")
        .otherwise(F.col("event_type"))
        .alias("language"),
        F.when(k % 7 != 0, (k * (F.col("event_id") % 13)).cast("bigint")).alias("commit_count"),
        (F.col("value") > 10).alias("has_tests"),
        (F.col("event_id") % 2 == 0).alias("has_ci"),
        F.col("ts").alias("emitted_at"),
    )


def crawl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits by date field and day; one scan feeds both fields."""
    created = F.when(
        F.col("event_type") != "error",
        F.struct(F.lit("created").alias("date_field"), F.lit(0).alias("field_rank")),
    )
    pushed = F.when(
        F.col("event_type") != "view",
        F.struct(F.lit("pushed").alias("date_field"), F.lit(1).alias("field_rank")),
    )
    return (
        table(spark, sf_dir, "events")
        .select(
            F.explode(F.array_compact(F.array(created, pushed))).alias("f"),
            day_text("ts").alias("crawl_day"),
            F.col("user_id").alias("repo_id"),
            F.floor(F.col("value") * 100).cast("bigint").alias("stars"),
            "event_id",
        )
        .select("f.*", "crawl_day", "repo_id", "stars", "event_id")
    )


# Arrival order of crawl rows: newest day, created before pushed, most stars.
CRAWL_ORDER = [F.desc, F.asc, F.desc, F.asc]
CRAWL_ORDER_COLUMNS = ["crawl_day", "field_rank", "stars", "event_id"]


def crawl_order() -> list:
    return [way(c) for way, c in zip(CRAWL_ORDER, CRAWL_ORDER_COLUMNS)]


def search_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits with the page they are on; low-value ones are pages of their own."""
    lone = F.col("value") < 1
    stamp = second_text("ts")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("created:"), day_text("ts")).alias("query"),
        lone.alias("lone"),
        F.when(lone, F.col("event_id") + 10_000_000_000)
        .otherwise(F.floor(F.col("event_id") / 100).cast("bigint"))
        .alias("page_no"),
        F.struct(
            F.col("event_id").alias("id"),
            F.concat(
                F.lit("u"), F.col("user_id").cast("string"), F.lit("/e"),
                F.col("event_id").cast("string"),
            ).alias("full_name"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("language"),
            F.floor("value").cast("bigint").alias("stargazers_count"),
            F.col("user_id").alias("forks_count"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
            stamp.alias("pushed_at"),
            (F.col("user_id") * 3).alias("size"),
            F.lit("main").alias("default_branch"),
            (F.col("event_type") == "view").alias("archived"),
            F.array("event_type").alias("topics"),
            F.when(F.col("event_type") != "click", F.col("user_id")).alias("open_issues_count"),
        )
        .cast(SEARCH_ITEM)
        .alias("item"),
    )


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits packed into payloads: a lone item, a bare list on every third
    page, else an object whose total is sometimes no number."""
    page_no = F.col("page_no")
    items = F.collect_list("item")
    keep_nulls = {"ignoreNullFields": "false"}
    total = F.when(page_no % 5 == 0, "n/a").otherwise((page_no * 40).cast("string"))
    flag = F.when(page_no % 4 == 0, F.lit(None)).otherwise(page_no % 7 == 0)
    page = F.to_json(
        F.struct(
            total.alias("total_count"), flag.alias("incomplete_results"), F.col("items")
        ),
        keep_nulls,
    )
    return (
        search_items(spark, sf_dir)
        .groupBy("query", "page_no", "lone")
        .agg(items.alias("items"))
        .select(
            "query",
            "page_no",
            F.when(F.col("lone"), F.to_json(F.get("items", F.lit(0)), keep_nulls))
            .when(page_no % 3 == 0, F.to_json("items", keep_nulls))
            .otherwise(page)
            .alias("payload"),
        )
    )


def repo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full 15-field records, one per order, without an emit stamp."""
    stamp = second_text("o_orderdate")
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("repo_id"),
        F.concat(
            F.lit("o"), F.col("o_custkey").cast("string"), F.lit("/r"), key.cast("string")
        ).alias("full_name"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("language"),
        F.floor("o_totalprice").cast("bigint").alias("stars"),
        F.col("o_custkey").alias("forks"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
        stamp.alias("pushed_at"),
        (key * 2).alias("size_kb"),
        F.when(F.col("o_orderstatus") == "P", "dev").otherwise("main").alias("default_branch"),
        day_text("o_orderdate").alias("crawl_day"),
        (F.col("o_orderstatus") == "F").alias("archived"),
        F.array("o_orderstatus", "o_orderpriority").alias("topics"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("open_issues_count"),
        F.lit(None).cast("string").alias("emitted_at"),
    )


def commit_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses to commit listings, one per page; its length is the number of commits."""
    page_id = F.col("page_id")
    next_link = F.lit('<https://api.example/r?per_page=1&page=2>; rel="next"')
    last_link = F.concat(
        next_link,
        F.lit(", <https://api.example/r?per_page=1&page="),
        (F.coalesce(F.char_length("html"), F.lit(0)) + 2).cast("string"),
        F.lit('>; rel="last"'),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("o/"), page_id.cast("string")).alias("full_name"),
        F.when(page_id % 11 == 0, 409).when(page_id % 13 == 0, 404).otherwise(200).alias("status"),
        F.when(page_id % 3 == 0, "")
        .when(page_id % 5 == 0, next_link)
        .otherwise(last_link)
        .alias("link"),
        F.when(page_id % 2 == 0, '[{"sha":"a"}]')
        .when(page_id % 7 == 0, "[]")
        .otherwise('{"message":"x"}')
        .alias("body"),
    )


def order_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("repo_id"),
        F.concat(F.lit("o/"), key.cast("string")).alias("full_name"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("language"),
        F.when(key % 10 == 0, "dev").otherwise("main").alias("default_branch"),
    )


def order_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit counts of the orders that have lines."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("full_name"))
        .agg(F.count("*").alias("commit_count"))
    )


def repo_contents_of(lines: DataFrame) -> DataFrame:
    """Order lines with the path they stand for, and its base64 text."""
    numbered = F.array(*[F.lit(p) for p in TEST_PATHS + CI_PATHS])
    text = (
        F.when(F.col("l_returnflag") == "R", "run pytest now")
        .when(F.col("l_returnflag") == "N", "Cargo Test suite")
        .otherwise("nothing here")
    )
    return lines.select(
        F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("full_name"),
        F.when(F.col("l_suppkey") % 5 == 0, "dev").otherwise("main").alias("branch"),
        F.coalesce(
            F.get(numbered, (F.col("l_partkey") % 17).cast("int")), F.lit("src")
        ).alias("path"),
        F.base64(text.cast("binary")).alias("content"),
        "l_partkey",
    )


def repo_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing paths of each order's branches, with base64 text; directories have none."""
    return repo_contents_of(table(spark, sf_dir, "lineitem")).drop("l_partkey")


def send_attempts(spark: SparkSession, sf_dir: str, max_retries: int = 3) -> DataFrame:
    """Log of send attempts, one for every event. A send ends with its first success
    or its last retry; what follows is a further send of the same user's record."""
    k = F.col("k")
    sent = with_k(table(spark, sf_dir, "events")).select(
        (F.col("user_id") * 10 + k % 10).alias("sender"),
        "event_id",
        (F.col("event_type") == "purchase").alias("ok"),
    )
    arrival = Window.partitionBy("sender").orderBy("event_id")
    before = F.count_if("ok").over(arrival.rowsBetween(Window.unboundedPreceding, -1))
    since = Window.partitionBy("sender", "successes").orderBy("event_id")
    tried = sent.withColumn("successes", F.coalesce(before, F.lit(0))).withColumn(
        "attempt", (F.row_number().over(since) - 1) % (max_retries + 1)
    )
    send = F.count_if(F.col("attempt") == 0).over(arrival)
    return tried.select(
        "sender",
        F.concat_ws("/", "sender", send).alias("repo_id"),
        F.col("attempt").cast("bigint").alias("attempt"),
        "ok",
    )


def acknowledged_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whose records an earlier run has published: those with a signup."""
    return (
        with_k(table(spark, sf_dir, "events"))
        .filter(F.col("event_type") == "signup")
        .select((F.col("user_id") * 10 + F.col("k") % 10).alias("sender"))
        .distinct()
    )


def handoff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to validate: good records, non-objects, broken JSON, blanks, repeats."""
    e = F.col("event_id")
    stamp = '"2026-05-19T00:00:00Z"'
    language = F.when(F.col("event_type") == "error", "null").otherwise(
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    )
    tail = F.when(e % 30 == 2, "}").otherwise(', "crawl_day": "2026-05-19"}')
    full = F.concat(
        F.lit('{"repo_id": '),
        F.when(e % 40 == 1, F.col("user_id")).otherwise(e + 1000).cast("string"),
        F.lit(', "full_name": "u/'),
        e.cast("string"),
        F.lit('", "language": '),
        language,
        F.lit(
            f', "stars": 1, "forks": 0, "created_at": {stamp}, "updated_at": {stamp}, '
            f'"pushed_at": {stamp}, "size_kb": 1, "default_branch": "main"'
        ),
        tail,
    )
    line = (
        F.when(e % 50 == 0, "not json")
        .when(e % 51 == 0, "[1, 2]")
        .when(e % 52 == 0, "   ")
        .when(e % 53 == 0, F.concat(F.lit('{"repo_id": '), e.cast("string"), F.lit("} tail")))
        .when(
            e % 54 == 0,
            F.concat(
                F.lit('{"repo_id": 0, "full_name": "Owner/'),
                F.col("user_id").cast("string"),
                F.lit('"}'),
            ),
        )
        .otherwise(full)
    )
    return table(spark, sf_dir, "events").select((e + 1).alias("line_no"), line.alias("line"))


def poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that hold no record, one for each event that is an error."""
    number = F.col("event_id").cast("string")
    value = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("not json "), number))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("[1, "), number, F.lit("]")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"repo_id": "x'), number, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"repo_id": '), number, F.lit("} tail")))
    )
    return table(spark, sf_dir, "events").filter("event_type = 'error'").select(value.alias("value"))


def path_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path lookups of order lines: the first answer, and the one to a second try.

    Some first tries fail; of those some fail again.
    """
    part = F.col("l_partkey")
    numbered = F.array(*[F.lit(p) for p in TEST_PATHS + CI_PATHS])
    return (
        repo_contents_of(table(spark, sf_dir, "lineitem"))
        .withColumn("path", F.get(numbered, (part % 17).cast("int")))
        .filter("path is not null")
        .select(
            "full_name", "branch", "path", "content",
            F.when(part % 97 == 0, 503).when(part % 89 == 0, 429).otherwise(200).cast("bigint").alias("first_try"),
            F.when(part % 97 == 0, 200).when(part % 89 == 0, 429).otherwise(200).cast("bigint").alias("second_try"),
        )
    )


def path_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path lookup per order line: found, absent, or, now and then, failed."""
    part = F.col("l_partkey")
    status = F.when(part % 97 == 0, 503).when(part % 89 == 0, 429).when(part % 2 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("full_name"),
        F.when(F.col("l_suppkey") % 5 == 0, "dev").otherwise("main").alias("branch"),
        status.alias("status"),
    )


def answered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per web page, most of them no search result."""
    k, one = F.col("page_id") % 6, F.col("page_id").cast("string")
    payload = (
        F.when(k == 0, F.col("html"))
        .when(k == 1, '{"message":"slow down"}')
        .when(k == 2, '{"items":null}')
        .when(k == 3, "[")
        .when(k == 4, F.concat(F.lit('[{"id":"'), one, F.lit('"}]')))
        .otherwise(F.concat(F.lit('{"items":[{"id":'), one, F.lit('},{"full_name":"x"}]}')))
    )
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("query"), F.col("page_id").alias("page_no"), payload.alias("payload")
    )


def crawl_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests to crawl a few days before each order's date."""
    # The three date field modes.
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_orderdate").cast("date").alias("end_date"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("days"),
        F.when(F.col("o_orderstatus") == "F", "created")
        .when(F.col("o_orderstatus") == "O", "pushed")
        .otherwise("created-or-pushed")
        .alias("mode"),
        F.when(F.col("o_orderstatus") == "F", "")
        .when(F.col("o_orderstatus") == "O", "  forks:<7 fork:true ")
        .otherwise(F.concat(F.lit("language:"), F.col("o_orderpriority")))
        .alias("query_suffix"),
    )


def requested_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices wanted: each user's days, for both date fields."""
    return (
        table(spark, sf_dir, "events")
        .select(
            day_text("ts").alias("crawl_day"),
            F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("query_key"),
        )
        .distinct()
        .withColumn("date_field", F.explode(F.array(F.lit("created"), F.lit("pushed"))))
    )


def slice_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices already stored: created on days with a purchase, pushed on days with a click."""
    field = F.when(F.col("event_type") == "purchase", "created").when(
        F.col("event_type") == "click", "pushed"
    )
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("purchase", "click"))
        .select(
            field.alias("date_field"),
            day_text("ts").alias("crawl_day"),
            F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("query_key"),
        )
        .distinct()
    )


def deliveries(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """At-least-once topic: each order's record once per line of the order.

    ``lines`` are all order lines, or a portion of them.
    """
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").alias("repo_id"),
        F.concat(
            F.lit("c"), F.col("o_custkey").cast("string"), F.lit("/p"),
            (F.col("o_orderkey") % 20).cast("string"),
        ).alias("full_name"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")))
        .alias("language"),
        F.when(status != "P", F.floor("o_totalprice").cast("bigint")).alias("commit_count"),
        (F.col("o_totalprice") > 150000).alias("has_tests"),
        (status == "F").alias("has_ci"),
    )
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return lines.select(F.col("l_orderkey").alias("seq")).join(orders, "seq").select(orders.columns)
