"""Date slices, and time ranges halved until each holds a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.functions.columns import day_expression, query_text, second_text
from repotide.operators.dedupe import distinct_records
from repotide.operators.joins import MIN_HOT_ROWS, salted_lookup
from repotide.schemas import SEARCH_CAP
from repotide.session import materialize

BOTH_FIELDS = "created-or-pushed"
LAST_SECOND = 86_399
# Halving a day of 86,400 seconds reaches single seconds after 17 steps.
HALVINGS = 17
CODE_BASE = 100_000


def date_fields(mode: Column) -> Column:
    """``created-or-pushed`` means both fields, in that order."""
    return F.when(
        mode == BOTH_FIELDS, F.array(F.lit("created"), F.lit("pushed"))
    ).otherwise(F.array(mode))


def slice_calendar(requests: DataFrame) -> DataFrame:
    """Slices of crawl requests ``(end_date, days, mode)``: newest day first.

    ``day_rank`` and ``field_rank`` (both from 0) give the order of the slices.
    """
    end = F.col("end_date").cast("date")
    dates = F.sequence(
        end, F.date_sub(end, (F.col("days") - 1).cast("int")), F.expr("interval -1 day")
    )
    other = [c for c in requests.columns if c not in ("end_date", "days", "mode")]
    by_day = requests.filter(F.col("days") >= 1).select(
        *other, "mode", F.posexplode(dates).alias("day_rank", "day")
    )
    return by_day.select(
        *other,
        F.date_format("day", "yyyy-MM-dd").alias("crawl_day"),
        "day_rank",
        F.posexplode(date_fields(F.col("mode"))).alias("field_rank", "date_field"),
    )


def slice_queries(slices: DataFrame, suffix: str = "query_suffix") -> DataFrame:
    """Search text of each slice over its whole day."""
    return slices.withColumn(
        "query", query_text("date_field", day_expression("crawl_day"), suffix)
    )


def stored_slices(requested: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    return requested.join(manifest.select(*keys), keys, "left_semi")


def missing_slices(requested: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    return requested.join(manifest.select(*keys), keys, "left_anti")


def slice_provenance(requested: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Per date field: slices taken from the store, and slices to produce."""
    stored = manifest.select(*keys, F.lit(True).alias("_stored"))
    hit = F.coalesce(F.col("_stored"), F.lit(False))
    return (
        requested.join(stored, keys, "left")
        .groupBy("date_field")
        .agg(
            F.count_if(hit).alias("slices_from_cache"),
            F.count_if(~hit).alias("slices_from_api"),
        )
    )


def with_second(df: DataFrame, ts: str) -> DataFrame:
    """Add ``day`` and ``sec``, the whole second of the UTC day."""
    at = F.col(ts)
    sec = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return df.withColumns({"day": F.to_date(at), "sec": sec.cast("int")})


def second_counts(df: DataFrame) -> DataFrame:
    """Rows per second; combined in each task, so a hot second stays cheap."""
    return df.groupBy("day", "sec").agg(F.count("*").alias("n"))


def halving_paths(spark: SparkSession) -> DataFrame:
    """``(sec, path)``: every range of a day's halving that contains the second.

    Ranges are numbers, see :func:`range_code`. The halving is the same for
    every day, so this table always has 86,400 rows of at most 18 numbers: about
    15 MB, and safe to broadcast.
    """
    last = "element_at(p, -1)"
    s, e = f"({last} div {CODE_BASE})", f"({last} % {CODE_BASE})"
    mid = f"({s} + ({e} - {s}) div 2)"
    half = f"if(sec <= {mid}, {s} * {CODE_BASE} + {mid}, ({mid} + 1) * {CODE_BASE} + {e})"
    path = F.expr(
        f"aggregate(sequence(1, {HALVINGS}), array({LAST_SECOND}L),"
        f" (p, i) -> if({s} < {e}, concat(p, array({half})), p))"
    )
    seconds = spark.range(LAST_SECOND + 1).select(F.col("id").cast("int").alias("sec"))
    return seconds.select("sec", path.alias("path"))


def range_code(s: Column, e: Column) -> Column:
    """A range as one number: start times :data:`CODE_BASE`, plus end."""
    return s.cast("bigint") * CODE_BASE + e


def range_start(code: Column) -> Column:
    return F.floor(code / CODE_BASE).cast("int")


def range_end(code: Column) -> Column:
    return (code % CODE_BASE).cast("int")


def containing_ranges(seconds: DataFrame) -> DataFrame:
    """``seconds`` once per range that contains them, as ``code``."""
    paths = F.broadcast(halving_paths(seconds.sparkSession))
    return seconds.join(paths, "sec").withColumn("code", F.explode("path")).drop("path")


def range_nodes(seconds: DataFrame) -> DataFrame:
    """Rows in every non-empty range of the halving: ``(day, code, n)``.

    A day has at most 86,400 distinct seconds and twice as many ranges, whatever
    the number of rows behind them.
    """
    return containing_ranges(seconds).groupBy("day", "code").agg(F.sum("n").alias("n"))


def _must_split(cap: int) -> Column:
    code = F.col("code")
    return (F.col("n") > cap) & (range_start(code) < range_end(code))


def adaptive_ranges(seconds: DataFrame, cap: int = SEARCH_CAP) -> DataFrame:
    """Leaf ranges ``(day, code, s, e, n, over_cap)`` tiling each day.

    A range is halved while it holds more than ``cap`` rows and is longer than a
    second. A range is cut exactly when it is such a node itself, since all its
    ancestors hold at least as many rows; so the tree needs no recursion. Whole
    days and the halves of cut ranges are reached; the reached ranges that need
    no cut are the leaves. A half without rows meets only its own zero count.
    """
    code = F.col("code")
    s, e = range_start(code), range_end(code)
    mid = F.floor((s + e) / 2).cast("int")
    zero, yes = F.lit(0).cast("bigint"), F.lit(True)
    itself = F.struct("code", "n", (code == LAST_SECOND).alias("wanted"))
    lower = F.struct(range_code(s, mid).alias("code"), zero.alias("n"), yes.alias("wanted"))
    upper = F.struct(range_code(mid + 1, e).alias("code"), zero.alias("n"), yes.alias("wanted"))
    reached = F.when(_must_split(cap), F.array(itself, lower, upper)).otherwise(F.array(itself))
    return (
        range_nodes(seconds)
        .select("day", F.explode(reached).alias("r"))
        .groupBy("day", F.col("r.code").alias("code"))
        .agg(F.max("r.n").alias("n"), F.max("r.wanted").alias("wanted"))
        .filter(F.col("wanted") & ~_must_split(cap))
        .select(
            "day", "code", s.alias("s"), e.alias("e"), "n", (F.col("n") > cap).alias("over_cap")
        )
    )


def range_summary(leaves: DataFrame) -> DataFrame:
    """Per day: leaves, cuts made (one fewer), ranges still over the cap, empty ones."""
    return leaves.groupBy("day").agg(
        F.count("*").alias("leaves"),
        (F.count("*") - 1).alias("splits"),
        F.count_if("over_cap").alias("over_cap"),
        F.count_if(F.col("n") == 0).alias("empty"),
        F.sum("n").alias("n"),
    )


def range_bound(day: str, sec: str) -> Column:
    midnight = F.unix_date(F.col(day)).cast("bigint") * (LAST_SECOND + 1)
    return second_text(F.timestamp_seconds(midnight + F.col(sec)))


def rows_in_range(
    rows: DataFrame, ts: str, start: str, end: str, qualifiers: str | None = None
) -> DataFrame:
    """Rows of the inclusive whole-second range ``start..end``, given as text.

    The end second counts whole. The column is compared as it is, so that the
    bounds, and ``qualifiers`` (any SQL predicate), reach the scan.
    """
    kind = rows.schema[ts].dataType
    after = (F.lit(end).cast("timestamp") + F.expr("interval 1 second")).cast(kind)
    at = F.col(ts)
    found = rows.filter((at >= F.lit(start).cast("timestamp").cast(kind)) & (at < after))
    return found.filter(qualifiers) if qualifiers and qualifiers.strip() else found


def range_queries(leaves: DataFrame, field: str, suffix: str = "") -> DataFrame:
    """Search text of each leaf range."""
    span = F.concat(range_bound("day", "s"), F.lit(".."), range_bound("day", "e"))
    return leaves.withColumn("query", query_text(F.lit(field), span, F.lit(suffix)))


def assign_ranges(
    rows: DataFrame,
    seconds: DataFrame,
    id_column: str,
    cap: int = SEARCH_CAP,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add to each row (with ``day``, ``sec``) the leaf range ``(s, e)`` it falls in.

    ``seconds`` are the :func:`second_counts` of the rows, best materialized since
    the ranges, the lookup, and the list of hot seconds all read them. The range
    is looked up per distinct second by equality along the halving path, never by
    comparing rows with bounds; the rows then join on their second.
    """
    leaves = adaptive_ranges(seconds, cap).select("day", "code", "s", "e")
    of_second = (
        containing_ranges(seconds.select("day", "sec"))
        .join(leaves, ["day", "code"])
        .drop("code")
    )
    return salted_lookup(
        rows, of_second, ["day", "sec"], seconds, id_column, min_hot_rows=min_hot_rows
    )


def first_by_range(
    rows: DataFrame,
    slice_columns: list[str],
    slice_order: list[Column],
    place_order: list[Column],
    id_column: str,
    cap: int = SEARCH_CAP,
) -> DataFrame:
    """The first copy of each record where busy slices arrive range by range.

    ``rows`` have ``day`` and ``sec``; each is given the leaf range ``(s, e)`` of
    its slice. Arrival is ``slice_order``, then the start of the range, then
    ``place_order`` inside it.
    """
    own = rows.withColumn("day", F.concat_ws(":", *slice_columns))
    seconds = materialize(second_counts(own), "seconds")
    ranged = assign_ranges(own, seconds, id_column, cap)
    return distinct_records(ranged, [], [*slice_order, F.asc("s"), *place_order])
