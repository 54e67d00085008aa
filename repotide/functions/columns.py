"""Column expressions: every one stays inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.schemas import TEST_WORDS, UNKNOWN_LANGUAGE

SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def language_label(language: Column | str = "language", unknown: str = UNKNOWN_LANGUAGE) -> Column:
    """Null and empty become ``unknown``; blanks are a real value."""
    return F.coalesce(F.nullif(as_col(language), F.lit("")), F.lit(unknown))


def project_label(full_name: Column | str = "full_name", repo_id: Column | str = "repo_id") -> Column:
    return F.coalesce(F.nullif(as_col(full_name), F.lit("")), as_col(repo_id).cast("string"))


def own_key(columns: list[str]) -> Column:
    """Identity of a record: its id, else its lower-cased name, else all it holds."""
    named = record_key("repo_id", F.nullif("full_name", F.lit("")) if "full_name" in columns else F.lit(None))
    return F.coalesce(named, F.concat(F.lit("\u0000"), F.xxhash64(*columns).cast("string")))


def record_key(repo_id: Column | str = "repo_id", full_name: Column | str = "full_name") -> Column:
    return F.coalesce(as_col(repo_id).cast("string"), F.lower(as_col(full_name)))


def is_true(flag: Column | str) -> Column:
    return F.coalesce(as_col(flag), F.lit(False))


def second_text(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), SECOND_FORMAT)


def emit_stamp(ts: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if ts is None else ts, MICROS_FORMAT)


def link_url(header: Column | str, rel: str) -> Column:
    """URL of the first ``rel`` entry of a ``Link`` header, else null."""
    pattern = f'<([^>]*)>[^,]*rel="{rel}"'
    return F.nullif(F.regexp_extract(as_col(header), pattern, 1), F.lit(""))


def last_page(header: Column | str) -> Column:
    page = F.try_parse_url(link_url(header, "last"), F.lit("QUERY"), F.lit("page"))
    return page.try_cast("bigint")


def commit_count(status: Column | str, link: Column | str, body: Column | str) -> Column:
    """Commits told by one stored response to a one-per-page commit listing.

    409 is an empty repository; any other error means unknown. Otherwise the
    number of the last page counts the commits, or the length of the only page.
    """
    status, body = as_col(status), as_col(body)
    return (
        F.when(status == 409, F.lit(0).cast("bigint"))
        .when(status >= 400, F.lit(None).cast("bigint"))
        .otherwise(F.coalesce(last_page(link), list_length(body)))
    )


def list_length(body: Column) -> Column:
    """Entries of a body that is exactly one JSON list, else null."""
    whole = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
    return F.when(whole, F.json_array_length(body)).cast("bigint")


def decode_content(content: Column | str) -> Column:
    """base64 text to UTF-8 text. Bad bytes are dropped; undecodable gives ''.

    Padding may be missing. A replacement mark that is really in a valid text stays.
    """
    alphabet_only = F.regexp_replace(as_col(content), "[^A-Za-z0-9+/=]", "")
    text = F.try_to_binary(alphabet_only, F.lit("base64")).cast("string")
    mended = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    return F.coalesce(F.when(F.is_valid_utf8(text), text).otherwise(mended), F.lit(""))


def mentions_test_tool(text: Column | str) -> Column:
    """Substring test over the whole text, so ``majestic`` counts as ``jest``."""
    lowered = F.lower(as_col(text))
    hits = [F.contains(lowered, F.lit(word)) for word in TEST_WORDS]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def query_text(field: Column | str, expression: Column | str, suffix: Column | str) -> Column:
    base = F.concat(as_col(field), F.lit(":"), as_col(expression))
    return F.concat_ws(" ", base, F.nullif(F.trim(as_col(suffix)), F.lit("")))


def day_expression(day: Column | str) -> Column:
    """The inclusive whole-second range of one UTC day, as query text."""
    day = as_col(day)
    return F.concat(day, F.lit("T00:00:00Z.."), day, F.lit("T23:59:59Z"))


def slice_suffix(suffix: Column | str) -> Column:
    """File-name form of a query suffix. Lossy: see :func:`slice_id`."""
    cleaned = F.regexp_replace(F.lower(F.trim(as_col(suffix))), r"[^\p{L}\p{N}]", "_")
    cleaned = F.regexp_replace(cleaned, "^_+|_+$", "")
    return F.when(F.coalesce(cleaned, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit("_"), cleaned)
    )


def slice_id(suffix: Column | str) -> Column:
    """Collision-free storage key: the readable form plus a digest of the raw suffix."""
    suffix = F.coalesce(as_col(suffix), F.lit(""))
    return F.concat(slice_suffix(suffix), F.lit("-"), F.sha2(suffix, 256))


def json_objects(line: Column | str) -> Column:
    """Fields of each JSON object on a line; null if the line does not parse.

    A record line holds exactly one. Wrapping in brackets makes the parser see
    the whole line, so trailing garbage is an error and not ignored.
    """
    wrapped = F.concat(F.lit("["), as_col(line), F.lit("]"))
    return F.from_json(wrapped, "array<map<string,string>>", {"allowSingleQuotes": "false"})


def whole_number(text: Column) -> Column:
    """``7``, ``"7"`` and ``7.0`` of a message are the same number; else null."""
    number = text.try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def wire_type(schema: T.StructType) -> T.StructType:
    """``schema`` with whole numbers read as text, so that a number in quotes is kept."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.LongType() else f.dataType)
            for f in schema.fields
        ]
    )


def from_wire(record: str, schema: T.StructType) -> list[Column]:
    """Columns of a ``wire_type`` struct in the types of ``schema``."""
    return [
        (whole_number(value) if f.dataType == T.LongType() else value).alias(f.name)
        for f in schema.fields
        for value in [F.col(f"{record}.{f.name}")]
    ]


def is_falsy_id(repo_id: Column) -> Column:
    return repo_id.isNull() | repo_id.isin("", "0", "false")


def sorted_json(columns: list[str]) -> Column:
    """Record as JSON with sorted keys and explicit nulls."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
