"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from repotide.plans.batch_queries import RANGE_CAP
from repotide.schemas import CI_PATHS, TEST_CONFIG_FILES, TEST_PATHS

PATH_ROWS = [
    f"('{kind}', {start + i}, '{path}', {i + 1}, {str(path in TEST_CONFIG_FILES).lower()})"
    for kind, start, paths in (("test", 0, TEST_PATHS), ("ci", len(TEST_PATHS), CI_PATHS))
    for i, path in enumerate(paths)
]

VIEWS = {
    "raw_repos": """
select event_id as seq, user_id * 100 + k as repo_id,
  concat('u', cast(user_id as varchar), '/p', cast(k % 20 as varchar)) as full_name,
  case event_type when 'error' then null when 'signup' then '' else event_type end as language,
  cast(case when k % 7 = 0 then null else k * (event_id % 13) end as bigint) as commit_count,
  value > 10 as has_tests, event_id % 2 = 0 as has_ci, ts as emitted_at
from (select *, cast(json_extract_string(props, '$.k') as int) as k from events) t""",
    "uniq": """
select *, coalesce(nullif(language, ''), 'Unknown') as lang,
  coalesce(nullif(full_name, ''), cast(repo_id as varchar)) as project
from (select *, row_number() over (partition by repo_id order by seq) as rn from raw_repos) t
where rn = 1""",
    "crawl_rows": """
select 'created' as date_field, 0 as field_rank, strftime(ts, '%Y-%m-%d') as crawl_day,
  user_id as repo_id, cast(floor(value * 100) as bigint) as stars, event_id
from events where event_type <> 'error'
union all
select 'pushed', 1, strftime(ts, '%Y-%m-%d'), user_id, cast(floor(value * 100) as bigint), event_id
from events where event_type <> 'view'""",
    "search_items": """
select concat('created:', strftime(ts, '%Y-%m-%d')) as query, value < 1 as lone,
  case when value < 1 then event_id + 10000000000 else event_id // 100 end as page_no,
  event_id as id, concat('u', cast(user_id as varchar), '/e', cast(event_id as varchar)) as full_name,
  case event_type when 'error' then null else event_type end as language,
  cast(floor(value) as bigint) as stargazers_count, user_id as forks_count,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as stamp, event_type
from events""",
    "search_facts": """
select query, arg_min(total_count, page_no) as total_count, arg_min(incomplete, page_no) as incomplete_results
from (
  select distinct query, page_no,
    case when lone or page_no % 5 = 0 then -1 else page_no * 40 end as total_count,
    case when lone or page_no % 4 = 0 then false else page_no % 7 = 0 end as incomplete
  from search_items where lone or page_no % 3 <> 0
) p group by query""",
    "repo_records": """
select o_orderkey as repo_id,
  concat('o', cast(o_custkey as varchar), '/r', cast(o_orderkey as varchar)) as full_name,
  nullif(o_orderpriority, '4-NOT SPECIFIED') as language,
  cast(floor(o_totalprice) as bigint) as stars, o_custkey as forks,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as created_at,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as pushed_at,
  o_orderkey * 2 as size_kb,
  case when o_orderstatus = 'P' then 'dev' else 'main' end as default_branch,
  strftime(o_orderdate, '%Y-%m-%d') as crawl_day, o_orderstatus = 'F' as archived,
  concat(o_orderstatus, '|', o_orderpriority) as topics,
  case when o_orderstatus <> 'O' then o_custkey end as open_issues_count
from orders""",
    "commit_responses": """
select page_id, concat('o/', cast(page_id as varchar)) as full_name,
  case when page_id % 11 = 0 then 409 when page_id % 13 = 0 then 404 else 200 end as status,
  case when page_id % 3 <> 0 then 'https://api.example/r?per_page=1&page=2' end as next_url,
  case when page_id % 3 <> 0 and page_id % 5 <> 0 then coalesce(length(html), 0) + 2 end as last,
  case when page_id % 2 = 0 then 1 when page_id % 7 = 0 then 0 end as listed
from pages""",
    "order_repos": """
select o_orderkey as repo_id, concat('o/', cast(o_orderkey as varchar)) as full_name,
  nullif(o_orderpriority, '4-NOT SPECIFIED') as language,
  case when o_orderkey % 10 = 0 then 'dev' else 'main' end as default_branch
from orders""",
    "order_commits": """
select concat('o/', cast(l_orderkey as varchar)) as full_name, count(*) as commit_count
from lineitem group by 1""",
    "path_dim": """
select kind, part, path, priority, needs_words from (values
""" + ",\n".join(PATH_ROWS) + """
) as d(kind, part, path, priority, needs_words)""",
    "evidence": """
select concat('o/', cast(l_orderkey as varchar)) as full_name,
  case when l_suppkey % 5 = 0 then 'dev' else 'main' end as branch,
  arg_min(path, priority) filter (where kind = 'test') as test_evidence,
  arg_min(path, priority) filter (where kind = 'ci') as ci_evidence
from lineitem join path_dim on l_partkey % 17 = part
where not needs_words or l_returnflag in ('R', 'N')
group by 1, 2""",
    "enriched": """
select r.repo_id, r.full_name, r.language, r.default_branch, c.commit_count,
  e.test_evidence is not null as has_tests, e.ci_evidence is not null as has_ci,
  e.test_evidence, e.ci_evidence
from order_repos r left join order_commits c on r.full_name = c.full_name
left join evidence e on r.full_name = e.full_name and r.default_branch = e.branch""",
    "unknown_lookups": """
select distinct concat('o/', cast(l_orderkey as varchar)) as full_name,
  case when l_suppkey % 5 = 0 then 'dev' else 'main' end as branch
from lineitem where l_partkey % 97 = 0 or l_partkey % 89 = 0""",
    "path_lookups": """
select concat('o/', cast(l_orderkey as varchar)) as full_name,
  case when l_suppkey % 5 = 0 then 'dev' else 'main' end as branch, kind, path, priority, needs_words,
  case l_returnflag when 'R' then 'run pytest now' when 'N' then 'Cargo Test suite' else 'nothing here' end as text,
  l_partkey % 97 = 0 as mended, l_partkey % 97 <> 0 and l_partkey % 89 = 0 as lost
from lineitem join path_dim on l_partkey % 17 = part""",
    "unsettled": """
select distinct full_name, branch from path_lookups l
where lost and not exists (
  select 1 from path_lookups m where m.mended and m.full_name = l.full_name and m.branch = l.branch and m.path = l.path)""",
    "settled_evidence": """
select full_name, branch, arg_min(path, priority) filter (where kind = 'test') as test_evidence,
  arg_min(path, priority) filter (where kind = 'ci') as ci_evidence
from (
  select full_name, branch, kind, path, priority, needs_words, text from path_lookups where not mended and not lost
  union all
  select full_name, branch, kind, path, priority, needs_words, arg_max(text, base64(encode(text)))
  from path_lookups where mended group by all
) where not needs_words or text <> 'nothing here'
group by 1, 2""",
    "poison": """
select event_id, case event_id % 4 when 0 then concat('not json ', cast(event_id as varchar))
  when 1 then concat('[1, ', cast(event_id as varchar), ']')
  when 2 then concat('{"repo_id": "x', cast(event_id as varchar), '"}')
  else concat('{"repo_id": ', cast(event_id as varchar), '} tail') end as value
from events where event_type = 'error'""",
    "acknowledged": """
select distinct user_id * 10 + cast(json_extract_string(props, '$.k') as int) % 10 as sender
from events where event_type = 'signup'""",
    "send_attempts": """
select sender, ok, attempt, sender || '/' || count(*) filter (where attempt = 0) over (
    partition by sender order by event_id rows between unbounded preceding and current row) as repo_id
from (
  select *, (row_number() over (partition by sender, successes order by event_id) - 1) % 4 as attempt
  from (
    select user_id * 10 + cast(json_extract_string(props, '$.k') as int) % 10 as sender, event_id,
      event_type = 'purchase' as ok,
      coalesce(sum(case when event_type = 'purchase' then 1 else 0 end) over (
        partition by user_id * 10 + cast(json_extract_string(props, '$.k') as int) % 10 order by event_id
        rows between unbounded preceding and 1 preceding), 0) as successes
    from events) e
) a""",
    "handoff_lines": """
select event_id + 1 as line_no, event_id, event_type,
  case when event_id % 50 = 0 then 'not json'
    when event_id % 51 = 0 then '[1, 2]'
    when event_id % 52 = 0 then '   '
    when event_id % 53 = 0 then concat('{"repo_id": ', cast(event_id as varchar), '} tail')
    when event_id % 54 = 0 then concat('{"repo_id": 0, "full_name": "Owner/', cast(user_id as varchar), '"}')
    else concat('{"repo_id": ', cast(case when event_id % 40 = 1 then user_id else event_id + 1000 end as varchar),
      ', "full_name": "u/', cast(event_id as varchar), '", "language": ',
      case when event_type = 'error' then 'null' else concat('"', event_type, '"') end,
      ', "stars": 1, "forks": 0, "created_at": "2026-05-19T00:00:00Z", "updated_at": "2026-05-19T00:00:00Z", ',
      '"pushed_at": "2026-05-19T00:00:00Z", "size_kb": 1, "default_branch": "main"',
      case when event_id % 30 = 2 then '}' else ', "crawl_day": "2026-05-19"}' end) end as line
from events""",
    "judged": """
select line_no, line, valid,
  case when not valid then ''
    else array_to_string(list_filter(['crawl_day', 'created_at', 'default_branch', 'forks', 'full_name',
      'language', 'pushed_at', 'repo_id', 'size_kb', 'stars', 'updated_at'],
      lambda f: not list_contains(json_keys(line), f)), ', ') end as missing,
  case when not valid then null
    when coalesce(json_extract_string(line, '$.repo_id'), '') in ('', '0', 'false')
      then lower(json_extract_string(line, '$.full_name'))
    else json_extract_string(line, '$.repo_id') end as key,
  case when valid then coalesce(nullif(json_extract_string(line, '$.language'), ''), 'UNKNOWN') end as language
from (
  select line_no, trim(line) as line,
    case when json_valid(trim(line)) then json_type(trim(line)) = 'OBJECT' else false end as valid
  from handoff_lines where trim(line) <> ''
) t""",
    "crawl_requests": """
select o_orderkey as request_id, cast(o_orderdate as date) as end_date, o_orderkey % 4 + 1 as days,
  case o_orderstatus when 'F' then ['created'] when 'O' then ['pushed'] else ['created', 'pushed'] end as fields,
  case o_orderstatus when 'F' then '' when 'O' then '  forks:<7 fork:true '
    else concat('language:', o_orderpriority) end as suffix
from orders""",
    "calendar": """
select request_id, strftime(end_date - cast(day_rank as int), '%Y-%m-%d') as crawl_day,
  fields[field_rank + 1] as date_field, day_rank, field_rank, suffix
from (select *, unnest(range(len(fields))) as field_rank from
  (select *, unnest(range(days)) as day_rank from crawl_requests) d) f""",
    "requested": """
select distinct strftime(ts, '%Y-%m-%d') as crawl_day, concat('user:', cast(user_id as varchar)) as query_key,
  unnest(['created', 'pushed']) as date_field
from events""",
    "manifest": """
select distinct case event_type when 'purchase' then 'created' else 'pushed' end as date_field,
  strftime(ts, '%Y-%m-%d') as crawl_day, concat('user:', cast(user_id as varchar)) as query_key
from events where event_type in ('purchase', 'click')""",
    "seconds": """
select event_id, strftime(ts, '%Y-%m-%d') as day,
  cast(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) as bigint) as sec
from events""",
    "tree": f"""
select day, cast(0 as bigint) as s, cast(86399 as bigint) as e, count(*) as n from seconds group by day
union all
select h.day, h.s, h.e, (select count(*) from seconds x where x.day = h.day and x.sec between h.s and h.e) as n
from (
  select day, s, s + (e - s) // 2 as e from tree where n > {RANGE_CAP} and s < e
  union all
  select day, s + (e - s) // 2 + 1 as s, e from tree where n > {RANGE_CAP} and s < e
) h""",
    "ranged_rows": """
select c.*, concat(c.date_field, ':', c.crawl_day) as slice, x.sec from crawl_rows c join seconds x using (event_id)""",
    "slice_tree": f"""
select slice, cast(0 as bigint) as s, cast(86399 as bigint) as e, count(*) as n from ranged_rows group by slice
union all
select h.slice, h.s, h.e, (select count(*) from ranged_rows x where x.slice = h.slice and x.sec between h.s and h.e) as n
from (
  select slice, s, s + (e - s) // 2 as e from slice_tree where n > {RANGE_CAP} and s < e
  union all
  select slice, s + (e - s) // 2 + 1 as s, e from slice_tree where n > {RANGE_CAP} and s < e
) h""",
    "leaves": f"select * from tree where n <= {RANGE_CAP} or s = e",
    "flow": """
select event_id, event_type, ts as emitted_at,
  case when event_type <> 'error' then ts + to_microseconds(cast(round(value * 1000000) as bigint)) end as received_at
from events""",
    "snap_days": """
select snapshot, row_number() over (order by snapshot) - 1 as idx
from (select distinct strftime(emitted_at, '%Y-%m-%d') as snapshot from raw_repos) d""",
    "snaps": """
select u.*, d.idx from uniq u join snap_days d on strftime(u.emitted_at, '%Y-%m-%d') = d.snapshot""",
    "as_of": """
select d.snapshot, 'q1_languages' as question, s.lang as name, count(*) as count
from snap_days d join snaps s on s.idx <= d.idx group by all
union all
select d.snapshot, 'q3_tests', s.lang, count(*)
from snap_days d join snaps s on s.idx <= d.idx where has_tests group by all
union all
select d.snapshot, 'q4_tests_ci', s.lang, count(*)
from snap_days d join snaps s on s.idx <= d.idx where has_tests and has_ci group by all
union all
select d.snapshot, 'q2_projects', s.project, arg_max(s.commit_count, s.idx * 1000000000000 + s.seq)
from snap_days d join snaps s on s.idx <= d.idx where commit_count is not null group by all""",
    "daily_ranks": """
select snapshot, question, rk, name, count from (
  select *, row_number() over (partition by snapshot, question order by count desc, name) as rk from as_of) t
where rk <= 10""",
    "orders_listed": """
select question, snapshot, string_agg(name, ',' order by rk) as names from daily_ranks group by all""",
    "rank_lists": """
select *, names is distinct from lag(names) over (partition by question order by snapshot) as changed
from orders_listed""",
    "delivered": """
select o_orderkey as seq, o_orderkey as repo_id,
  concat('c', cast(o_custkey as varchar), '/p', cast(o_orderkey % 20 as varchar)) as full_name,
  case o_orderpriority when '5-LOW' then '' when '4-NOT SPECIFIED' then null else o_orderpriority end as language,
  case when o_orderstatus <> 'P' then cast(floor(o_totalprice) as bigint) end as commit_count,
  o_totalprice > 150000 as has_tests, o_orderstatus = 'F' as has_ci
from orders where o_orderkey in (select l_orderkey from lineitem)""",
    "delivered_named": """
select *, coalesce(nullif(language, ''), 'Unknown') as lang, full_name as project from delivered""",
}

# Views each view reads.
USES = {
    "uniq": ["raw_repos"],
    "search_facts": ["search_items"],
    "evidence": ["path_dim"],
    "enriched": ["order_repos", "order_commits", "evidence"],
    "path_lookups": ["path_dim"],
    "unsettled": ["path_lookups"],
    "settled_evidence": ["path_lookups"],
    "judged": ["handoff_lines"],
    "calendar": ["crawl_requests"],
    "tree": ["seconds"],
    "leaves": ["tree"],
    "ranged_rows": ["crawl_rows", "seconds"],
    "slice_tree": ["ranged_rows"],
    "snap_days": ["raw_repos"],
    "snaps": ["uniq", "snap_days"],
    "as_of": ["snaps", "snap_days"],
    "daily_ranks": ["as_of"],
    "orders_listed": ["daily_ranks"],
    "rank_lists": ["orders_listed"],
    "delivered_named": ["delivered"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for used in USES.get(name, []):
            visit(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def sql(body: str, *names: str) -> str:
    """``body`` with the named views, and all they read, in front."""
    needed = _closure(list(names))
    if not needed:
        return body
    recursive = "recursive " if {"tree", "slice_tree"} & set(needed) else ""
    parts = []
    for name in needed:
        columns = {"tree": "(day, s, e, n)", "slice_tree": "(slice, s, e, n)"}.get(name, "")
        parts.append(f"{name}{columns} as ({VIEWS[name]}\n)")
    return f"with {recursive}" + ",\n".join(parts) + "\n" + body


def top(question: str | None, source: str, name: str, where: str, n: int = 10) -> str:
    label = f"'{question}' as question, " if question else ""
    return (
        f"select {label}rk, name, count from (select *, row_number() over (order by count desc, name) as rk"
        f" from (select {name} as name, count(*) as count from {source} where {where} group by 1) c) r"
        f" where rk <= {n}"
    )


def top_commits(question: str | None, source: str, n: int = 10) -> str:
    label = f"'{question}' as question, " if question else ""
    return (
        f"select {label}rk, name, count from (select *, row_number() over (order by count desc, name) as rk"
        f" from (select project as name, arg_max(commit_count, seq) as count from {source}"
        f" where commit_count is not null group by 1) c) r where rk <= {n}"
    )


def four(source: str, n: int = 10) -> str:
    return "\nunion all\n".join(
        [three(source, n), top_commits("q2_projects", source, n)]
    )


def three(source: str, n: int = 10) -> str:
    return "\nunion all\n".join(
        [
            top("q1_languages", source, "lang", "true", n),
            top("q3_tests", source, "lang", "has_tests", n),
            top("q4_tests_ci", source, "lang", "has_tests and has_ci", n),
        ]
    )


RAW_COLUMNS = "seq, repo_id, full_name, language, commit_count, has_tests, has_ci"

CRAWL_FIRST = """
select date_field, field_rank, crawl_day, repo_id, stars, event_id from (
  select *, row_number() over (partition by {keys} order by {order}) as rn from crawl_rows) t
where rn <= {k}"""
CRAWL_ORDER = "crawl_day desc, field_rank, stars desc, event_id"

ORACLES = {
    "q1_languages": sql(top(None, "uniq", "lang", "true"), "uniq"),
    "q2_projects": sql(top_commits(None, "uniq"), "uniq"),
    "q3_tests": sql(top(None, "uniq", "lang", "has_tests"), "uniq"),
    "q4_tests_ci": sql(top(None, "uniq", "lang", "has_tests and has_ci"), "uniq"),
    "rankings_all": sql(four("uniq"), "uniq"),
    "top_n_param": sql(four("uniq", 3), "uniq"),
    "processed_unique": sql(
        "select count(distinct repo_id) as processed_unique from raw_repos", "raw_repos"
    ),
    "state_tables": sql(
        """
select 'seen' as section, cast(repo_id as varchar) as name, cast(1 as bigint) as count from uniq
union all select 'q1_languages', lang, count(*) from uniq group by lang
union all select 'q3_tests', lang, count(*) from uniq where has_tests group by lang
union all select 'q4_tests_ci', lang, count(*) from uniq where has_tests and has_ci group by lang
union all select 'q2_projects', project, arg_max(commit_count, seq) from uniq
  where commit_count is not null group by project""",
        "uniq",
    ),
    "seen_ids": sql("select distinct repo_id from raw_repos", "raw_repos"),
    "rankings_read": sql(
        top(None, "uniq", "lang", "has_tests").replace(
            "select rk, name, count from", "select rk, name, count, 'q3_tests' as question from", 1
        ),
        "uniq",
    ),
    "first_seen": sql(
        f"select {RAW_COLUMNS}, strftime(emitted_at, '%Y-%m-%dT%H:%M:%S.%fZ') as emitted_at from uniq",
        "uniq",
    ),
    "dedupe_key": sql(
        """select case when language is null then lower(full_name) else cast(repo_id as varchar) end as key,
  count(*) as n from raw_repos group by 1""",
        "raw_repos",
    ),
    "slice_dedupe": sql(
        CRAWL_FIRST.format(
            keys="date_field, crawl_day, repo_id", order="stars desc, event_id", k=1
        ),
        "crawl_rows",
    ),
    "union_fields_first_seen": sql(
        CRAWL_FIRST.format(keys="repo_id", order=CRAWL_ORDER, k=1), "crawl_rows"
    ),
    "slice_limit": sql(
        CRAWL_FIRST.format(keys="date_field, crawl_day", order="stars desc, event_id", k=7),
        "crawl_rows",
    ),
    "global_limit": sql(
        f"select * from ({CRAWL_FIRST.format(keys='repo_id', order=CRAWL_ORDER, k=1)}) f"
        f" order by {CRAWL_ORDER} limit 25",
        "crawl_rows",
    ),
    "dedupe_accounting": sql(
        f"""
select date_field, crawl_day, count(*) as fetched,
  cast(sum(case when in_slice > 1 then 1 else 0 end) as bigint) as duplicate_in_slice,
  cast(sum(case when in_slice = 1 and overall > 1 then 1 else 0 end) as bigint) as duplicate_global,
  cast(sum(case when overall = 1 then 1 else 0 end) as bigint) as emitted
from (select *, row_number() over (partition by repo_id order by {CRAWL_ORDER}) as overall,
    row_number() over (partition by date_field, crawl_day, repo_id order by {CRAWL_ORDER}) as in_slice
  from crawl_rows) t group by 1, 2""",
        "crawl_rows",
    ),
    "scan_records": sql("select * from repo_records", "repo_records"),
    "emit_ndjson": sql(f"select {RAW_COLUMNS}, true as emitted_at from uniq", "uniq"),
    "tap": "select least(count(*), 20) as n, least(count(*), 20) as ids, least(count(*), 20) as stars from orders",
    "page_items": sql(
        "select query, page_no, id, full_name, language, stargazers_count, forks_count from search_items",
        "search_items",
    ),
    "page_errors": """
select url as query, page_id as page_no,
  case when page_id % 6 = 5 then 'item without id' else 'unreadable' end as reason
from pages where page_id % 6 <> 4""",
    "page_metadata": sql(
        "select query, nullif(total_count, -1) as total_count, incomplete_results from search_facts",
        "search_facts",
    ),
    "normalize_items": sql(
        """
select id as repo_id, full_name, language, stargazers_count as stars, forks_count as forks,
  stamp as created_at, stamp as updated_at, stamp as pushed_at, forks_count * 3 as size_kb,
  'main' as default_branch, substr(stamp, 1, 10) as crawl_day, event_type = 'view' as archived,
  event_type as topics, case when event_type <> 'click' then forks_count end as open_issues_count
from search_items""",
        "search_items",
    ),
    "completeness": sql(
        "select query, total_count > 1000 as over_cap, incomplete_results as incomplete from search_facts",
        "search_facts",
    ),
    "crawl_gate": sql(
        """
select count(*) filter (where total_count > 1000) as cap_warnings,
  count(*) filter (where incomplete_results) as incomplete_warnings,
  count(*) filter (where total_count > 1000 or incomplete_results) = 0 as complete
from search_facts""",
        "search_facts",
    ),
    "slice_calendar": sql(
        "select request_id, crawl_day, date_field, day_rank, field_rank from calendar", "calendar"
    ),
    "stored_names": sql(
        """
select date_field, crawl_day, concat(case when trim(suffix) = '' then '' else
    concat('_', trim(regexp_replace(lower(trim(suffix)), '[^\\p{L}\\p{N}]', '_', 'g'), '_')) end,
  '-', sha256(suffix)) as query_key, count(*) as requests
from calendar group by 1, 2, 3""",
        "calendar",
    ),
    "query_strings": sql(
        """
select concat(date_field, ':', crawl_day, 'T00:00:00Z..', crawl_day, 'T23:59:59Z',
    case when trim(suffix) = '' then '' else concat(' ', trim(suffix)) end) as query, count(*) as n
from calendar group by 1""",
        "calendar",
    ),
    "slice_key": """
select p_partkey, raw, suffix, concat(suffix, '-', sha256(raw)) as slice_id from (
  select p_partkey, raw,
    concat('_', trim(regexp_replace(lower(trim(raw)), '[^\\p{L}\\p{N}]', '_', 'g'), '_')) as suffix
  from (select p_partkey, concat(' ', p_name, ' brand:', p_brand, ' size:>=', cast(p_size as varchar), ' ') as raw
    from part) a) b""",
    "slices_cached": sql(
        "select date_field, crawl_day, query_key from requested"
        " intersect select date_field, crawl_day, query_key from manifest",
        "requested",
        "manifest",
    ),
    "slices_missing": sql(
        "select date_field, crawl_day, query_key from requested"
        " except select date_field, crawl_day, query_key from manifest",
        "requested",
        "manifest",
    ),
    "slice_provenance": sql(
        """
select r.date_field, count(m.date_field) as slices_from_cache,
  count(*) - count(m.date_field) as slices_from_api
from requested r left join manifest m
  on r.date_field = m.date_field and r.crawl_day = m.crawl_day and r.query_key = m.query_key
group by 1""",
        "requested",
        "manifest",
    ),
    "slice_write": sql(
        "select date_field, crawl_day, repo_id, stars, event_id from ("
        + CRAWL_FIRST.format(
            keys="date_field, crawl_day, repo_id", order="stars desc, event_id", k=1
        )
        + ") f",
        "crawl_rows",
    ),
    "slice_union": sql(
        "select date_field, crawl_day, repo_id, stars, event_id from ("
        + CRAWL_FIRST.format(
            keys="date_field, crawl_day, repo_id", order="stars desc, event_id", k=1
        )
        + ") f",
        "crawl_rows",
    ),
    "crawl_window": sql(
        "select date_field, crawl_day, repo_id, stars, event_id from ("
        + CRAWL_FIRST.format(keys="repo_id", order=CRAWL_ORDER, k=1)
        + ") f",
        "crawl_rows",
    ),
    "crawl_counters": sql(
        """
select unnest(['slices_from_api', 'slices_from_cache', 'fetched', 'loaded_from_cache', 'written_to_cache',
    'duplicate_in_slice', 'duplicate_global', 'emitted']) as counter,
  unnest([api, cache, fetched, loaded, written, fetched - written, loaded + written - emitted, emitted]) as n
from (
  select count(distinct crawl_day) filter (where date_field = 'pushed') as api,
    count(distinct crawl_day) filter (where date_field = 'created') as cache,
    count(*) filter (where date_field = 'pushed') as fetched,
    count(distinct (crawl_day, repo_id)) filter (where date_field = 'created') as loaded,
    count(distinct (crawl_day, repo_id)) filter (where date_field = 'pushed') as written,
    count(distinct repo_id) as emitted
  from crawl_rows) c""",
        "crawl_rows",
    ),
    "ranged_first_seen": sql(
        f"""
select date_field, crawl_day, repo_id, stars, event_id, s as range_start from (
  select r.*, l.s, row_number() over (partition by repo_id order by crawl_day desc, field_rank, l.s, stars desc, event_id) as rn
  from ranged_rows r join slice_tree l
    on l.slice = r.slice and r.sec between l.s and l.e and (l.n <= {RANGE_CAP} or l.s = l.e)) f
where rn = 1""",
        "slice_tree",
    ),
    "crawl_limited": sql(
        f"""
select date_field, crawl_day, repo_id, stars, event_id from (
  select *, row_number() over (partition by repo_id order by {CRAWL_ORDER}) as rn from (
    select *, row_number() over (partition by date_field, crawl_day order by stars desc, event_id) as pos
    from crawl_rows) p where pos <= 5) f
where rn = 1 order by {CRAWL_ORDER} limit 30""",
        "crawl_rows",
    ),
    "adaptive_ranges": sql(
        """
select day, s, e, n, false as over_cap,
  concat('pushed:', strftime(cast(day as timestamp) + to_seconds(s), '%Y-%m-%dT%H:%M:%SZ'), '..',
    strftime(cast(day as timestamp) + to_seconds(e), '%Y-%m-%dT%H:%M:%SZ'), ' stars:>=100') as query
from leaves""".replace("false as over_cap", f"n > {RANGE_CAP} as over_cap"),
        "leaves",
    ),
    "range_split_summary": sql(
        f"""
select day, count(*) as leaves,
  (select count(*) from tree t where t.day = l.day and t.n > {RANGE_CAP} and t.s < t.e) as splits,
  count(*) filter (where n > {RANGE_CAP}) as over_cap, count(*) filter (where n = 0) as empty,
  cast(sum(n) as bigint) as n
from leaves l group by day""",
        "leaves",
    ),
    "range_assignment": sql(
        """
select event_id, x.day, l.s, l.e from seconds x
join leaves l on x.day = l.day and x.sec between l.s and l.e""",
        "leaves",
    ),
    "range_predicate": """
select event_id, user_id, event_type, value from events
where date_trunc('second', ts) between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-12 11:59:59'
  and value >= 10""",
    "commit_count_responses": sql(
        """
select full_name, case when status = 409 then 0 when status >= 400 then null
  else coalesce(last, listed) end as commit_count
from commit_responses""",
        "commit_responses",
    ),
    "link_next": sql("select page_id, next_url, last from commit_responses", "commit_responses"),
    "decode_content": "select doc_id, text from documents",
    "keyword_match": """
select doc_id, regexp_matches(lower(text), 'pytest|unittest|jest|junit|rspec|go test|cargo test') as mentions
from documents""",
    "path_first_match": sql("select * from evidence", "evidence"),
    "enrich_join": sql("select * from enriched", "enriched"),
    "enrich_known": sql(
        "select * from enriched where (full_name, default_branch) not in "
        "(select full_name, branch from unknown_lookups)",
        "enriched", "unknown_lookups",
    ),
    "enrich_retry": sql(
        "select repo_id, full_name, default_branch from order_repos where "
        "(full_name, default_branch) in (select full_name, branch from unknown_lookups)",
        "order_repos", "unknown_lookups",
    ),
    "enrich_defaults": sql(
        """
select *, cast(null as bigint) as commit_count, false as has_tests, false as has_ci
from order_repos""",
        "order_repos",
    ),
    "enriched_rankings": sql(
        four(
            "(select *, repo_id as seq, coalesce(nullif(language, ''), 'Unknown') as lang,"
            " full_name as project from enriched) u"
        ),
        "enriched",
    ),
    "keyed_messages": sql(
        """
select cast(repo_id as varchar) as key, cast(to_json(struct_pack(archived, crawl_day, created_at,
  default_branch, emitted_at := cast(null as varchar), forks, full_name, language, open_issues_count,
  pushed_at, repo_id, size_kb, stars, updated_at)) as varchar) as value
from repo_records""",
        "repo_records",
    ),
    "envelope_pack": sql(
        "select envelope, count(*) as n from (select (row_number() over (order by seq) - 1) // 100 as envelope from uniq) e"
        " group by 1",
        "uniq",
    ),
    "envelope_flatten": sql(
        f"select {RAW_COLUMNS}, cast(null as varchar) as error from uniq", "uniq"
    ),
    "unpublished": sql(
        """
select repo_id, seq, full_name from uniq
where repo_id not in (select repo_id from raw_repos where language = 'purchase')""",
        "uniq",
    ),
    "delivery_accounting": sql(
        """
select count(*) filter (where got and not known) as published,
  cast(sum(case when known then 0 else failed end) as bigint) as publish_failures,
  count(*) filter (where not known and not got and failed = 4) as permanent_failures,
  count(*) filter (where known) as skipped_via_checkpoint
from (select repo_id, bool_or(ok) as got, count(*) filter (where not ok) as failed,
    any_value(sender) in (select sender from acknowledged) as known
  from send_attempts group by 1) r""",
        "send_attempts",
        "acknowledged",
    ),
    "validate_lines": sql(
        """
select line_no, not valid as invalid_json, missing, key,
  valid and row_number() over (partition by valid, key order by line_no) > 1 as is_duplicate
from judged""",
        "judged",
    ),
    "validate_summary": sql(
        """
select *, duplicates + missing_required + invalid_json > 0 as has_errors from (
  select count(*) filter (where valid) as records,
    count(*) filter (where valid) - count(distinct key) filter (where valid) as duplicates,
    count(*) filter (where missing <> '') as missing_required,
    count(*) filter (where not valid) as invalid_json
  from judged) t""",
        "judged",
    ),
    "language_preview": sql(top(None, "judged", "language", "valid"), "judged"),
    "throughput": """
select strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as slot, count(*) as n
from events group by 1""",
    "latency": sql(
        """
select event_type, count(received_at) as n,
  cast(sum(epoch_us(received_at) - epoch_us(emitted_at)) as double)
    / nullif(cast(count(received_at) as double), 0) / 1e6 as avg_seconds
from flow group by 1""",
        "flow",
    ),
    "backlog": sql(
        """
select strftime(date_trunc('minute', emitted_at), '%Y-%m-%d %H:%M:%S') as slot, count(*) as n
from raw_repos where repo_id not in (select repo_id from raw_repos where has_tests) group by 1""",
        "raw_repos",
    ),
    "backlog_depth": sql(
        """
select strftime(minute, '%Y-%m-%d %H:%M:%S') as slot,
  cast(sum(d) over (order by minute) as bigint) as waiting
from (
  select date_trunc('minute', ts) as minute, sum(d) as d from (
    select emitted_at as ts, 1 as d from flow
    union all select received_at, -1 from flow where received_at is not null) x
  group by 1) m""",
        "flow",
    ),
    "history_snapshots": sql(
        "select snapshot, rk, name, count, question from daily_ranks", "daily_ranks"
    ),
    "history_ranks": sql("select snapshot, question, name, rk from daily_ranks", "daily_ranks"),
    "rank_stability": sql(
        """
select snapshot, question, name, rk,
  lag(rk) over (partition by question, name order by snapshot) as previous_rk,
  lag(rk) over (partition by question, name order by snapshot) - rk as rank_change
from daily_ranks""",
        "daily_ranks",
    ),
    "convergence": sql(
        """
select question, max(case when changed then snapshot end) as stable_from,
  count(*) filter (where changed) as changes, count(*) as snapshots
from rank_lists group by 1""",
        "rank_lists",
    ),
    # Streams: the final table equals the batch answer over the same records.
    "stream_raw": sql("select repo_id, full_name, stars, language from repo_records", "repo_records"),
    "stream_first_seen": sql("select * from delivered", "delivered"),
    "stream_enrich": sql("select * from enriched", "enriched"),
    "stream_retry": sql(
        """
select r.repo_id, r.full_name, r.language, r.default_branch, c.commit_count,
  e.test_evidence is not null as has_tests, e.ci_evidence is not null as has_ci,
  e.test_evidence, e.ci_evidence, 'enriched' as state
from order_repos r left join order_commits c on r.full_name = c.full_name
left join settled_evidence e on r.full_name = e.full_name and r.default_branch = e.branch
where not exists (select 1 from unsettled u where u.full_name = r.full_name and u.branch = r.default_branch)
union all
select r.repo_id, r.full_name, r.language, r.default_branch, null, null, null, null, null, 'waiting'
from order_repos r join unsettled u on u.full_name = r.full_name and u.branch = r.default_branch""",
        "order_repos",
        "order_commits",
        "settled_evidence",
        "unsettled",
    ),
    "stream_rankings": sql(three("delivered_named"), "delivered_named"),
    "stream_projects": sql(top_commits("q2_projects", "delivered_named"), "delivered_named"),
    "stream_resume": sql(three("delivered_named"), "delivered_named"),
    "stream_history": sql(
        "select cast(0 as bigint) as batch_id, * from ("
        + four("(select * from delivered_named where language <> '1-URGENT') s")
        + ") a union all select 1, * from (" + four("delivered_named") + ") b",
        "delivered_named",
    ),
    "stream_intake": sql(
        """
select 'raw' as topic, 'fit' as outcome, count(*) as n from orders
union all select 'raw', 'no record', count(*) from poison having count(*) > 0
union all select 'enriched', 'fit', (select count(*) from delivered) + (select count(*) from lineitem where l_orderkey in (select repo_id from delivered))
union all select 'enriched', case event_id % 4 when 2 then 'no repo_id' else 'not an object' end, count(*) from poison group by 2""",
        "poison",
        "delivered",
    ),
    "stream_unfit": sql("select value as payload, 'no record' as error from poison", "poison"),
    "stream_bounded": sql(
        four("(select * from delivered_named order by seq limit (select count(*) // 2 from delivered_named)) s"),
        "delivered_named",
    ),
    "stream_state_export": sql(
        """
select 'seen' as section, cast(repo_id as varchar) as name, cast(1 as bigint) as count from delivered
union all select 'q1_languages', lang, count(*) from delivered_named group by lang
union all select 'q3_tests', lang, count(*) from delivered_named where has_tests group by lang
union all select 'q4_tests_ci', lang, count(*) from delivered_named where has_tests and has_ci group by lang
union all select 'q2_projects', project, arg_max(commit_count, seq) from delivered_named
  where commit_count is not null group by project""",
        "delivered_named",
    ),
    "stream_quarantine": sql(
        """
select case when valid and missing = '' then 'fit' else 'unfit' end as status, h.line,
  case when not valid then 'invalid json' when missing <> '' then concat('missing: ', missing) end as reason,
  count(*) as n
from judged j join handoff_lines h on j.line_no = h.line_no group by all""",
        "judged",
    ),
    "stream_publish_log": """
select o_orderkey as repo_id from orders
where o_orderstatus <> 'F' and o_orderkey in (select l_orderkey from lineitem)""",
    "stream_state": sql(
        """
select lang as name, count(*) as projects, count(*) filter (where has_tests) as with_tests,
  count(*) filter (where has_tests and has_ci) as with_tests_ci
from delivered_named group by 1""",
        "delivered_named",
    ),
}
