"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations



def _rounds(rounds: int) -> str:
    """CTEs ``a0, c1, a1, ...``: assignments, and centroids moved to their floored means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
  select row_no, arg_min(number, d * 1000 + number) as cluster, min(d) as distance
  from (
    select v.row_no, c.number, cast(list_sum(list_transform(list_zip(v.v, c.v),
      lambda p: cast(p[1] - p[2] as hugeint) * (p[1] - p[2]))) as hugeint) as d
    from v, c{i} c
  ) group by row_no
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} as materialized (
  select c.number, coalesce(m.v, c.v) as v
  from c{i} c left join (
    select cluster, list(mean order by pos) as v from (
      select cluster, pos, cast((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) / count(*) as bigint) as mean
      from (select a.cluster, unnest(v.v) as x, generate_subscripts(v.v, 1) as pos from a{i} a join v using (row_no))
      group by cluster, pos
    ) group by cluster
  ) m on m.cluster = c.number
)""")
    return ",\n".join(steps)


def _edited(value: str, cost: str, edit: str) -> str:
    """Cost (9 digits) and audit of ``value`` after one more edit."""
    return f"lpad(cast(cast(substr({value}, 1, 9) as bigint) + {cost} as varchar), 9, '0') || substr({value}, 10) || '{edit}'"


# Values of the four states (nothing yet, s, u, a) after at most one insertion.
_INSERTED = f"""s as s, n as n,
      least(u, {_edited("n", "5", "I")}, {_edited("s", "5", "I")}, {_edited("a", "5", "I")}) as u,
      least(a, {_edited("u", "5", "I")}) as a"""
_KEPT, _REROLED = _edited("{}", "r.extra", "K"), _edited("{}", "1 + r.extra", "R")

_REPAIR = f"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ord(x) as bigint))),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 20 as kind
  from conversations, crc
), damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case kind when 3 then 2 else 1 end)) as copy
  from keyed where kind <> 0
), placed as materialized (
  select *, row_number() over w as place, lag(role) over w as role_before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as ending
  from damaged window w as (partition by conv_id order by turn nulls first, role, text)
), marked as materialized (
  select *, substr(role, 1, 1) as initial, case when ending = '' then 'b'
    when row_number() over (partition by conv_id, role, text order by place) > 1 then 'd'
    when right(ending, 1) not in ('.', '!', '?') then 't' else '' end as fault
  from placed
), r as materialized (
  select *, fault in ('b', 'd') as bad, case fault when 't' then 5 else 0 end as extra from marked
), dp(conv_id, place, n, s, u, a) as (
  select distinct conv_id, cast(0 as bigint), '000000000', cast(null as varchar), cast(null as varchar), cast(null as varchar) from r
  union all
  select p.conv_id, r.place,
    {_edited("p.n", "2", "D")},
    least({_edited("p.s", "2", "D")}, case when not r.bad and r.initial = 's' then {_KEPT.format("p.n", "p.n")} end),
    least({_edited("p.u", "2", "D")}, case when not r.bad and r.initial = 'u' then
        least({_KEPT.format("p.n", "p.n")}, {_KEPT.format("p.s", "p.s")}, {_KEPT.format("p.a", "p.a")}) end,
      case when not r.bad then least({_REROLED.format("p.n", "p.n")}, {_REROLED.format("p.s", "p.s")}, {_REROLED.format("p.a", "p.a")}) end),
    least({_edited("p.a", "2", "D")}, case when not r.bad and r.initial = 'a' then {_KEPT.format("p.u", "p.u")} end,
      case when not r.bad then {_REROLED.format("p.u", "p.u")} end)
  from (select conv_id, place, {_INSERTED} from (select conv_id, place, {_INSERTED} from dp)) p
  join r on r.conv_id is not distinct from p.conv_id and r.place = p.place + 1
), ended as (
  select conv_id, least(n, a) as best
  from (select conv_id, place, {_INSERTED} from (select conv_id, place, {_INSERTED} from dp)) p
  qualify row_number() over (partition by conv_id order by place desc) = 1
), letters as (
  select conv_id, unnest(string_split(substr(best, 10), '')) as edit, generate_subscripts(string_split(substr(best, 10), ''), 1) as step
  from ended where length(best) > 9
), steps as (
  select *, count(*) filter (edit <> 'I') over w as place, count(*) filter (edit <> 'D') over w as shown
  from letters window w as (partition by conv_id order by step)
), lines as (
  select e.conv_id, e.step, e.edit, e.shown, r.role, case e.edit when 'I' then '' else r.text end as text,
    max(case when e.edit = 'K' and r.initial = 's' then 1 else 0 end) over (partition by e.conv_id) as opens
  from steps e left join r on r.conv_id is not distinct from e.conv_id and r.place = e.place and e.edit <> 'I'
  where e.edit <> 'D'
), repaired as (
  select conv_id, string_agg(case when edit = 'K' then role when (shown - opens) % 2 = 1 then 'user' else 'assistant' end
    || ':' || text, chr(10) order by step) as text
  from lines group by conv_id
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
    count(*) filter (place > 1 and substr(role_before, 1, 1) || initial not in ('su', 'ua', 'au')) as illegal
  from r group by conv_id
)
select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
  coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal,
  coalesce(cast(substr(e.best, 1, 9) as bigint), 0) as cost, coalesce(substr(e.best, 10), '') as audit,
  sha256(coalesce(p.text, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join ended e on e.conv_id is not distinct from o.conv_id
left join repaired p on p.conv_id is not distinct from o.conv_id
"""

# Smallest id reachable over ``links (u, w)`` from each of ``nodes (id)``.
_REACHED = """
reached(id, w) as (
  select id, id from nodes
  union
  select r.id, l.w from reached r join links l on l.u = r.w
), named as (
  select id, min(w) as component_id from reached group by id
)"""

ORACLES: dict[str, str] = {
    "op3_near_duplicates": f"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w
  from documents
), sets as materialized (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as s
  from words
), nodes as (select doc_id as id from sets),
held as materialized (select doc_id, hash(x) as x, len(s) as n from (select doc_id, s, unnest(s) as x from sets)),
links as materialized (
  select a.doc_id as u, b.doc_id as w
  from held a join held b on a.x = b.x and a.doc_id <> b.doc_id
  group by 1, 2, a.n, b.n
  having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), {_REACHED}
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.component_id, c.component_id = s.doc_id as kept
from sets s join named c on c.id = s.doc_id
""",
    "op5_exact_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, d.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v d on q.vec_id <> d.vec_id
  where q.vec_id % 50 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
""",
    "op7_line_dedup": """
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents
), spread as (
  select line from lines where trim(line) <> ''
  group by line having count(distinct source) >= 10
), marked as (
  select doc_id, line, pos,
    line in (select line from spread)
      and row_number() over (partition by line order by doc_id, pos) > 1 as gone
  from lines
), cleaned as (
  select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as text,
    count(*) as n_lines, count(*) filter (gone) as n_removed
  from marked group by doc_id
)
select d.doc_id, c.text, coalesce(c.n_lines, 0) as n_lines, coalesce(c.n_removed, 0) as n_removed
from documents d left join cleaned c using (doc_id)
""",
    "op8_near_vectors": f"""
with recursive v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e
  from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), nodes as (select vec_id as id from embeddings),
links as materialized (
  select a.vec_id as u, b.vec_id as w
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
), {_REACHED}
select d.vec_id, (select count(*) from links l where l.u = d.vec_id) as n_links, c.component_id,
  c.component_id = d.vec_id as kept
from embeddings d join named c on c.id = d.vec_id
""",
    "op12_centroids": f"""
with v as materialized (
  select row_number() over () as row_no, vec_id,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by h, v) - 1 as number, v
  from (select sha256('1:' || cast(vec_id as varchar)) as h, v from v order by h, v limit 16)
), {_rounds(3)}, sums as (
  select cluster, sum(distance) as s from a3 group by cluster
)
select v.vec_id, cast(a3.cluster as integer) as cluster, cast(a3.distance as bigint) as distance,
  cast(sums.s as bigint) as cluster_inertia, cast((select sum(s) from sums) as bigint) as inertia,
  sha256(array_to_string(c3.v, ',')) as centroid_sha256
from v join a3 using (row_no) join sums using (cluster) join c3 on c3.number = a3.cluster
""",
    "op13_conversations": _REPAIR,
}
