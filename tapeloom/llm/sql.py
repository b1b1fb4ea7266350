"""DuckDB SQL for the queries that SQL can express."""

#: The reflected CRC-32 table for half bytes (polynomial 0xEDB88320), made by its rule.
_NIBBLES = []
for _i in range(16):
    _c = _i
    for _ in range(4):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _NIBBLES.append(_c)

#: CRC-32 of a hexadecimal text's bytes.
_CRC32 = f"""xor(list_reduce(
      flatten([[ (position({{hex}}[2*i] in '0123456789ABCDEF') - 1)::bigint, (position({{hex}}[2*i-1] in '0123456789ABCDEF') - 1)::bigint ]
        for i in range(1, cast(length({{hex}}) / 2 as bigint) + 1)]),
      lambda c, x: xor(c >> 4, {_NIBBLES}[xor(c, x) % 16 + 1]), 4294967295::bigint), 4294967295::bigint)"""

OP3 = f"""
with b as (
  select doc_id, cast(strlen(coalesce(text, '')) + 1 as bigint) as size,
    {_CRC32.format(hex="hex")} as text_crc32
  from (select doc_id, text, hex(encode(coalesce(text, ''))) as hex from documents) h),
r as (
  select *, row_number() over w - 1 as rank, sum(size) over (w rows between unbounded preceding and current row) - size as before, sum(size) over () as total
  from b window w as (order by doc_id nulls first, text_crc32, size)),
s as (select *, cast(least(7, ((2 * before + size) * 8) // (2 * total)) as integer) as shard from r)
select doc_id, size, text_crc32, 'bytes' as law, shard, rank - min(rank) over (partition by shard) as slot, cast(null as integer) as grown_shard
from s
"""

_TREE = "list_transform(string_split({t}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: list_transform(regexp_extract_all(p, '[^.]{{1,48}}[.]*|[.]+'), lambda x: md5(x))))"
_ROOT = "sha256(array_to_string(list_transform({t}, lambda s: md5(array_to_string(list_transform(s, lambda p: md5(array_to_string(p, ''))), ''))), ''))"
_PRINT = "{r} || ':' || array_to_string(list_transform({t}, lambda s: array_to_string(list_transform(s, lambda p: array_to_string(list_transform(p, lambda x: x[1:12]), ',')), ';')), '/')"
_LIKE = "case when {ra} = {rb} then 1.0::double when len(list_distinct(list_concat(flatten(flatten({a})), flatten(flatten({b}))))) = 0 then 0.0::double else len(list_intersect(list_distinct(flatten(flatten({a}))), list_distinct(flatten(flatten({b})))))::double / len(list_distinct(list_concat(flatten(flatten({a})), flatten(flatten({b}))))) end"

OP6 = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
n as (select *, coalesce(lead(text) over w, first_value(text) over w) as next_text from d window w as (order by doc_id desc nulls last rows between unbounded preceding and unbounded following)),
e as (select *, length(text) as n_chars, text[1:length(text) - length(text) // 2] || next_text[1:length(text) // 2] as edited from n),
t as (select *, {_TREE.format(t="text")} as ta, {_TREE.format(t="edited")} as tb, {_TREE.format(t="next_text")} as tc from e),
r as (select *, {_ROOT.format(t="ta")} as ra, {_ROOT.format(t="tb")} as rb, {_ROOT.format(t="tc")} as rc from t)
select doc_id, n_chars, sha256(edited) as edited_sha256, {_PRINT.format(r="ra", t="ta")} as fingerprint, {_PRINT.format(r="rb", t="tb")} as edited_fingerprint,
  {_LIKE.format(a="ta", ra="ra", b="tb", rb="rb")} as near_edited, {_LIKE.format(a="ta", ra="ra", b="tc", rb="rc")} as near_next
from r
"""

OP10 = r"""
with recursive d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    ('0x' || substr(md5('42|' || coalesce(cast(doc_id as varchar), '')), 1, 12))::bigint as draw from documents),
s as (select source, cast(sum(size) as bigint) as source_size, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by source),
steps as (
  select source, source_size, w, cast(null as double) as target, 0 as step, true as again from s
  union all
  select source, source_size, w, case when share > 3 * source_size then 3.0 * source_size else target end, step + 1, bool_or(share > 3 * source_size) over () from (
    select *, case when target is null then (sum(source_size) over () - coalesce(sum(target) over (), 0)) * w / sum(case when target is null then w else 0 end) over () end as share
    from steps where again) x),
last as (select source, source_size, w, target from steps where step = (select max(step) from steps)),
t as (select source, source_size, case when target is null then (sum(source_size) over () - coalesce(sum(target) over (), 0)) * w / sum(case when target is null then w else 0 end) over () else target end as target from last),
g as (select *, case when source_size = 0 then 0 else cast(round_even(target, 0) as bigint) // source_size end as whole, case when source_size = 0 then 0 else cast(round_even(target, 0) as bigint) % source_size end as rest from t),
r as (select d.*, source_size, target, whole, rest, sum(d.size) over (partition by d.source order by draw, doc_id, d.size rows between unbounded preceding and current row) - d.size as before
  from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, round(target, 3) as target, cast((whole + case when rest > 0 and 2 * before + size <= 2 * rest then 1 else 0 end) * size as bigint) as taken from r
"""

OP7 = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (select r, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
h as (select s.r, i, md5(array_to_string(w[i:i + 34], ' ')) as k from s join d using (r)),
c as (select r, i from h join (select k from h group by k having count(*) > 1) using (k)),
g as (select distinct r, unnest(range(i, i + 35)) as p from c),
m as (select r, list(p) as ps, count(*) as n from g group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(array_to_string(case when n is null then w else list_select(w, list_filter(range(1, len(w) + 1), lambda p: not list_contains(ps, p))) end, ' ')) as kept_sha256
from d left join m using (r)
"""

#: One step a row for all conversations at once: the least (cost, audit) of each state, inserted turns before an edit.
OP13 = rf"""
with recursive base as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))) as h from conversations),
drawn as (select *, {_CRC32.format(hex="h")} % 20 as k from base),
hurt as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role, case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when k = 3 then [1, 2] else [1] end) as copy from drawn where k <> 0),
r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos, role[1:1] as i, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final from hurt),
f as (select *, case when final = '' then 'b' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'd' when final not in ('.', '!', '?') then 't' else '' end as fault,
    lag(i) over (partition by conv_id order by pos) as before from r),
n as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated, count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal from f group by conv_id),
moves as (select * from (values (0, 0, ''), (0, 2, 'u'), (0, 3, 'ua'), (1, 1, ''), (1, 2, 'u'), (1, 3, 'ua'), (2, 2, ''), (2, 3, 'a'), (2, 2, 'au'), (3, 3, ''), (3, 2, 'u'), (3, 3, 'ua')) m(p, q, put)),
turns as (select p, q, put, 5 * len(put) as cost, repeat('I', len(put)) as audit, list_transform(string_split(put, ''), lambda c: case c when 'u' then 'user:' else 'assistant:' end)[1:len(put)] as lines from moves),
edits as (select * from (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) e(p, i, q)),
steps as (
  select conv_id, 0::bigint as k, 0 as state, 0::bigint as cost, '' as audit, []::varchar[] as lines from n
  union all
  select conv_id, pos, state, cost, audit, lines from (
    select *, row_number() over (partition by conv_id, state order by cost, audit) as rank from (
      select s.conv_id, f.pos, c.q as state, s.cost + t.cost + c.cost as cost, s.audit || t.audit || c.audit as audit, list_concat(list_concat(s.lines, t.lines), c.lines) as lines
      from steps s join f on f.conv_id is not distinct from s.conv_id and f.pos = s.k + 1 join turns t on t.p = s.state
      cross join lateral (
        select t.q as q, 2 as cost, 'D' as audit, []::varchar[] as lines
        union all select e.q, case f.fault when 't' then 5 else 0 end, 'K', [f.role || ':' || f.text] from edits e where e.p = t.q and e.i = f.i and f.fault in ('', 't')
        union all select case t.q when 2 then 3 else 2 end, case f.fault when 't' then 6 else 1 end, 'R', [case t.q when 2 then 'assistant:' else 'user:' end || f.text] where f.fault in ('', 't')) c) x) y
  where rank = 1),
ends as (
  select s.conv_id, s.cost + t.cost as cost, s.audit || t.audit as audit, list_concat(s.lines, t.lines) as lines, n.* exclude (conv_id),
    row_number() over (partition by s.conv_id order by s.cost + t.cost, s.audit || t.audit) as rank
  from steps s join n on n.conv_id is not distinct from s.conv_id and s.k = n.n join turns t on t.p = s.state where t.q in (0, 3))
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(cost, 0) as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join ends e on e.conv_id is not distinct from c.conv_id and e.rank = 1
"""

ORACLES = {"op3_shards": OP3, "op6_merkle": OP6, "op7_phrases": OP7, "op10_mixing": OP10, "op13_repair": OP13}
