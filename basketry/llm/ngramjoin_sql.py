"""DuckDB SQL for the n-gram Jaccard join's rows."""

from __future__ import annotations

import string


def jaccard_components_sql() -> str:
    return rf"""
with recursive docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}',
        '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [w]
        else [[w[i], w[i + 1], w[i + 2], w[i + 3]] for i in range(1, len(w) - 2)] end) as s
    from docs),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as inter
    from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * inter >= 85 * (x.n + y.n - inter)),
reach(doc_id, other) as (
    select doc_id, doc_id from docs
    union
    select r.doc_id, l.b from reach r join links l on l.a = r.other)
select d.doc_id, coalesce(any_value(s.n), 0)::bigint as n_shingles, min(r.other) as component_id
from docs d left join sizes s using (doc_id) join reach r using (doc_id) group by d.doc_id"""
