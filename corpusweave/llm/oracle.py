"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WARC = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by 1)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when f.first is null or f.first = p.page_id then 'response' else 'revisit' end as record_type,
  case when f.first <> p.page_id then f.first end as refers_to
from p left join f using (payload_digest)
"""

_MIX = r"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents
), s as (
  select source, sum(size)::double as source_size,
    [3.0, 1.0, 2.0][1 + (row_number() over (order by source is null, source) - 1) % 3]::double as w
  from d group by source
), r as (
  select *, 2 * source_size as cap, row_number() over (order by 2 * source_size / w, w) as k from s
), l as (
  select k, cap / w as turn,
    (1.5 * sum(source_size) over () - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0))
      / sum(w) over (order by k rows between current row and unbounded following) as level
  from r
), t as (
  select source, source_size, least(w * coalesce((select arg_min(level, k) from l where level <= turn), 0), cap) as target
  from r
), o as (
  select d.*, row_number() over (partition by source order by size, doc_id) - 1 as n from d
), e as (
  select o.doc_id, o.size, cast(t.source_size as bigint) as source_size, t.target, o.n,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as each,
    ('0x' || substr(md5('mix:' || coalesce(o.source, '')), 1, 13))::bigint / 4503599627370496.0::double as u
  from o join t on o.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast(size * (floor(u + each * (n + 1)) - floor(u + each * n)) as bigint) as taken
from e
"""

# Every pair: the tables that the SQL runs on are small.
_EMBEDDING_DEDUP = """
with recursive v as (
  select vec_id, embedding::double[] as e,
    coalesce(len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as ok
  from embeddings
), p as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and a.ok and b.ok and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.95
), r(vec_id, c) as (
  select vec_id, vec_id from v union select r.vec_id, p.b from r join p on r.c = p.a
), n as (
  select a as vec_id, count(*) as n_links from p group by 1
)
select r.vec_id, coalesce(any_value(n.n_links), 0) as n_links, min(r.c) as component_id, r.vec_id = min(r.c) as kept
from r left join n using (vec_id) group by r.vec_id
"""

_COLLOCATIONS = r"""
with d as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), p as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from d)
), g as (
  select lang, list_slice(w, k, k + size - 1) as ids, count(*) as f
  from p, unnest([1, 2, 3]) as s(size), unnest(range(1, len(w) - size + 2)) as u(k) group by 1, 2
), n as (
  select lang, sum(f)::bigint as n from g where len(ids) = 1 group by 1
), c as (
  select lang, ids, f as a from g where len(ids) > 1 and f >= 10
), cuts as (
  select c.lang, c.ids, a, k, l.f as l, r.f as r, 1000000 * a::hugeint * a // (l.f::hugeint * r.f) as score
  from c, unnest(range(1, len(c.ids))) as u(k)
  join g l on l.lang = c.lang and l.ids = list_slice(c.ids, 1, k)
  join g r on r.lang = c.lang and r.ids = list_slice(c.ids, k + 1, len(c.ids))
), least as (
  select lang, ids, a, unnest(arg_min({l: l, r: r, score: score}, score * 10 + k)) from cuts group by 1, 2, 3
), inside as (
  select lang, list_slice(ids, k, k + 1) as ids, max(a) as most from c, unnest([1, 2]) as u(k) where len(ids) = 3 group by 1, 2
), ranked as (
  select least.lang, array_to_string(ids, ' ') as phrase, a, l, r, score::bigint as score,
    row_number() over (partition by least.lang order by score desc, a desc, phrase) as rank
  from least left join inside using (lang, ids) where most is null or 100 * most < 50 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked join n using (lang) where rank <= 2000
"""

_TRIE = r"""
with t as (
  select conv_id, coalesce(text, '') as text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest, turn
  from conversations where conv_id is not null
), k as (
  select *, row_number() over (partition by conv_id order by turn nulls first, digest) as k,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from t
), c as (
  select conv_id, conv_id - conv_id % 20 as stem, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
  ), 4294967295) % 4 as h
  from (select distinct conv_id from k)
), s as (
  select c.conv_id, k.k, digest, words from c join k on k.conv_id = c.stem where k.k <= c.h
  union all select c.conv_id, 10 + k.k, digest, words from c join k using (conv_id) where k.k > c.h
), seq as (
  select c.conv_id, coalesce(string_agg(digest, '' order by k), '') as seq, [0::bigint] || coalesce(list(words order by k) filter (k is not null), []) as words
  from c left join s using (conv_id) group by 1
), p as (
  select conv_id, d, substr(seq, 1, 64 * d) as key, seq, words[d + 1] as words, 64 * d = length(seq) as ends
  from seq, unnest(range(length(seq) // 64 + 1)) as u(d)
), n as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words, arg_min(seq, conv_id) as seq,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from p group by 1, 2
), kids as (
  select substr(key, 1, 64 * (d - 1)) as key, count(*) as n_children from n where d > 0 group by 1
), under as (
  select substr(n.key, 1, 64 * u.d) as key, sum((n_convs - 1) * words) as saved_tokens, count(*) filter (kids.key is null) as n_leaves
  from n left join kids using (key), unnest(range(n.d + 1)) as u(d) group by 1
)
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) as n_children, under.n_leaves,
  under.saved_tokens::bigint as saved_tokens, n.ends_sha256
from n join under using (key) left join kids on kids.key = n.key left join n up on n.d > 0 and up.key = substr(n.key, 1, 64 * (n.d - 1))
"""

LLM_ORACLE: dict[str, str] = {"op2_warc": _WARC, "op8_embedding_dedup": _EMBEDDING_DEDUP, "op9_mix": _MIX, "op12_collocations": _COLLOCATIONS, "op13_trie": _TRIE}
