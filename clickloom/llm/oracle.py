"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# The table of slots is filled turn by turn in a recursion; a document looks its slot up.
SHARDING = """
with recursive shards as (
  select i as turn, 'shard-' || lpad(cast(i as varchar), 2, '0') as shard from range(64) t(i)),
prefs as (
  select turn, shard,
    cast('0x' || substr(md5('offset:' || shard), 1, 8) as bigint) % 2147483648 % 6553 as first,
    cast('0x' || substr(md5('skip:' || shard), 1, 8) as bigint) % 2147483648 % 6552 + 1 as skip
  from shards),
fill as (
  select cast(-1 as bigint) as step, cast(-1 as bigint) as slot, '' as shard,
    list_transform(range(6553), lambda s: false) as taken
  union all
  select n.step, n.slot, n.shard,
    list_concat(list_concat(n.taken[:n.slot], [true]), n.taken[n.slot + 2:]) from (
    select f.step + 1 as step, p.shard, f.taken,
      list_filter(list_transform(range(6553), lambda c: (p.first + c * p.skip) % 6553),
                  lambda s: not f.taken[s + 1])[1] as slot
    from fill f join prefs p on p.turn = (f.step + 1) % 64 where f.step < 6552) n)
select d.doc_id, cast(f.slot as integer) as slot, f.shard
from documents d join fill f on f.step >= 0 and f.slot =
  cast('0x' || substr(md5('key:' || coalesce(cast(d.doc_id as varchar), '')), 1, 8) as bigint)
    % 2147483648 % 6553
"""

# Base counts by unnested words; limits come from sketches, so `kept` has no SQL and op4 no entry.

WARC = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
f as (select html, min(page_id) as first from p where n >= 100 group by html having count(*) > 1)
select p.page_id, cast(p.n as bigint) as payload_bytes, sha256(p.html) as payload_digest,
  case when p.page_id > f.first then 'revisit' else 'response' end as record_type,
  case when p.page_id > f.first then f.first end as refers_to
from p left join f on f.html = p.html
"""

TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
where rank <= 5
"""

HARD_NEGATIVES = """
with v as materialized (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as y,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and vec_id is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as materialized (
  select a.vec_id as anchor_id, c.vec_id, c.y = a.y as same,
    cast(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])), 0) as bigint) as score
  from v a join v c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

# CRC-32 of the decimal id, bit by bit; a node is the joined digests (64 letters each) of the turns that lead to it.
PREFIX_TRIE = """
with turns as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, sha256(
      strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as place,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as sha,
    strlen(coalesce(text, '')) as bytes
  from conversations where conv_id is not null),
convs as (
  select c, c - c % 5 as source, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint))),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i:
      case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) % 9 as h
  from (select distinct c from turns)),
taken as (select v.c, t.place, t.sha, t.bytes from convs v join turns t on t.c = v.source and t.place <= v.h),
shift as (select v.c, v.h, (select count(*) from taken t where t.c = v.c) as m from convs v),
rebuilt as (
  select * from taken union all
  select t.c, s.m + t.place - s.h, t.sha, t.bytes from turns t join shift s on s.c = t.c where t.place > s.h),
prefixes as (
  select c, place as depth, string_agg(sha, '') over (partition by c order by place) as path, bytes from rebuilt
  union all select c, 0, '', 0 from convs),
nodes as (
  select path, any_value(depth) as depth, min(c) as first, count(*) as n_convs, any_value(bytes) as bytes
  from prefixes group by path),
ends as (
  select path, string_agg(cast(c as varchar), ',' order by c) as ids from (
    select c, arg_max(path, depth) as path from prefixes group by c) group by path),
kids as (select left(path, 64 * (depth - 1)) as path, count(*) as n_children from nodes where depth > 0 group by 1),
described as (
  select n.*, coalesce(k.n_children, 0) as n_children, coalesce(e.ids, '') as ids
  from nodes n left join kids k on k.path = n.path left join ends e on e.path = n.path),
above as (
  select left(path, 64 * d) as path, n_children, (n_convs - 1) * bytes as saved from (
    select *, unnest(range(depth + 1)) as d from described)),
subtrees as (
  select path, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved_tokens
  from above group by path)
select n.first as conv_id, cast(n.depth as bigint) as depth, p.first as parent_conv_id, n.n_convs, n.n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, sha256(n.ids) as ends_sha256
from described n join subtrees s on s.path = n.path
left join nodes p on n.depth > 0 and p.path = left(n.path, 64 * (n.depth - 1))
"""

ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_prefix_trie": PREFIX_TRIE,
    "op6_top_k": TOP_K,
    "op10_warc": WARC,
    "op9_sharding": SHARDING,
}
