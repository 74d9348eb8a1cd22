"""The same results as DuckDB SQL, where SQL can express the operator."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_lattice": """
with recursive v as (
  select vec_id, label, e, sqrt(list_dot_product(e, e)) as norm
  from (select vec_id, label, cast(embedding as double[]) as e from embeddings)
  where label is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and list_dot_product(e, e) > 0),
links as (
  select a.vec_id as a, b.vec_id as b
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(id, least) as (
  select vec_id, vec_id from embeddings
  union select links.a, least from reach join links on links.b = id where least < links.a)
select vec_id, (select count(*) from links where a = vec_id) as n_links,
       min(least) as component_id, vec_id = min(least) as kept
from embeddings join reach on id = vec_id group by vec_id""",
    "op2_substrings": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (
  select doc_id, w, i, array_to_string(w[i:i + 34], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
repeated as (select g from starts group by g having count(*) > 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 35)) as p from starts semi join repeated using (g)),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d)
  anti join gone using (doc_id, p) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)""",
    "op7_decontamination": rf"""
with d as (select doc_id, {_ALNUM_WORDS} as w from documents),
b as (select item_id, {_ALNUM_WORDS} as w from benchmark where item_id is not null),
phrase as (
  select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select item_id, w, least(len(w), 13) as k, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as i
        from b where len(w) > 0)),
starts as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
        from d, (select distinct k from phrase) where len(w) >= k)),
found as (select doc_id, i, k, item_id from starts join phrase using (k, g)),
hit as (select doc_id, count(distinct p) as n
        from (select doc_id, unnest(range(i, i + k)) as p from found) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(s, ',' order by s) as ids
          from (select distinct doc_id, cast(item_id as varchar) as s from found) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(hit.n, 0) as n_hit,
       coalesce(items.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join items using (doc_id)""",
    "op11_conversation_trie": """
with recursive t as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id
           order by turn nulls first, left(coalesce(role, ''), 32), left(coalesce(text, ''), 32), sha256(concat(
             length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) as p
  from conversations where conv_id is not null),
divided(k, v, n) as (
  select k, k, 0 from range(256) r(k)
  union all select k, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, n + 1
  from divided where n < 8),
crc as (select list(v order by k) as x from divided where n = 8),
conv as (
  select c, xor(list_reduce([4294967295::bigint] || list_transform(str_split(cast(c as varchar), ''), lambda d: ascii(d)::bigint),
           lambda v, d: xor(v // 256, x[cast(xor(v, d) % 256 as integer) + 1])), 4294967295) % 9 as h
  from (select distinct c from t), crc),
r as (
  select c, row_number() over (partition by c order by p) as d, role, text
  from (select conv.c, p, role, text from conv join t on t.c = conv.c - conv.c % 5 and p <= h
        union all select t.c, p, role, text from conv join t on t.c = conv.c and p > h)),
coded as (
  select c, d, strlen(text) as bytes, dense_rank() over (order by role, text) as code from r),
path as (
  select c, d, bytes, md5(array_to_string(list(code) over (partition by c order by d), ',')) as k from coded
  union all select c, 0, 0, '' from conv),
step as (select c, d, k, lag(k) over (partition by c order by d) as above from path),
ends as (select k, string_agg(c, ',' order by c) as ids
         from (select c, arg_max(k, d) as k from path group by c) group by k),
node as (
  select path.k, min(path.c) as conv_id, any_value(path.d) as depth, any_value(above) as above,
         count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved
  from path join step on path.c = step.c and path.d = step.d group by path.k),
kids as (select above, count(*) as n from node group by above),
below as (
  select path.k, sum(saved) as saved, sum(case when kids.n is null then 1 else 0 end) as leaves
  from node join path on path.c = node.conv_id and path.d <= node.depth
  left join kids on kids.above = node.k group by path.k)
select node.conv_id, node.depth, up.conv_id as parent_conv_id, node.n_convs,
       coalesce(kids.n, 0) as n_children, cast(below.leaves as bigint) as n_leaves,
       cast(below.saved as bigint) as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from node join below using (k) left join node as up on up.k = node.above
left join kids on kids.above = node.k left join ends on ends.k = node.k""",
}
