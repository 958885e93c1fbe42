"""SQL for the operators that it can express, over the sample tables. It compares everything with
everything, so it is for small tables; the other operators are tested against brute force."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

SUFFIX = """
with coded as (select doc_id, hex(coalesce(text, '')) as h from documents),
suffix as (
  select doc_id, s, md5(substring(h, 2 * s + 1, 800)) as k
  from (select doc_id, h, unnest(range(0, greatest(len(h) // 2 - 399, 0))) as s from coded)),
repeated as (select doc_id, s from suffix qualify count(*) over (partition by k) > 1),
marked as (
  select doc_id, s, s > lag(s, 1, -400) over (partition by doc_id order by s) + 400 as opens from repeated),
numbered as (select doc_id, s, sum(opens::int) over (partition by doc_id order by s) as span from marked),
spans as (select doc_id, min(s) as a, max(s) + 400 as b from numbered group by doc_id, span),
cuts as (select doc_id, list({'a': a, 'b': b} order by a) as cs from spans group by doc_id),
kept as (
  select doc_id, h, len(h) // 2 as n_bytes, coalesce(list_sum([c.b - c.a for c in cs]), 0) as n_removed,
         coalesce(len(cs), 0) as n_spans, [0] || coalesce([c.b for c in cs], []) as starts,
         coalesce([c.a for c in cs], []) || [len(h) // 2] as ends
  from coded left join cuts using (doc_id)),
left_over as (
  select *, array_to_string([substring(h, 2 * starts[i] + 1, 2 * (ends[i] - starts[i]))
                             for i in range(1, len(ends) + 1)], '') as rest from kept)
select doc_id, n_bytes, cast(n_removed as bigint) as n_removed, n_spans, sha256(unhex(rest)) as kept_sha256 from left_over"""

SUBSTRING = f"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws from documents),
windows as (
  select doc_id, s, array_to_string(ws[s : s + 19], ' ') as k
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) as s from split)),
later as (select doc_id, s from windows qualify row_number() over (partition by k order by doc_id, s) > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from later),
words as (select doc_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as p from split),
kept as (
  select doc_id, string_agg(w, ' ' order by p) as rest, count(*) as n
  from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from split left join kept using (doc_id)"""

_REACH = """
reach as (select id, id as met from nodes union select reach.id, b from reach join links on a = met),
class as (select id, min(met) as component_id from reach group by id)"""

MINHASH = f"""
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') as ws
  from documents),
sets as (
  select doc_id, list_distinct([array_to_string(ws[i : i + 2], ' ')
                                for i in range(1, greatest(len(ws) - 1, least(len(ws) + 1, 2)))]) as shingles
  from split),
members as (select doc_id, len(shingles) as n, unnest(shingles) as k from sets),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as n_both, any_value(x.n) as n_a, any_value(y.n) as n_b
  from members x join members y on x.k = y.k and x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from shared where 100 * n_both >= 85 * (n_a + n_b - n_both)),
nodes as (select doc_id as id from documents),{_REACH}
select doc_id, cast(len(shingles) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join class on id = doc_id"""

EMBEDDING = f"""
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and len(embedding) > 0 and list_count(embedding) = len(embedding)
    and list_bool_and([isfinite(x) for x in embedding]) and list_bool_or([x <> 0 for x in embedding])),
links as (
  select x.vec_id as a, y.vec_id as b from usable x join usable y on x.label = y.label and x.vec_id <> y.vec_id
  where len(x.v) = len(y.v) and list_cosine_similarity(x.v, y.v) >= 0.98),
nodes as (select vec_id as id from embeddings),{_REACH}
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept
from embeddings join class on id = vec_id"""


COLLOCATION = f"""
with lowered as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as piece from lowered),
split as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from pieces),
total as (select lang, sum(len(ws)) as n from split group by lang),
runs as (
  select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase
  from (select lang, ws, k, unnest(range(1, greatest(len(ws) - k + 2, 1))) as i
        from split cross join (values (1), (2), (3)) as sizes(k))),
counted as (select lang, k, phrase, count(*) as a from runs group by all having count(*) >= 10),
cuts as (
  select lang, phrase, k, a, string_split(phrase, ' ') as ws, unnest(range(1, k)) as cut from counted where k > 1),
scored as (
  select c.lang, c.phrase, c.k, c.a, cut, f.a as l, r.a as r,
         (1000000::hugeint * c.a * c.a) // (f.a::hugeint * r.a) as score
  from cuts c join counted f on f.lang = c.lang and f.phrase = array_to_string(ws[1 : cut], ' ')
       join counted r on r.lang = c.lang and r.phrase = array_to_string(ws[cut + 1 :], ' ')),
worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_phrases as (
  select lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') as phrase, a as longer
  from counted cross join (values (1), (2)) as places(i) where k = 3),
covered as (
  select lang, phrase from worst join inner_phrases using (lang, phrase) where 100 * longer >= 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       cast(n as bigint) as n, cast(score as bigint) as score
from worst anti join covered using (lang, phrase) join total using (lang)
qualify rank <= 2000"""


TRIE = f"""
with turns as (
  select conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as k,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as w
  from conversations where conv_id is not null),
own as (select conv_id, list({{'k': k, 'w': w}} order by turn nulls first, k) as ts from turns group by conv_id),
-- the checksum takes in a byte, then eight times a bit (-1)
coded as (
  select conv_id, ts, xor(list_reduce(
    flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint] || [-1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end,
    4294967295::bigint), 4294967295) % 4 as h
  from own),
rebuilt as (
  select c.conv_id, coalesce(b.ts[1 : h], []) || c.ts[h + 1 :] as ts
  from coded c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
beginnings as (select conv_id, ts, unnest(range(0, len(ts) + 1)) as depth from rebuilt),
spelled as (
  select conv_id, depth, array_to_string([t.k for t in ts[1 : depth]], '') as node, len(ts) = depth as whole,
         coalesce(ts[depth].w, 0) as w
  from beginnings),
nodes as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs, max(w) as w,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (whole), '')) as ends_sha256
  from spelled group by node, depth),
linked as (
  select c.*, p.node as above, p.conv_id as parent_conv_id
  from nodes c left join nodes p on p.depth = c.depth - 1 and p.node = left(c.node, 32 * (c.depth - 1)::int)),
counted as (select *, (select count(*) from linked x where x.above = n.node) as n_children from linked n)
select t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children,
       cast(count(*) filter (s.n_children = 0) as bigint) as n_leaves,
       cast(sum((s.n_convs - 1) * s.w) as bigint) as saved_tokens, t.ends_sha256
from counted t join counted s on starts_with(s.node, t.node)
group by t.node, t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children, t.ends_sha256"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_suffix_dedup": SUFFIX,
        "op8_embedding_dedup": EMBEDDING,
        "op9_minhash_dedup": MINHASH,
        "op10_substring_dedup": SUBSTRING,
        "op11_collocations": COLLOCATION,
        "op13_conversation_trie": TRIE,
    }
