"""The same results in SQL for DuckDB, where SQL can express them.

Token counts and BPE need a tokenizer, and the quality score a fitted model: these have no SQL and are tested against the
libraries themselves and by held-out accuracy.
"""

from __future__ import annotations

from .mixing import BLOCK_CHARS, EXPONENT, MOST_BLOCKS

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e as (
  select *, case when regexp_matches(role || ' ' || text, '<\\+\|') then 2
    when regexp_matches(text, '<\|im_(start|end)\|>') or regexp_matches(role, '<\|(im_start|im_end|nl)\|>') then 1 else 0 end as level from t
), f as (
  select *, case level when 0 then 0 when 1 then len(regexp_extract_all(role || ' ' || text, '<\|(im_start|im_end|nl)\|>'))
    else len(regexp_extract_all(role || ' ' || text, '<\\*\|')) end as more from e
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(24 + length(role) + length(text) + more + 5 * (length(role) - length(replace(role, chr(10), ''))))::bigint as formatted_chars
from f group by conv_id
"""

OP5 = f"""
with recursive d as (
  select doc_id, coalesce(source, '') as source, coalesce(length(text), 0) as chars, md5(coalesce(doc_id::varchar, '')) as place from documents
), size as (select greatest({BLOCK_CHARS}, (sum(chars) + {MOST_BLOCKS} - 1) // {MOST_BLOCKS})::bigint as size from d),
p as (
  select *, ((sum(chars) over (partition by source order by place, doc_id nulls first, chars rows unbounded preceding) - chars) // size)::bigint as b from d, size
), z as (select source, greatest((sum(chars) + any_value(size) - 1) // any_value(size), 1)::bigint as n, pow(greatest(sum(chars), 1)::double, {EXPONENT}) as w from d, size group by source),
u as (select *, row_number() over (order by source) as i from z),
g as (select list(w order by i) as ws, list(n order by i) as ns, list_reduce(list(w order by i), lambda a, b: a + b) as whole, sum(n)::bigint as blocks from u),
edf as (
  select 0::bigint as t, ws, ns, blocks, list_transform(ns, lambda x: 0::bigint) as ran, whole as w, 0::bigint as run, 0::bigint as pick from g
  union all
  select t + 1, ws, ns, blocks, list_transform(ran, lambda k, i: k + (i = pick)::bigint), case when ran[pick] + 1 >= ns[pick] then w - ws[pick] else w end,
    case when ran[pick] + 1 >= ns[pick] then run - ran[pick] else run + 1 end, pick
  from (
    select * exclude (pick, next), coalesce(list_min(list_filter(next, lambda x: x.released < (run + 1) / w)), list_min(next)).i as pick from (
      select *, list_filter(list_transform(ran, lambda k, i: case when k < ns[i] then {{'deadline': (k + 1) / ws[i], 'released': k / ws[i], 'i': i}} end), lambda x: x is not null) as next from edf where t < blocks))
), s as (select pick as i, t - 1 as slot, row_number() over (partition by pick order by t) - 1 as k from edf where t > 0),
hz as (select min(last) as horizon from (select max(slot) + 1 as last from s group by i)),
q as (select p.doc_id, p.source, least(p.b, u.n - 1) as block, u.i, g.whole / u.w as pace from p join u using (source) cross join g)
select q.doc_id, q.source, q.block, floor(q.block * q.pace)::bigint as release, ceil((q.block + 1) * q.pace)::bigint as deadline, s.slot, s.slot < hz.horizon as in_mix
from q join s on s.i = q.i and s.k = q.block cross join hz
"""

OP6 = """
with v as (
  select vec_id, min(list_transform(embedding, lambda x: floor(256 * x::double))) as q from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 group by vec_id
), s as (
  select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""

OP7 = f"""
with recursive w as (select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i : i + 3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from w where len(w) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 80 * (x.n + y.n - common)),
r as (select doc_id as id, doc_id as root from w union select r.id, e.b from r join e on e.a = r.root),
c as (select id, min(root) as component_id from r group by id)
select w.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, w.doc_id = c.component_id as kept
from w join c on c.id = w.doc_id left join n on n.doc_id = w.doc_id
"""

OP8 = f"""
with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
k as (select doc_id, i, array_to_string(w[i : i + 19], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from w where len(w) >= 20)),
l as (select doc_id, i, row_number() over (partition by g order by doc_id, i) as n from k),
c as (select distinct doc_id, unnest(range(i, i + 20)) as i from l where n > 1),
o as (select doc_id, list(i) as gone from c group by doc_id),
f as (select w.doc_id, len(w.w) as n_words, coalesce(len(o.gone), 0) as n_removed,
  list_filter(w.w, lambda x, i: o.gone is null or not list_contains(o.gone, i)) as kept from w left join o using (doc_id))
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from f
"""

OP9 = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select t, min(doc_id) as keep_id, count(*) as group_size from t group by t)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.t) as text_sha256 from t join g using (t)
"""

OP10 = f"""
with l as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
u as (select r, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from l),
k as (select *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from u),
c as (select key from k where key <> '' group by key having count(distinct r) >= 10)
select doc_id, count(*) as n_lines, count(c.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (c.key is null), '')) as kept_sha256
from k left join c using (key) group by r, doc_id
"""

_FIELDS = ", ".join(f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
_TEXT = "coalesce(octet_length(encode(text))::varchar || ':' || {}, '-')"

# crc32 bit by bit: the register of the text's bytes, with eight steps for each.
OP11 = f"""
with recursive d as (
  select row_number() over (partition by lang order by doc_id nulls first, sha256(concat({_FIELDS}, {_TEXT.format("text")}))) - 1 as pos, row_number() over () as r, lang, doc_id,
    sha256(concat({_FIELDS}, {_TEXT.format("text")})) as leaf, sha256(concat({_FIELDS}, {_TEXT.format(_LOWER.format("text"))})) as low, doc_id::varchar as t from documents
), crc as (
  select r, t, 0 as i, 4294967295::bigint as c from d where doc_id is not null
  union all
  select r, t, i + 1, list_reduce(list_prepend(xor(c, ascii(substr(t, i + 1, 1))::bigint), range(8)), lambda a, _: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) from crc where i < length(t)
), touched as (select r from crc where i = length(t) and xor(c, 4294967295) % 3 = 0),
tree as (
  select 0 as lv, lang, pos, leaf as h, count(*) over (partition by lang) as n from d
  union all
  select lv + 1, lang, pos // 8, sha256(string_agg(h, '' order by pos)), ((any_value(n) + 7) // 8)::bigint from tree where n > 1 group by lv, lang, pos // 8
), subs as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, lv as height from tree where n = 1),
top as (
  select 0 as lv, pos, subroot as h, count(*) over () as n from subs
  union all
  select lv + 1, pos // 8, sha256(string_agg(h, '' order by pos)), ((any_value(n) + 7) // 8)::bigint from top where n > 1 group by lv, pos // 8
), nodes as (
  select t.lang, lv, pos, h from tree t where n > 1
  union all
  select s.lang, s.height + top.lv, top.pos, top.h from top, subs s where n > 1
), walk as (
  select d.r, d.lang, 0 as lv, d.pos, case when k.r is not null then d.low else d.leaf end as h, '' as proof, s.height, s.pos as spot
  from d left join touched k on k.r = d.r join subs s on s.lang is not distinct from d.lang
  union all
  select w.r, w.lang, w.lv + 1, any_value(case when w.lv + 1 = w.height then w.spot else w.pos // 8 end),
    sha256(string_agg(case when n.pos = w.pos then w.h else n.h end, '' order by n.pos)),
    any_value(w.proof) || coalesce(string_agg(n.h, '' order by n.pos) filter (n.pos <> w.pos), ''), w.height, any_value(w.spot)
  from (select * replace (case when lv = 0 and height = 0 then spot else pos end as pos) from walk) w
  join nodes n on n.lang is not distinct from w.lang and n.lv = w.lv and n.pos // 8 = w.pos // 8 group by w.r, w.lang, w.lv, w.height
), last as (select r, arg_max(h, lv) as folded, arg_max(proof, lv) as proof from walk group by r)
select d.doc_id, d.leaf, s.subroot, top.h as root, sha256(last.proof) as proof_sha256, last.folded as folded_root, last.folded = top.h as verified
from d join last using (r) join subs s on s.lang is not distinct from d.lang cross join top where top.n = 1
"""

OP13 = """
with v as (
  select vec_id, min(struct_pack(w := len(embedding), label := case when vec_id % 7 = 0 then (label + 1) % 10 else label end, q := list_transform(embedding, lambda x: floor(256 * x::double)))) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 group by vec_id
), s as (
  select a.vec_id as anchor_id, b.vec_id, a.v.label = b.v.label as same, list_inner_product(a.v.q, b.v.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and a.v.w = b.v.w where a.vec_id % 100 = 0
), p as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same) where place <= 5
), n as (
  select s.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by s.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
  from p join s using (anchor_id) where not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": OP2, "op5_mixing": OP5, "op6_top_k": OP6, "op7_near_dedup": OP7, "op8_substring_dedup": OP8, "op9_exact_dedup": OP9, "op10_line_dedup": OP10, "op11_merkle": OP11, "op13_hard_negatives": OP13}
