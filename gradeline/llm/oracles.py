"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def number(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('/', {', '.join(parts)})), 1, 13))::BIGINT"


OP1 = """
with p as (select page_id, coalesce(html, '') as html from pages),
q as (select *, octet_length(encode(html)) as n, max(page_id) over (partition by html) as top from p)
select page_id, n::BIGINT as payload_bytes, sha1(html) as payload_digest,
  case when n >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> top then top end as refers_to
from q
"""

OP2 = f"""
with sized as (
  select doc_id, source, {WORDS}::BIGINT as size, coalesce('=' || source, 'null') as k,
    {number("'block'", "doc_id::VARCHAR")} % 256 as block, {number("'document'", "doc_id::VARCHAR")} as place
  from documents),
sources as (select source, k, sum(size)::BIGINT as source_size from sized group by all),
ranked as (select *, row_number() over (order by source is null, encode(source)) as rank from sources),
weighed as (select *, ([3.0, 1.0, 2.0]::DOUBLE[])[((rank - 1) % 3 + 1)::INT] as weight, (source_size * 2)::DOUBLE as cap from ranked),
placed as (select *, row_number() over w as position,
    (sum(source_size) over () * 1.5::DOUBLE - coalesce(sum(cap) over b, 0)) / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
  from weighed window w as (order by cap / weight, rank), b as (order by cap / weight, rank rows between unbounded preceding and 1 preceding)),
opened as (select min(position) as p from placed where level * weight <= cap),
aims as (select k, source_size, case when position < coalesce(p, 1 << 30) then cap
    else (select level from placed, opened where position = p) * weight end as target from placed, opened),
goals as (select *, round(target)::BIGINT as goal from aims),
blocks as (select k, block, sum(size)::BIGINT as words from sized group by all),
units as (select *, sum(words) over (partition by k order by turn, {number("'order'", "k", "block::VARCHAR")}, block
    rows between unbounded preceding and current row) - words as start from blocks, (values (0), (1)) t(turn)),
drawn as (select * from units join goals using (k) where start < goal and words > 0),
each as (select s.doc_id, s.k, s.size, s.place, d.words, d.goal - d.start as room,
    sum(s.size) over (partition by s.k, d.turn, d.block order by s.place, s.doc_id, s.size rows between unbounded preceding and current row) - s.size as before
  from sized s join drawn d using (k, block)),
given as (select doc_id, k, size, sum(case when words <= room then size else greatest(0, least(size, room - before)) end) as taken from each group by all)
select s.doc_id, s.size, g.source_size, g.target, coalesce(v.taken, 0)::BIGINT as taken
from sized s join goals g using (k) left join given v on s.doc_id = v.doc_id and s.k = v.k and s.size = v.size
"""

OP3 = f"""
with recursive w as (select doc_id, regexp_extract_all({LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+') as ws from documents),
sh as (select distinct doc_id, s from (select doc_id, unnest(case
    when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from w)),
n as (select doc_id, count(*) as n from sh group by doc_id),
both_ as (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y on x.s = y.s and x.doc_id < y.doc_id group by all),
links as (select a, b from both_ join n na on a = na.doc_id join n nb on b = nb.doc_id where 100 * c >= 85 * (na.n + nb.n - c)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, r) as (select doc_id, doc_id from documents union select reach.doc_id, b from reach join edges on r = a)
select d.doc_id, coalesce(any_value(n.n), 0)::BIGINT as n_shingles, min(r) as component_id, d.doc_id = min(r) as kept
from documents d join reach using (doc_id) left join n using (doc_id) group by d.doc_id
"""

OP6 = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (select doc_id, unnest(range(1, len(ws) - 18)) as i, ws from w),
win as (select doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) as h from starts),
later as (select doc_id, i from (select *, row_number() over (partition by h order by doc_id, i) as r from win) where r > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as j from later),
dropped as (select doc_id, list(j) as js from gone group by doc_id),
kept as (select w.doc_id, len(ws) as n, case when js is null then ws
    else list_filter(ws, lambda x, j: not list_contains(js, j)) end as ks from w left join dropped using (doc_id))
select doc_id, n::BIGINT as n_words, (n - len(ks))::BIGINT as n_removed, sha256(array_to_string(ks, ' ')) as kept_sha256 from kept
"""

OP8 = f"""
with t as (select doc_id, {LOWER.format('text')} as body from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(body) as text_sha256
from t window w as (partition by body)
"""

OP10 = f"""
with u as (
  select page_id, {LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path from pages),
rules(h, p, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits as (select u.*, h || p as rule, verdict from u left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, arg_max(rule, length(rule)) as rule, coalesce(arg_max(verdict, length(rule)), 'allow') as verdict
from fits group by page_id, host, path
"""

OP11 = rf"""
with lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i from documents),
keyed as (select *, {LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} as key from lines),
repeated as (select key, max(doc_id) as keep from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
judged as (select k.*, r.key is not null and doc_id <> keep as gone from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256 from judged group by doc_id
"""

TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(LOWER.format("text"))
OP12 = f"""
with d as (select doc_id, {TERMS} as ts from documents),
docs as (select doc_id, len(ts) as n from d where len(ts) > 0),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from d) group by all),
whole as (select count(*) as n_docs, sum(n)::BIGINT as n_all from docs),
asked as (select item_id, term, count(*) as q from (select item_id, unnest({TERMS}) as term from benchmark) group by all),
weights as (select term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT as w
  from tf, whole group by term, n_docs),
m as (select doc_id, 75 + (25 * n * n_docs) // n_all as m from docs, whole),
scores as (select item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT as score
  from asked join weights using (term) join tf using (term) join m using (doc_id) group by all)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::INT as rank, doc_id, score
from scores where score > 0 qualify rank <= 20
"""

OP13 = f"""
with t as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as body, {WORDS}::BIGINT as n from conversations),
coded as (select conv_id, turn, n, sha256(concat(length(r), ':', r, ':', body)) as id from t),
own as (select conv_id, list({{'id': id, 'n': n}} order by turn nulls first, id) as ts from coded group by conv_id),
h as (select *, conv_id - conv_id % 20 as head,
  (with recursive c(i, crc) as (select 0, 4294967295::UBIGINT union all
     select i + 1, case when i % 9 = 0 then xor(crc, ord(substr(conv_id::VARCHAR, i // 9 + 1, 1))::UBIGINT)
       when crc % 2 = 1 then xor(crc >> 1, 3988292384::UBIGINT) else crc >> 1 end
     from c where i < 9 * length(conv_id::VARCHAR))
   select xor(max_by(crc, i), 4294967295::UBIGINT) % 4 from c)::BIGINT as h from own),
seqs as (select h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) as ts from h left join own b on b.conv_id = h.head),
member as (select conv_id, unnest(range(0, len(ts) + 1)) as depth, ts from seqs),
keyed as (select conv_id, depth, len(ts) as own_depth, md5(array_to_string(list_transform(ts[1:depth], lambda x: x.id), '/')) as k,
  case when depth > 0 then ts[depth].n else 0 end as n from member),
nodes as (select k, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(n) as own,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' order by conv_id) filter (where own_depth = depth), '')) as ends_sha256 from keyed group by all),
above as (select x.k, x.depth, y.k as pk, y.depth as pd from nodes x join keyed y on x.conv_id = y.conv_id and y.depth <= x.depth),
parents as (select a.k, a.depth, p.conv_id as parent_conv_id, a.pk from above a join nodes p on p.k = a.pk and p.depth = a.pd where a.pd = a.depth - 1),
kids as (select pk, depth - 1 as d, count(*) as n_children from parents group by all),
sums as (select a.pk, a.pd, sum(n.own)::BIGINT as saved, count(*) filter (where kids.pk is null) as leaves
  from above a join nodes n using (k, depth) left join kids on kids.pk = n.k and kids.d = n.depth group by all)
select nodes.conv_id, nodes.depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, leaves as n_leaves, saved as saved_tokens, ends_sha256
from nodes join sums on nodes.k = sums.pk and nodes.depth = sums.pd
left join parents on parents.k = nodes.k and parents.depth = nodes.depth left join kids on kids.pk = nodes.k and kids.d = nodes.depth
"""

ORACLES = {
    "op1_warc": OP1, "op2_mixing": OP2, "op3_near_dedup": OP3, "op6_substring_dedup": OP6, "op8_exact_dedup": OP8, "op10_url_filter": OP10,
    "op11_line_dedup": OP11, "op12_ranked_search": OP12, "op13_prefix_trie": OP13,
}
