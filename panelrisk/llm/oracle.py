"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations

import string

LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"

# CRC-32 with the reflected polynomial, a byte at a time
OP3 = """
with crc_table as (
  select list(list_reduce(list_prepend(n, range(8)), lambda v, k: case when v & 1 = 1 then xor(3988292384, v >> 1)
    else v >> 1 end) order by n) as t from range(256) r(n)),
sized as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 16 as size,
    hex(encode(coalesce(text, ''))) as h from documents),
summed as (
  select doc_id, size, xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(h) + 1, 2), lambda i: ('0x' || h[i:i + 1])::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))::bigint as text_crc32
  from sized, crc_table),
placed as (
  select *, sum(size) over w as e, sum(size) over () as total,
    row_number() over w as r from summed
  window w as (order by doc_id, text_crc32, size rows unbounded preceding)),
cut as (select *, least(39, ((2 * e - size) * 40) // (2 * total))::int as shard from placed)
select doc_id, size, text_crc32, 'bytes' as law, shard,
  (r - min(r) over (partition by shard))::bigint as slot, null::int as grown_shard from cut"""

OP6 = f"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents),
grams as (
  select distinct doc_id, list_slice(w, i, i + least(5, len(w)) - 1) as g
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by 1),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 80 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select doc_id, doc_id as other from words
  union
  select r.doc_id, b.y from reach r join both_ways b on b.x = r.other),
least as (select doc_id, min(other) as component_id from reach group by 1)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from words left join sizes using (doc_id) join least using (doc_id)"""

OP9 = f"""
with item_words as (
  select item_id, regexp_extract_all({LOWERED}, '{ALNUM}') as w from benchmark),
patterns as (
  select item_id, least(10, len(w)) as l, list_slice(w, i, i + least(10, len(w)) - 1) as p
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from item_words where len(w) > 0)),
doc_words as (select doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') as w from documents),
windows as (
  select doc_id, i, l, list_slice(w, i, i + l - 1) as p from (
    select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i
    from doc_words, (select distinct l from patterns) where len(w) >= l)),
found as (select distinct doc_id, i, w.l as l, item_id from windows w join patterns q on w.p = q.p),
hit as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(i, i + l)) as pos from found) group by 1),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item_id::varchar as item from found) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (doc_id) left join items using (doc_id)"""

OP12 = f"""
with recursive crc_table as (
  select list(list_reduce(list_prepend(n, range(8)), lambda v, k: case when v & 1 = 1 then xor(3988292384, v >> 1)
    else v >> 1 end) order by n) as t from range(256) r(n)),
runs as (
  select doc_id, run, count(*) as c from (
    select doc_id, unnest(regexp_extract_all({LOWERED}, '[A-Za-zÀ-ÿ]+')) as run from documents) group by 1, 2),
hashed as (
  select run, c, xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(x) + 1, 2), lambda i: ('0x' || x[i:i + 1])::bigint)),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])))::bigint as h
  from (select run, c, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from runs), crc_table),
words as (
  select word, sum(c)::bigint as n from (
    select c, case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
      else run end as word from hashed)
  where length(word) >= 6 group by 1 having sum(c) >= 5),
cut as (
  select word, n, i, left(word, (i - 1)::int) || substr(word, (i + 1)::int) as d
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, a.n, b.word as other, b.n as m from cut a join cut b on a.i = b.i and a.d = b.d and a.word <> b.word
  union select a.word, a.n, b.word, b.n from cut a join words b on a.d = b.word
  union select b.word, b.n, a.word, a.n from cut a join words b on a.d = b.word),
best as (
  select word, n, count(*) as n_near, max(m) as form_n from near group by 1, 2),
forms as (
  select b.word, n_near, case when form_n >= 5 * b.n then min(other) end as form,
    case when form_n >= 5 * b.n then form_n end as form_n
  from best b join near on near.word = b.word and m = form_n group by b.word, b.n, n_near, form_n),
chain as (
  select word, form as root, 1 as k from forms where form is not null
  union all
  select c.word, f.form, k + 1 from chain c join forms f on f.word = c.root where f.form is not null),
roots as (select word, arg_max(root, k) as root from chain group by 1)
select w.word, form, coalesce(root, w.word) as root, n, coalesce(n_near, 0)::bigint as n_near, form_n
from words w left join forms using (word) left join roots using (word)"""

# rules and bounds stated as in the task, not taken from the operator
OP13 = f"""
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
rules(verdict, rh, rp) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting as (
  select host, path, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(verdict, length(rh || rp)) as ruled
  from (select distinct host, path from parts) join rules
    on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by 1, 2),
judged as (select page_id, host, path, rule, ruled from parts left join fitting using (host, path)),
bare as (
  select host, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.+$', '') as b,
    count(ruled) as n, count(*) filter (ruled = 'block') as bad from judged group by 1),
labels as (select *, string_split(b, '.') as l,
  regexp_matches(b, '^[0-9.]+$') or starts_with(b, '[') or strpos(b, '.') = 0 as whole from bare),
tails as (select *, array_to_string(l[-2:], '.') as two from labels),
hosts as (
  select host, n, bad, case when whole then b when tl then two else l[-1] end as suffix,
    case when whole then b when tl then array_to_string(l[-3:], '.') else two end as domain
  from (select *, two in ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'com.br', 'co.jp', 'co.kr', 'co.in', 'com.cn', 'com.mx') as tl
    from tails)),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by 1, 2),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by 1),
total as (select coalesce(sum(n), 0) as n, coalesce(sum(bad), 0) as bad from suffixes),
nested as (
  select 1 as level, s.n::double as n, s.bad::double as bad, t.n::double as pn, t.bad::double as pbad from suffixes s, total t
  union all select 2, d.n, d.bad, s.n, s.bad from domains d join suffixes s using (suffix)
  union all select 3, h.n, h.bad, p.n, p.bad from hosts h
    join (select domain, sum(n) as n, sum(bad) as bad from domains group by 1) p using (domain)),
sums as (
  select level, sum(n * (bad / n - pbad / pn) * (bad / n - pbad / pn)) as b, sum(bad * (1 - bad / n)) as w,
    sum(n) as pages, count(*) as kids, sum(n / pn) as parents, sum(n * n / pn) as squares
  from nested where n > 0 group by 1),
shares as (
  select level, kids - parents as freedom, b / nullif(kids - parents, 0) as between_,
    coalesce(w / nullif(pages - kids, 0), 0) as within_, (pages - squares) / nullif(kids - parents, 0) as size from sums),
weights as (
  select level, case when freedom < 0.5 then 1.0 when share <= 0 then 1000.0
    else coalesce(least(greatest(1 / share - 1, 1.0), 1000.0), 1.0) end::double as weight
  from (select *, (between_ - within_) / nullif(between_ + (size - 1) * within_, 0) as share from shares)),
w as (select coalesce(max(weight) filter (level = 1), 1.0) as w1, coalesce(max(weight) filter (level = 2), 1.0) as w2,
  coalesce(max(weight) filter (level = 3), 1.0) as w3 from weights),
suffix_rate as (
  select suffix, (s.bad + w1 * (t.bad + 1.0) / (t.n + 2.0)) / (s.n + w1) as rate from suffixes s, total t, w),
domain_rate as (
  select domain, suffix, (d.bad + w2 * rate) / (d.n + w2) as rate from domains d join suffix_rate using (suffix), w),
beta as (
  select host, h.bad + w3 * rate as a, h.n - h.bad + w3 * (1 - rate) as b
  from hosts h join domain_rate using (domain, suffix), w),
bounds as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from beta)
select page_id, host, path, rule, coalesce(ruled, case when bound > 0.5 then 'block' else 'allow' end) as verdict
from judged join bounds using (host)"""

ORACLE_SQL = {
    "op3_sharding": OP3, "op6_jaccard": OP6, "op9_decontamination": OP9, "op12_spelling": OP12, "op13_urls": OP13,
}
