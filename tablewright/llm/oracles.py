"""The registered queries once more as SQL over the same tables (ids taken as unique)."""

from __future__ import annotations

from tablewright.llm import licenses, mixing, secrets
from tablewright.llm.shared import NOT_PLAIN, PLAIN_WORD, SPACED_WORD

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


OP1 = f"""
with d as (
    select doc_id, len(regexp_extract_all({LOWER}, {quoted(PLAIN_WORD)})) as n_words,
           ' ' || trim(regexp_replace({LOWER}, {quoted(NOT_PLAIN)}, '  ', 'g'), ' ') || ' ' as norm from documents),
rules as (select * from (values {values((i, r.label, r.pattern, r.keyword.replace(" ", "  "), r.confidence, r.priority) for i, r in enumerate(licenses.rules()))})
          v(rule, label, pattern, keyword, confidence, priority)),
pieces as (
    select doc_id, rule, unnest(string_split_regex(norm, pattern)) as gap,
           unnest(list_concat(regexp_extract_all(norm, pattern), [null])) as hit,
           generate_subscripts(string_split_regex(norm, pattern), 1) as i
    from d join rules on contains(norm, keyword)),
counted as (select *, length(gap) - length(replace(gap, ' ', '')) as g, length(hit) - length(replace(hit, ' ', '')) as h from pieces),
spans as (
    select doc_id, rule, cast((sum(g) over o + coalesce(sum(h) over (o rows between unbounded preceding and 1 preceding), 0)) // 2 as bigint) as s, h // 2 as n
    from counted window o as (partition by doc_id, rule order by i) qualify hit is not null),
found as (select distinct doc_id, s, s + n as e, n, rule, label, confidence, priority from spans join rules using (rule)),
kept as (
    select * from found a where not exists (
        select 1 from found b where b.doc_id = a.doc_id and b.s <= a.s and a.e <= b.e and (b.priority, b.n, -b.rule) > (a.priority, a.n, -a.rule))),
base as (
    select doc_id, count(*) as n_base, min(s) as first_word, max(s) as last_word, string_agg(distinct label, ',' order by label) as base_labels
    from found where rule < {len(licenses.BASE)} group by doc_id),
labels as (
    select doc_id, string_agg(distinct label, ',' order by label) as labels
    from (select doc_id, label from kept union select doc_id, label from found where rule < {len(licenses.BASE)}) group by doc_id),
sure as (select doc_id, max(confidence) as c from kept group by doc_id)
select doc_id, n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       cast(greatest(coalesce(c, 0), case when n_base > 0 then {licenses.BASE_CONFIDENCE} else 0 end) as double) as score
from d left join base using (doc_id) left join labels using (doc_id) left join sure using (doc_id)
"""

OP3 = f"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {quoted(SPACED_WORD)}) as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from documents),
win as (select doc_id, i, list_slice(w, i, i + 2) as k from d, unnest(range(1, len(w) - 1)) u(i)),
twice as (select doc_id, i from win qualify count(*) over (partition by doc_id, k) > 1),
rep as (select doc_id, count(distinct p) as n from twice, unnest(range(i, i + 3)) u(p) group by doc_id),
m as (
    select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(n, 0) as n_repeat_words, len(lines) as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) as up, length(regexp_replace(t, '[^a-z]', '', 'g')) as low
    from d left join rep using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 10 * n_symbols <= 3 * n_words and 2 * n_dup_lines <= n_lines and up <= low and word_chars <= 25 * n_words as kept
from f
"""

OP4 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n_bytes from documents),
win as (select doc_id, i, substr(h, 2 * i + 1, 100) as k from d, unnest(range(0, n_bytes - 49)) u(i)),
firsts as (select k, min(doc_id) as f from win group by k having count(*) > 1),
gone as (select doc_id, i from win join firsts using (k) where f < doc_id),
next as (select doc_id, i, lag(i) over o as before, lead(i) over o as after from gone window o as (partition by doc_id order by i)),
runs as (select doc_id, i as a, sum(case when before is null or i > before + 50 then 1 else 0 end) over (partition by doc_id order by i) as run from next),
spans as (select doc_id, run, min(a) as a, max(a) + 50 as b from runs group by doc_id, run),
cuts as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as from_ from spans),
kept as (
    select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as k
    from cuts join d using (doc_id) group by doc_id)
select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from d left join kept using (doc_id)
"""

OP5 = f"""
with recursive d as (select doc_id, regexp_extract_all({LOWER}, {quoted(SPACED_WORD)}) as w from documents),
sh as (select distinct doc_id, list_slice(w, i, i + 4) as k from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) u(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.k = b.k and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id
from documents left join sizes using (doc_id) left join (select a as doc_id, min(b) as m from reach group by a) using (doc_id)
"""

_OP7_PIECES = "\nunion all ".join(
    f"""select doc_id, {i} as kind, {quoted(r.kind)} as name, {r.least} as least, unnest(string_split_regex(t, {quoted(r.pattern)})) as gap,
    unnest(list_concat(regexp_extract_all(t, {quoted(r.pattern)}), [null])) as hit, unnest(list_concat(regexp_extract_all(t, {quoted(r.pattern)}, {r.value}), [null])) as val,
    generate_subscripts(string_split_regex(t, {quoted(r.pattern)}), 1) as i from d where regexp_matches(t, {quoted(r.gate)})"""
    for i, r in enumerate(secrets.RULES)
)
OP7 = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
pieces as ({_OP7_PIECES}),
spans as (
    select doc_id, kind, name, least, val, hit, (sum(length(gap)) over o + coalesce(sum(length(hit)) over (o rows between unbounded preceding and 1 preceding), 0))::bigint as s
    from pieces window o as (partition by doc_id, kind order by i)),
found as (select doc_id, kind, s, name || ':' || s || ':' || (s + length(hit)) as span from spans where length(val) >= least),
per as (
    select doc_id, {", ".join(f"count(*) filter (where kind = {i}) as n_{r.kind}" for i, r in enumerate(secrets.BASE))},
           string_agg(span, ',' order by s, kind) filter (where kind < {len(secrets.BASE)}) as base, string_agg(span, ',' order by s, kind) as spans
    from found group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secrets.BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per using (doc_id)
"""

OP9 = f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {quoted(SPACED_WORD)})) as size from documents),
s as (select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight from d group by source),
r as (select *, {mixing.MOST_COPIES} * source_size as cap, {mixing.MOST_COPIES} * source_size / weight as ratio from s),
f as (
    select *, row_number() over o as place, (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
           / (sum(weight) over () - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0)) as level
    from r window o as (order by ratio, source nulls last)),
t as (
    select source, source_size, least(cap::double, weight * (select arg_min(level, place) from f where level <= ratio)) as target,
           ('0x' || substr(md5('{mixing.SEED}:' || coalesce('=' || source, '')), 1, 8))::ubigint / 4294967296.0::double as u
    from f),
p as (
    select doc_id, size, source_size, target, row_number() over (partition by d.source order by size, doc_id) - 1 as i, u,
           case when source_size > 0 then target / source_size else 0 end as each
    from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, (size * (floor((i + 1) * each + u) - floor(i * each + u)))::bigint as taken from p
"""

OP10 = f"""
with d as (select doc_id, regexp_extract_all({LOWER}, {quoted(PLAIN_WORD)}) as w from documents),
b as (select item_id, regexp_extract_all({LOWER}, {quoted(PLAIN_WORD)}) as w from benchmark),
wins as (select distinct item_id, list_slice(w, i, i + 9) as k from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) u(i) where len(w) > 0),
places as (
    select doc_id, i, n, list_slice(w, i, i + n - 1) as k
    from (select d.*, lens.n from d, (select distinct len(k) as n from wins) lens where len(w) >= lens.n), unnest(range(1, len(w) - n + 2)) u(i)),
hits as (select doc_id, i, n, item_id from places join wins using (k)),
cover as (select doc_id, count(distinct p) as n_hit from (select distinct doc_id, i, n from hits), unnest(range(i, i + n)) u(p) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
    from (select distinct doc_id, item_id from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join cover using (doc_id) left join items using (doc_id)
"""

LOWER_OR_NULL = LOWER.replace("coalesce(text, '')", "text")


def _leaf(text: str) -> str:
    parts = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in parts) + ")"


# CRC-32 of the id's digits, bit by bit: eight steps a digit.
_BYTE = "list_reduce(list_prepend(xor(c, x), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
_CRC = f"xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda l: ascii(l)::ubigint)), lambda c, x: {_BYTE}), 4294967295::ubigint)"
OP11 = f"""
with recursive d as (
    select doc_id, lang, {_leaf('text')} as leaf, case when {_CRC} % 3 = 0 then {_leaf(LOWER_OR_NULL)} else {_leaf('text')} end as shown,
           row_number() over (partition by lang order by doc_id) - 1 as i, count(*) over (partition by lang) as n from documents),
node(lang, level, i, h, n) as (
    select lang, 0::bigint, i, leaf, n from d
    union all select lang, level + 1, i // 8, sha256(string_agg(h, '' order by i)), (any_value(n) + 7) // 8 from node where n > 1 group by lang, level, i // 8),
sub as (select lang, h as subroot, level as height, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from node where n = 1),
over_(level, i, h, n) as (
    select 0::bigint, i, subroot, n from sub
    union all select level + 1, i // 8, sha256(string_agg(h, '' order by i)), (any_value(n) + 7) // 8 from over_ where n > 1 group by level, i // 8),
-- every tree's levels, then those above: one path from each leaf to the root
place as (
    select doc_id, d.lang, step, case when step < height then d.i // (8 ** step)::bigint else s.i // (8 ** (step - height))::bigint end as p, height
    from d join sub s on d.lang is not distinct from s.lang, unnest(range(0, height + (select max(level) from over_))) u(step)),
run as (
    select doc_id, step, p % 8 as own, n.i % 8 as j, n.h from place join node n on step < height and n.lang is not distinct from place.lang and n.level = step and n.i // 8 = p // 8
    union all select doc_id, step, p % 8, n.i % 8, n.h from place join over_ n on step >= height and n.level = step - height and n.i // 8 = p // 8),
proof as (select doc_id, sha256(coalesce(string_agg(h, '' order by step, j) filter (where j <> own), '')) as proof_sha256 from run group by doc_id),
sides as (
    select doc_id, step, coalesce(string_agg(h, '' order by j) filter (where j < own), '') as a, coalesce(string_agg(h, '' order by j) filter (where j > own), '') as b
    from run group by doc_id, step),
folded(doc_id, step, h) as (
    select doc_id, 0::bigint, shown from d
    union all select f.doc_id, f.step + 1, sha256(a || h || b) from folded f join sides s on s.doc_id = f.doc_id and s.step = f.step),
last as (select doc_id, arg_max(h, step) as folded_root from folded group by doc_id)
select doc_id, leaf, subroot, (select h from over_ where n = 1) as root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root,
       folded_root = (select h from over_ where n = 1) as verified
from d join sub s on d.lang is not distinct from s.lang left join proof using (doc_id) join last using (doc_id)
"""

OP12 = f"""
with d as (select coalesce(lang, 'und') as lang, unnest(string_split_regex({LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from d),
n as (select lang, sum(len(w))::bigint as n from w group by lang),
f as (
    select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase, count(*) as f
    from w, unnest([1, 2, 3]) u(k), unnest(range(1, len(w) - k + 2)) v(i) group by all having count(*) >= 10),
cuts as (
    select c.lang, c.phrase, c.f as a, l.f as l, r.f as r, j, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
    from (select *, unnest(range(1, k)) as j, string_split(phrase, ' ') as p from f where k > 1) c
    join f l on l.lang = c.lang and l.phrase = array_to_string(list_slice(p, 1, j), ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(list_slice(p, j + 1, c.k), ' ')),
least as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
kept as (
    select * from least s where not exists (
        select 1 from f t where t.lang = s.lang and t.k > len(string_split(s.phrase, ' ')) and contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ') and 100 * t.f >= 50 * s.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept join n using (lang) qualify rank <= 2000
"""
