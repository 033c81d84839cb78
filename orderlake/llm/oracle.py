"""The operators' results in DuckDB SQL, for those that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

_EXACT_DEDUP = f"""
with normal as (
    select doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') as norm from documents
)
select
    doc_id,
    min(doc_id) over (partition by norm) as keep_id,
    count(*) over (partition by norm) as group_size,
    row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
    sha256(norm) as text_sha256
from normal
"""

_JACCARD_JOIN = f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
    from documents
),
shingles as (
    select distinct doc_id, array_to_string(w[k:k + 4], ' ') as shingle
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from words where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id
),
links as (
    select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y
    where 100 * common >= 75 * (a.n + b.n - common)
),
reached(doc_id, other) as (
    select doc_id, doc_id from documents
    union
    select r.doc_id, l.y from reached r join links l on l.x = r.other
),
classes as (select doc_id, md5(string_agg(shingle, chr(10) order by shingle)) as set_hash from shingles group by doc_id)
select
    d.doc_id,
    coalesce(s.n, 0) as n_shingles,
    (select min(other) from reached r where r.doc_id = d.doc_id) as component_id,
    case when c.set_hash is null then d.doc_id else min(d.doc_id) over (partition by c.set_hash) end as class_id
from documents d left join sizes s on s.doc_id = d.doc_id left join classes c on c.doc_id = d.doc_id
"""

_MIXING = f"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
        coalesce(doc_id::varchar, 'text ' || md5(coalesce(text, ''))) as name
    from documents
),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
    select *, ([3.0, 1.0, 2.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight,
        source_size::double * 2 as cap, (sum(source_size) over ())::double * 1.5 as mix
    from sums
),
ordered as (
    select *,
        mix - coalesce(sum(cap) over w, 0.0) as remaining,
        sum(weight) over () - coalesce(sum(weight) over w, 0.0) as remaining_weight
    from weighed
    window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
marked as (select *, cap * remaining_weight <= weight * remaining as capped from ordered),
targets as (
    select source, source_size,
        case when capped then cap
             else weight * (mix - sum(case when capped then cap else 0.0 end) over ())
                  / nullif(sum(case when capped then 0.0 else weight end) over (), 0) end as target
    from marked
),
drawn as (
    select s.doc_id, s.size, t.source_size, t.target,
        case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
        ('0x' || substr(md5('mix-1:' || s.name), 1, 12))::bigint::double / 281474976710656.0 as draw
    from sized s join targets t on s.source is not distinct from t.source
),
counted as (select *, floor(rate)::bigint + (draw < rate - floor(rate))::int as copies from drawn)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, copies::bigint as copies from counted
"""

_CHAT = """
with said as (
    select conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
),
speakers as (select distinct conv_id, role as speaker from said where role <> 'system'),
seen as (
    select a.conv_id, s.speaker, a.turn, a.role, a.text,
        case when a.role = 'system' then '<|system|>' when a.role = s.speaker then '<|assistant|>'
             else '<|user name=' || a.role || '|>' end || chr(10) as header
    from said a join speakers s on a.conv_id is not distinct from s.conv_id
),
segments as (select *, header || text || '<|end|>' || chr(10) as segment from seen),
placed as (
    select *, sum(length(segment)) over (partition by conv_id, speaker order by turn nulls first, role, text rows unbounded preceding)::bigint as char_end
    from segments
)
select
    conv_id, speaker, turn, segment,
    char_end - length(segment) as char_start,
    char_end,
    case when role = speaker then char_end - length(segment) + length(header) else char_end - length(segment) end as mask_start,
    case when role = speaker then char_end - 1 else char_end - length(segment) end as mask_end
from placed
"""

_QUALITY = f"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
),
words as (select r, regexp_extract_all(text, '{_WORD}') as w from texts),
windows as (
    select r, k, array_to_string(w[k:k + 4], ' ') as seen
    from (select r, w, unnest(range(1, len(w) - 3)) as k from words where len(w) >= 5)
),
repeated as (
    select r, count(distinct k + i) as n_repeat_words
    from (select r, k, count(*) over (partition by r, seen) as times from windows), range(0, 5) as t(i)
    where times > 1
    group by r
),
lines as (
    select r, line from (select r, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '{_WORD}')
),
line_counts as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from lines group by r),
figures as (
    select t.doc_id,
        len(w)::bigint as n_words,
        length(regexp_replace(text, '{_SPACE}', '', 'g'))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        coalesce(n_lines, 0) as n_lines,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
        length(regexp_replace(text, '[^a-z]', '', 'g')) as n_lower
    from texts t join words using (r) left join repeated using (r) left join line_counts using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words
         or word_chars > 20.0 * greatest(n_words, 1)
         or n_symbols > 0.2 * greatest(n_words, 1)
         or n_dup_lines > 0.4 * greatest(n_lines, 1)
         or (n_upper > n_lower and n_upper > 100)) as kept
from figures
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_DECONTAMINATION = f"""
with items as (
    select coalesce(item_id::varchar, '') as item, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}') as w from benchmark
),
phrases as (
    select distinct item, least(len(w), 10) as n, array_to_string(w[k:k + 9], ' ') as phrase
    from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from items where len(w) > 0)
),
lengths as (select distinct n from phrases),
docs as (
    select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}') as w from documents
),
windows as (
    select r, k, n, array_to_string(w[k:k + n - 1], ' ') as phrase
    from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from docs, lengths where len(w) >= n)
),
found as (select r, k, n, item from windows join phrases using (n, phrase)),
hit as (select r, count(distinct word) as n_hit from (select r, unnest(range(k, k + n)) as word from found) group by r),
named as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct r, item from found) group by r
)
select
    doc_id,
    len(w)::bigint as n_words,
    coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256,
    n_hit is not null as contaminated
from docs left join hit using (r) left join named using (r)
"""



def _vector_codes(rounds: int = 4) -> str:
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
a{n} as materialized (
    select r, p, x, arg_min(e, d * 256 + e) as e, min(d) as d
    from (select r, p, x, e, {distance} as d from parts join b{n} using (p)) group by r, p, x
)""")
        if n < rounds:
            steps.append(f"""
s{n} as (
    select p, e, list(total order by i) as c
    from (
        select p, e, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*))::bigint // count(*) as total
        from (select p, e, unnest(x) as v, unnest(range(16)) as i from a{n}) group by p, e, i
    ) group by p, e
),
b{n + 1} as materialized (select p, e, coalesce(s{n}.c, b{n}.c) as c from b{n} left join s{n} using (p, e))""")
    return f"""
with kept as (
    select row_number() over (order by vec_id) as r, vec_id, label,
        list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (select r, p, v[p * 16 + 1:p * 16 + 16] as x from kept, range(4) as t(p)),
b0 as materialized (select p, r - 1 as e, x as c from parts where r <= 256),{",".join(steps)},
coded as (
    select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from a{rounds} group by r
),
book as (
    select sha256(string_agg(v::varchar, ',' order by p, e, i)) as codebooks_sha256
    from (select p, e, unnest(c) as v, unnest(range(16)) as i from b{rounds})
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (r), book
"""


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": _EXACT_DEDUP,
    "op4_jaccard_join": _JACCARD_JOIN,
    "op7_mixing": _MIXING,
    "op8_chat": _CHAT,
    "op9_quality": _QUALITY,
    "op12_vector_codes": _vector_codes(),
    "op13_decontamination": _DECONTAMINATION,
}
