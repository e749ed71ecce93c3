"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from salesgrain.llm import license_scan as lic
from salesgrain.llm import secret_scan as scan

SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
lines as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no
  from docs),
keyed as (
  select *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
often as (
  select key, max(doc_id) as keep_id from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select k.doc_id, count(*) as n_lines,
  count(*) filter (o.key is not null and o.keep_id <> k.doc_id) as n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) order by k.no) filter (o.key is null or o.keep_id = k.doc_id), '')) as kept_sha256
from keyed k left join often o on k.key = o.key group by k.doc_id
"""

OP6 = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight, sum(source_size) over () as everything
  from totals),
-- sources reach their limit in the order of size by weight
capping as (
  select *, everything - coalesce(3 * sum(source_size) over before, 0) as left_over, sum(weight) over after as weights
  from weighed
  window before as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding),
         after as (order by source_size / weight, source nulls last rows between current row and unbounded following)),
capped as (select *, 3 * source_size * weights < left_over * weight as stops from capping),
open_share as (select max(left_over) filter (not stops) as x, max(weights) filter (not stops) as w from capped),
targets as (
  select source, source_size,
    case when stops then 3.0 * source_size when w > 0 then x * weight::double / w else 0 end::double as target
  from capped, open_share),
placed as (
  select doc_id, source, size,
    coalesce(sum(size) over (partition by source order by md5('mix-1' || coalesce(doc_id::varchar, '')), size
      rows between unbounded preceding and 1 preceding), 0) as start
  from sized)
select p.doc_id, p.size, t.source_size, t.target,
  (p.size * len(list_filter([0, 1, 2], lambda r: p.size > 0
    and 2 * (r * t.source_size + p.start) + p.size < 2 * least(round_even(t.target, 0), 3 * t.source_size))))::bigint as taken
from placed p join targets t on p.source is not distinct from t.source
"""

OP8 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_CLASS = {
    kind: f"regexp_matches(value, '^[0-9A-Fa-f]+$') = {str(kind == 'entropy_hex').lower()}" for kind in scan.CLASSES
}
_MEASURED = "case when regexp_matches(value, '^[0-9A-Fa-f]+$') then lower(value) else value end"
_ALLOWED = " or ".join(f"regexp_matches(value, '{p}')" for p in scan.ALLOWED)
_LOADS = "[" + ", ".join(f"{n}::bigint" for n in scan.LOADS) + "]"


def _spans(kind: str, rank: int, pattern: str) -> str:
    """Rows of (doc_id, rank, kind, start, stop, value): the pieces between the matches give the places."""
    pattern = pattern.replace("'", "''")
    return f"""
select doc_id, {rank} as rank, '{kind}' as kind, value, start, start + length(value) as stop from (
  select doc_id, value, sum(length(piece) + length(value)) over (partition by doc_id order by no) - length(value) as start
  from (
    select doc_id, unnest(hits) as value, unnest(pieces[:len(hits)]) as piece, generate_subscripts(hits, 1) as no
    from (
      select doc_id, regexp_extract_all(text, '{pattern}') as hits, string_split_regex(text, '{pattern}') as pieces from docs)))
"""


OP1 = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
assigned as (
  select * from ({_spans('assign', 0, scan.ASSIGN)})
  where length(regexp_extract(value, '^{scan.ASSIGN.replace("'", "''")}$', 2)) >= {scan.MIN_VALUE}),
base as (
  select * from assigned union all select * from ({_spans('access', 1, scan.ACCESS)})
  union all select * from ({_spans('hex', 2, scan.HEX)})),
candidates as (select * from ({_spans('candidate', 9, scan.CANDIDATE)}) where not ({_ALLOWED})),
windows as (
  select doc_id, start, stop, value, place, substr({_MEASURED}, place::bigint, {scan.WINDOW}) as part
  from (select *, unnest(generate_series(1, length(value) - {scan.WINDOW} + 1)) as place from candidates)),
symbols as (
  select doc_id, start, stop, value, place, symbol, count(*) as n
  from (select doc_id, start, stop, value, place, unnest(string_split(part, '')) as symbol from windows) group by all),
loads as (
  select doc_id, start, stop, value, min(load) as load
  from (select doc_id, start, stop, value, place, sum(({_LOADS})[n + 1]) as load from symbols group by all) group by all),
entropy as (
  select doc_id, case when regexp_matches(value, '^[0-9A-Fa-f]+$') then 3 else 4 end as rank,
    case when regexp_matches(value, '^[0-9A-Fa-f]+$') then 'entropy_hex' else 'entropy_base64' end as kind, value, start, stop
  from loads where load <= case when regexp_matches(value, '^[0-9A-Fa-f]+$')
    then {scan.most_load(scan.CLASSES['entropy_hex'][1])} else {scan.most_load(scan.CLASSES['entropy_base64'][1])} end),
spans as (select *, kind || ':' || start || ':' || stop as name from (select * from base union all select * from entropy))
select d.doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access,
  count(*) filter (rank = 2) as n_hex,
  sha256(coalesce(string_agg(name, ',' order by start, rank) filter (rank < 3), '')) as base_sha256,
  coalesce(string_agg(name, ',' order by start, rank), '') as spans, count(*) filter (rank > 2) as n_entropy
from docs d left join spans s on d.doc_id = s.doc_id group by d.doc_id
"""

_TEMPLATES = ", ".join(f"({t.number}, '{t.family}', '{t.label}', {t.words}, {t.required})" for t in lic.template_sets())
_AT = {
    label: " and ".join(f"list_extract(ws, i::int + {k}) = '{word}'" for k, word in enumerate(phrase.split()))
    for label, phrase in lic.PHRASES.items()
}
_PLACES = " union all ".join(
    f"select doc_id, '{label}' as label, i - 1 as place from (select doc_id, ws, unnest(generate_series(1, len(ws))) as i "
    f"from words) where {test}"
    for label, test in _AT.items()
)

OP3 = rf"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{lic.WORD}') as ws from documents),
places as ({_PLACES}),
templates(template, family, label, t_words, required) as (values {_TEMPLATES}),
blocks as (
  select doc_id, b, list_distinct(ws[b * {lic.STEP} + 1 : b * {lic.STEP} + {lic.BLOCK_WORDS}]) as b_words
  from (select doc_id, ws, unnest(generate_series(0, greatest(len(ws) - 1, 0) // {lic.STEP})) as b from words)),
shared as (
  select b.doc_id, b.b, t.family, t.label, len(list_intersect(b.b_words, t.t_words)) as overlap, len(t.t_words) as size
  from blocks b, templates t where list_has_all(b.b_words, t.required)),
met as (
  select doc_id, label, overlap / size as containment from shared where overlap >= ceil(round({lic.THRESHOLD} * size, 9))
  qualify overlap = max(overlap) over (partition by doc_id, b, family)),
base as (
  select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels
  from places group by doc_id),
labels as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels
  from (select doc_id, label from places union all select doc_id, label from met) group by doc_id),
best as (select doc_id, max(containment) as containment from met group by doc_id)
select w.doc_id, len(w.ws)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  case when n_base > 0 then 1.0 else coalesce(containment, 0.0) end::double as score
from words w left join base using (doc_id) left join labels using (doc_id) left join best using (doc_id)
"""

OP11 = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as vector
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id, list_inner_product(a.vector, r.vector)::bigint as score
  from usable a join usable r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
fitting as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
    and 100 * s.score between 30 * positive_score and 90 * positive_score)
select * from fitting where rank <= 10
"""

OP13 = r"""
with words as (
  select 'd' as kind, doc_id as id, text from documents union all select 'i', item_id, text from benchmark),
split as (
  select kind, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from words),
counted as (select kind, id, term, count(*) as tf from split group by all),
lengths as (select id, sum(tf)::bigint as n from counted where kind = 'd' group by id),
totals as (select count(*) as all_docs, sum(n)::bigint as all_words from lengths),
weights as (
  select term, floor(1000 * ln((2 * any_value(all_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from counted, totals where kind = 'd' group by term),
scores as (
  select i.id as item_id, d.id as doc_id, sum(i.tf * w * (
    (1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * n * all_docs) // all_words))))::bigint as score
  from counted i join counted d on i.term = d.term and i.kind = 'i' and d.kind = 'd'
  join weights on weights.term = i.term join lengths on lengths.id = d.id, totals
  group by i.id, d.id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

SQL: dict[str, str] = {
    "op1_secret_scan": OP1,
    "op3_license_scan": OP3,
    "op5_line_dedup": OP5,
    "op6_source_mix": OP6,
    "op8_exact_dedup": OP8,
    "op11_hard_negatives": OP11,
    "op13_lexical_search": OP13,
}
