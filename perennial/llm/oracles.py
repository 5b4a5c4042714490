"""The queries in DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from perennial.llm import licenses, preferences, quality

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
with base as (
  select doc_id, coalesce(text, '') as t, {_WORDS.format(text="text")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
  from documents),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from base)),
repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows) where n > 1),
covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from repeated) group by doc_id),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(regexp_extract_all(t, '!')) as bigint) as n_exclaims,
    cast(len(regexp_extract_all(t, '[0-9]')) as bigint) as n_digits,
    cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words
  from base left join covered using (doc_id)),
judged as (
  select *, cast({" + ".join(f"(case when {rule} then {1 << bit} else 0 end)" for bit, rule in enumerate(quality.RULES.values()))} as bigint) as fail_bits
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {quality.mask(quality.BASE_RULES)}) <> 0 as base_failed,
  (fail_bits & {quality.mask(quality.POLICIES["v2"]) | quality.mask(quality.BASE_RULES)}) = 0 as kept, fail_bits
from judged
"""

OP4 = r"""
with texts as (
  select row_number() over () as r, page_id, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '') as host,
    regexp_replace(html, '<[^>]*>', chr(10), 'g') as text from pages),
split as (
  select r, host, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from texts where text is not null),
totals as (select host, count(*) as n_pages from texts group by host),
counted as (
  select host, trim(line, ' ' || chr(9) || chr(13)) as key, count(distinct r) as n from split
  where trim(line, ' ' || chr(9) || chr(13)) <> '' group by 1, 2),
boiler as (
  select c.host, key from counted c join totals p on c.host is not distinct from p.host where n >= 5 and n > n_pages * 0.1::double),
marked as (
  select s.*, b.key is not null as boilerplate from split s left join boiler b
  on s.host is not distinct from b.host and trim(s.line, ' ' || chr(9) || chr(13)) = b.key),
cleaned as (
  select r, count(*) as n_lines, count(*) filter (where boilerplate) as n_dropped,
    coalesce(string_agg(line, chr(10) order by pos) filter (where not boilerplate), '') as text
  from marked group by r)
select page_id, host, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_dropped, 0) as bigint) as n_dropped, md5(c.text) as text_md5
from texts left join cleaned c using (r)
"""

_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all(coalesce({_FOLDED}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
with items as (select cast(item_id as varchar) as item, {_BENCH_WORDS} as w from benchmark),
patterns as (
  select item, unnest(range(1, len(w) - m + 2)) as i, w, m
  from (select item, w, least(10, len(w)) as m from items where len(w) > 0)),
grams as (select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as g from patterns),
lengths as (select distinct m from grams),
docs as (select doc_id, {_BENCH_WORDS} as w from documents),
windows as (
  select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as g
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from docs cross join lengths where len(w) >= m)),
hits as (select doc_id, i, windows.m, item from windows join grams on windows.m = grams.m and windows.g = grams.g),
covered as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + m)) as p from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id)
select docs.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from docs left join covered using (doc_id) left join found using (doc_id)
"""

_KNOWN, _OTHER_IDF, _ = licenses.template_words(licenses.TEMPLATES)

OP1 = rf"""
with known(word, idf, template, license, w) as (values {", ".join(f"('{word}', {idf!r}::double, {template}, '{name}', {w!r}::double)" for word, idf, template, name, w in _KNOWN)}),
files as (
  select text, concat_ws('/', source, lang, cast(doc_id // 1000 as varchar),
    case when doc_id % 100 = 0 then null else cast(doc_id // 100 as varchar) end,
    case when doc_id % 10 = 0 then 'LICENSE-' || doc_id else 'file-' || doc_id || '.txt' end) as path from documents),
lines as (select distinct path, unnest(string_split(text, chr(10))) as line from files where text is not null),
words as (
  select line, word, count(*) as tf
  from (select line, unnest(regexp_extract_all(lower(line), '[\p{{L}}\p{{N}}]+')) as word from (select distinct line from lines))
  group by 1, 2),
weighted as (
  select line, words.word, tf * coalesce(i.idf, {_OTHER_IDF!r}::double) as x
  from words left join (select distinct word, idf from known) i on words.word = i.word),
norms as (select line, sqrt(sum(x * x)) as norm from weighted group by line),
scored as (
  select line, license, round(sum(x * w) / any_value(norm), 6) as score
  from weighted join known using (word) join norms using (line) group by line, template, license),
matched as (select path, license, score from lines join scored using (line) where score >= {licenses.THRESHOLD}),
found as (
  select path, license, score from matched qualify row_number() over (partition by path order by score desc, license) = 1),
parted as (select path, regexp_replace(path, '/?[^/]*$', '') as directory from files),
licensed as (
  select directory, license from found join parted using (path) where regexp_matches(path, '(^|/)LICENSE[^/]*$')
  qualify row_number() over (partition by directory order by score desc, license) = 1),
above as (
  select path, directory, d, array_to_string((string_split(directory, '/'))[1:d], '/') as origin
  from (select path, directory, unnest(range(0, len(string_split(directory, '/')) + 1)) as d from parted)),
inherited as (
  select path, l.license as inherited_license, origin as inherited_from from above join licensed l on above.origin = l.directory
  qualify row_number() over (partition by path order by d desc) = 1)
select path, license as header_license, score, inherited_license, inherited_from, coalesce(license, inherited_license) as license
from parted left join found using (path) left join inherited using (path)
"""

_ROLE = preferences.TRAINED_ROLE
_END = "chr(10) || '<|end|>' || chr(10)"
_OPEN = "'<|' || t.role || '|>' || chr(10)"
_TEXT = f"coalesce(array_to_string(list_transform({{0}}, lambda t: {_OPEN} || t.text || {_END}), ''), '')"
_MASK = (
    f"coalesce(array_to_string(list_transform({{0}}, lambda t: case when t.role = '{_ROLE}' "
    f"then length({_OPEN}) || ',' || (length(t.text) + {len(preferences.CLOSING)}) "
    f"else (length({_OPEN}) + length(t.text) + {len(preferences.CLOSING)}) || ',0' end), ','), '')"
)

OP6 = f"""
with whole as (
  select conv_id, list({{'turn': turn, 'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn, role, text) as ts
  from conversations group by conv_id),
placed as (
  select conv_id, ts, list_max(list_filter(range(1, len(ts) + 1), lambda i: ts[i].role = '{_ROLE}')) as last from whole),
answered as (select * from placed where last is not null),
pairs as (
  select a.conv_id as pair_id, a.ts as c, a.last, b.ts[b.last].text as other
  from answered a left join answered b on xor(a.conv_id, 1) = b.conv_id),
replaced as (
  select pair_id, c, case when other is null then c[1:last - 1] else list_transform(c, lambda t, i: case when i = last
    then {{'turn': t.turn, 'role': t.role, 'text': other}} else t end) end as r from pairs),
cut as (
  select *, coalesce(list_min(list_filter(range(1, len(c) + 1), lambda i: i > len(r) or c[i].role <> r[i].role or c[i].text <> r[i].text)) - 1, len(c)) as n
  from replaced)
select pair_id, cast(n as integer) as n_prompt_turns, {_TEXT.format("c[1:n]")} as prompt,
  {_TEXT.format("c[n + 1:]")} as chosen, {_MASK.format("c[n + 1:]")} as chosen_mask,
  {_TEXT.format("r[n + 1:]")} as rejected, {_MASK.format("r[n + 1:]")} as rejected_mask,
  n < len(c) as differs
from cut
"""

OP11 = r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
split as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as first from texts),
said as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
judged as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    (case when len(w) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
    + (case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end) + (case when doc_id > first then 16 else 0 end) as bits
  from split left join said using (doc_id)),
counted as (select part, bits, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by part, bits),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
  join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)),
steps as (
  select filter_order, step, 1 << (instr('ABCDE', filter_order[step]) - 1) as bit,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (instr('ABCDE', filter_order[i]) - 1))), 0)::integer as past
  from (select filter_order, unnest(range(1, 6))::integer as step from orders)),
reported as (
  select part, filter_order, step, bit,
    coalesce(sum(n) filter (where bits & (past | bit) = 0), 0) as kept,
    coalesce(sum(n) filter (where bits & past = 0 and bits & bit <> 0), 0) as removed,
    coalesce(sum(n) filter (where bits & past <> 0 and bits & bit <> 0), 0) as redundant,
    coalesce(sum(n) filter (where bits = bit), 0) as unique_fails,
    coalesce(sum(good) filter (where bits & past = 0 and bits & bit <> 0), 0) as good_lost,
    coalesce(sum(toxic) filter (where bits & past = 0 and bits & bit <> 0), 0) as toxic_lost
  from counted cross join steps group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from reported
"""

_SEARCH_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = rf"""
with docs as (select row_number() over () as r, doc_id, {_SEARCH_WORDS} as w from documents where text is not null),
sized as (select r, doc_id, w, len(w) as n from docs where len(w) > 0),
whole as (select count(*) as n_docs, sum(n)::bigint as n_words from sized),
held as (select r, term, count(*) as tf from (select r, unnest(w) as term from sized) group by r, term),
items as (select row_number() over () as i, item_id, list_distinct({_SEARCH_WORDS}) as w from benchmark where text is not null),
asked as (select i, item_id, unnest(w) as term from items),
weighted as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as weight
  from held cross join whole where term in (select term from asked) group by term),
scored as (
  select i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words))))::bigint as score
  from asked join held using (term) join weighted using (term) join sized using (r) cross join whole
  group by i, item_id, r, doc_id),
ranked as (
  select item_id, (row_number() over (partition by i order by score desc, doc_id nulls last))::integer as rank, doc_id, score
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": OP1, "op6_preference_formatting": OP6, "op3_decontamination": OP3, "op4_line_dedup": OP4, "op5_quality_rules": OP5,
        "op11_filter_interactions": OP11, "op12_lexical_search": OP12,
    }
