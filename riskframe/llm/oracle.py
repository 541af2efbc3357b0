"""DuckDB SQL of the training-data queries that SQL can express."""

from riskframe.llm import chat, licenses

_LOWER = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _chat() -> str:
    marks = len(chat.START) + len(chat.BETWEEN) + len(chat.END)

    def written(col):
        breaks = " + ".join(
            f"(length({col}) - length(replace({col}, '{c}', ''))) // {len(c)}" for c in ("\\", *chat.CONTROL)
        )
        return f"(length({col}) + {breaks})"

    return f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n as (
  select *, {marks} + {written('role')} + {written('text')} as chars,
    row_number() over w as pos, count(*) over (partition by conv_id) as turns from t
  window w as (partition by conv_id order by turn nulls first, role, text)
), s as (
  select *, sum(chars) over (partition by conv_id order by pos) as upto from n
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(case when role = 'assistant' or pos = turns then upto else 0 end) as bigint) as formatted_chars
from s group by conv_id"""


def _licenses() -> str:
    sets = {name: list(dict.fromkeys(licenses._words(t))) for name, t in licenses.TEMPLATES.items()}
    rows = ", ".join(
        f"('{name}', {words}, {len(words)}, {o}, {len(licenses._words(licenses.TEMPLATES[name])) + len(words) - o},"
        f" {licenses.REQUIRED[name].split(' ')})"
        for name, words in sets.items()
        for o in [licenses._needed(len(words), licenses.CONTAINMENT)]
    )
    places = "union all by name ".join(
        "select doc_id, '{label}' as label, i - 1 as pos from w, unnest(range(1, len(words) + 1)) r(i) where {same}\n".format(
            label=label, same=" and ".join(f"words[i + {j}] = '{p}'" for j, p in enumerate(phrase.split(" ")))
        )
        for phrase, label in licenses.PHRASES.items()
    )
    return f"""
with w as (select doc_id, {_WORDS.format(t='text')} as words from documents),
templates(name, words, t, o, reach, own) as (values {rows}),
able as (
  select doc_id, name from w, templates where len(list_intersect(list_distinct(w.words), templates.words)) >= o
), blocks as (
  select doc_id, name, list_distinct({_WORDS.format(t='line')}) as words
  from documents join able using (doc_id), unnest(string_split(coalesce(text, ''), chr(10))) x(line)
  union all
  select doc_id, name, list_distinct(w.words[i : i + reach - 1])
  from able join w using (doc_id) join templates using (name), unnest(range(1, len(w.words) + 1)) r(i)
  where list_contains(templates.words, w.words[i])
), hits as (
  select doc_id, name, len(list_intersect(blocks.words, templates.words)) as n, t from blocks join templates using (name)
  where len(list_intersect(blocks.words, templates.words)) >= o and len(list_intersect(blocks.words, own)) = len(own)
), best as (
  select doc_id, list(distinct name) as names, max(n / t) as score from hits group by doc_id
), places as ({places}), base as (
  select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, list(distinct label) as names
  from places group by doc_id
)
select w.doc_id, cast(len(w.words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.names, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.names, []), coalesce(best.names, [])))), ',') as labels,
  coalesce(score, 0.0) as score
from w left join base using (doc_id) left join best using (doc_id)"""


_NEAR = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER.format(t='text')}, '[^\\x20\\x09-\\x0D]+') as words from documents
), s as (
  select distinct doc_id, array_to_string(words[i : i + 2], ' ') as g
  from w, unnest(range(1, greatest(len(words) - 1, 2))) r(i) where len(words) > 0
), sizes as (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * common.n >= 85 * (x.n + y.n - common.n)
), both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id as other from w union select reach.doc_id, b from reach join both_ways on other = a
)
select w.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(other) as component_id, w.doc_id = min(other) as kept
from w join reach using (doc_id) left join sizes using (doc_id) group by w.doc_id"""

_BENCH = f"""
with items as (select item_id, {_WORDS.format(t='text')} as words from benchmark),
windows as (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') as g
  from items, unnest(range(1, greatest(len(words) - 8, 2))) r(i) where len(words) > 0
), w as (select doc_id, {_WORDS.format(t='text')} as words from documents),
runs as (
  select doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') as g
  from w, (select distinct n from windows), unnest(range(1, len(words) - n + 2)) r(i)
), found as (select doc_id, i, runs.n, item_id from runs join windows using (g, n)),
hit as (select doc_id, count(distinct pos) as n_hit from found, unnest(range(i, i + n)) r(pos) group by doc_id),
named as (select doc_id, list_sort(list(distinct cast(item_id as varchar))) as ids from found group by doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  cast(coalesce(len(ids), 0) as bigint) as n_items, sha256(array_to_string(coalesce(ids, []), ',')) as items_sha256,
  ids is not null as contaminated
from w left join hit using (doc_id) left join named using (doc_id)"""

_LINES = f"""
with l as (
  select doc_id, i, line, regexp_replace({_LOWER.format(t='line')}, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') as key
  from (select doc_id, unnest(range(1, len(parts) + 1)) as i, unnest(parts) as line
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents))
), k as (
  select key, min(doc_id) as first from l where length(key) >= 10 group by key having count(distinct doc_id) > 1
), m as (select l.*, first is not null and first <> doc_id as gone from l left join k using (key))
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by doc_id"""


_AUDIT = """
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
), w as (
  select *, string_split_regex(text, '[\\x20\\x09-\\x0D]+') as pieces from d
), v as (
  select *, list_filter(pieces, lambda x: x <> '') as words from w
), first as (select text, min(doc_id) as low from d group by text),
good as (select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels group by doc_id),
f as (
  select v.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    (case when len(words) < 200 then 'A' else '' end)
    || (case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end)
    || (case when 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) then 'C' else '' end)
    || (case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end)
    || (case when low < v.doc_id then 'E' else '' end) as fails
  from v join first using (text) left join good using (doc_id)
), g as (
  select part, fails, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
  from f group by part, fails
), letters(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps as (
  select filter_order, step, filter_order[step] as own, filter_order[1 : step - 1] as before
  from orders, unnest(range(1, 6)) t(step)
), r as (
  select part, filter_order, step, own, n, n_good, n_toxic, contains(fails, own) as failing, fails = own as only_it,
    before <> '' and regexp_matches(fails, '[' || before || '_]') as gone
  from g, steps
), s as (
  select part, filter_order, cast(step as integer) as step, own,
    cast(coalesce(sum(n) filter (not failing and not gone), 0) as bigint) as kept,
    cast(coalesce(sum(n) filter (failing and not gone), 0) as bigint) as removed,
    cast(coalesce(sum(n) filter (failing and gone), 0) as bigint) as redundant,
    cast(coalesce(sum(n) filter (only_it), 0) as bigint) as unique_fails,
    cast(coalesce(sum(n_good) filter (failing and not gone), 0) as bigint) as good_lost,
    cast(coalesce(sum(n_toxic) filter (failing and not gone), 0) as bigint) as toxic_lost
  from r group by part, filter_order, step, own
)
select s.* exclude (own), cast(sum(removed) over (partition by part, own) as bigint) as shapley from s"""


def llm_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": _chat(),
        "op5_license_scan": _licenses(),
        "op7_near_duplicates": _NEAR,
        "op8_decontamination": _BENCH,
        "op9_line_dedup": _LINES,
        "op11_filter_audit": _AUDIT,
    }
