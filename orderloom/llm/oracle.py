"""The same as SQL, for the queries that SQL can express."""

from __future__ import annotations

from orderloom.llm.queries import MIX_WEIGHTS, PROBE

_WORDS = r"[x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"

OP3 = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r0 from conversations
  union all select -1, 0, 'user', '{PROBE}', 'user'
  union all select -1, 1, 'assistant', '{PROBE}', 'assistant'
), placed as (
  select *, row_number() over w as n, lag(role) over w as last from turns
  window w as (partition by conv_id order by turn nulls first, role, text)
), sized as (
  select *,
    length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&#91;')) as text_n,
    length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&#91;')) as role_n
  from placed
)
select conv_id, cast(count(*) as bigint) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by n)) as loss_sha256,
  cast(sum(text_n + case when last = role then 8
    else 16 + role_n + case when last is null then 0 else 8 end end) + 8 as bigint) as formatted_chars
from sized group by conv_id
"""


def _weight(level: str, column: str) -> str:
    cases = " ".join(f"when {column} = '{k}' then {v}" for k, v in MIX_WEIGHTS[level].items())
    return f"case {cases} else 1 end"


def _level(name: str, above: str, keys: list[str], level: str) -> str:
    """SQL for the budgets of one level: children in the order of capacity per weight."""
    group, parent = ", ".join(keys), ", ".join(keys[:-1]) or "0"
    given = (
        "(select sum(tokens) from leaves)"
        if not keys[:-1]
        else f"(select p.budget from {above} p where "
        + " and ".join(f"p.{k} is not distinct from n.{k}" for k in keys[:-1])
        + ")"
    )
    return f"""
{name}_nodes as (
  select n.*, {_weight(level, keys[-1])} as weight, {given} as b
  from (select {group}, sum(tokens) * 2 as cap from leaves group by {group}) n
), {name}_left as (
  select *, b - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0) as left_b,
    sum(weight) over (w rows between current row and unbounded following) as weights
  from {name}_nodes
  window w as (partition by {parent} order by cap / weight, {group})
), {name}_full as (
  select *, min(cast(cap * weights <= left_b * weight as int))
    over (partition by {parent} order by cap / weight, {group} rows between unbounded preceding and current row) as filled
  from {name}_left
), {name} as (
  select {group}, case when filled = 1 then cap else least(cap, ((b - coalesce(sum(case when filled = 1 then cap end)
    over (partition by {parent}), 0)) * weight) // (sum(case when filled = 0 then weight end) over (partition by {parent}))) end as budget
  from {name}_full
)"""


OP4 = rf"""
with docs as (
  select doc_id, lang, source, len({_WORDS}) as tokens,
    case when length(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1)) <> 1 then 'books' else 'web' end as domain
  from documents
), leaves as (select domain, lang, source, sum(tokens) as tokens from docs group by all),
{_level("d1", "", ["domain"], "domain")},
{_level("d2", "d1", ["domain", "lang"], "lang")},
{_level("d3", "d2", ["domain", "lang", "source"], "source")},
plan as (
  select l.*, case when tokens > 0 then budget // tokens else 0 end as whole, case when tokens > 0 then budget % tokens else 0 end as part
  from leaves l join d3 b on l.domain is not distinct from b.domain and l.lang is not distinct from b.lang
    and l.source is not distinct from b.source
), placed as (
  select d.*, whole, part, md5('7:' || whole || ':' || coalesce(cast(doc_id as varchar), '')) as place
  from docs d join plan p on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang
    and d.source is not distinct from p.source
), summed as (
  select *, sum(tokens) over (partition by domain, lang, source order by place
    range between unbounded preceding and current row) - sum(tokens) over (partition by domain, lang, source, place) as before
  from placed
), drawn as (select *, whole + case when before < part then 1 else 0 end as epochs from summed)
select doc_id, lang, source, cast(e as bigint) as mix_epoch, cast(tokens as bigint) as mix_tokens
from (select *, unnest(range(0, cast(epochs as bigint))) as e from drawn)
"""

OP9 = rf"""
with w as (
  select doc_id, source, coalesce(text, '') as t, {_WORDS} as ws from documents
), spans as (
  select doc_id, i, count(*) over (partition by doc_id, span) as n from (
    select doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') as span
    from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5))
), gaps as (
  select doc_id, least(5, coalesce(lead(i) over (partition by doc_id order by i) - i, 5)) as g from spans where n > 1
), repeats as (select doc_id, sum(g) as n_repeat_words from gaps group by doc_id
), lines as (
  select doc_id, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls from w
), measured as (
  select w.doc_id, source, cast(len(ws) as bigint) as n_words,
    cast(coalesce(length(array_to_string(ws, '')), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, len(ls) as n_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from w join lines using (doc_id) left join repeats using (doc_id)
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured
), failures as (
  select source, unnest([
    {{'kind': 'few_words', 'f': n_words < 10}}, {{'kind': 'repeats', 'f': 100 * n_repeat_words > 20 * n_words}},
    {{'kind': 'symbols', 'f': 100 * n_symbols > 10 * word_chars}}, {{'kind': 'dup_lines', 'f': 100 * n_dup_lines > 30 * n_lines}},
    {{'kind': 'word_length', 'f': word_chars < 2 * n_words or word_chars > 15 * n_words}}], recursive := true)
  from judged where source is not null
), hosts as (
  select kind, source, count(*) as n, sum(cast(f as int)) as failed from failures group by kind, source
), moments as (
  select kind, avg(failed / n) as m, var_pop(failed / n) as v from hosts group by kind
), prior as (
  select kind, m, greatest(1.0, least(1e6, case when v > 0 then m * (1 - m) / v - 1 else 1e6 end)) as s from moments
), limits as (
  select kind, m, s, least(0.5, greatest(0.3, m + 3 * sqrt(m * (1 - m) / (s + 1)))) as most from prior
), verdicts as (
  select source, bool_and((failed + m * s) / (n + s) <= most) as ok from hosts join limits using (kind) group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(ok, true) as kept
from judged left join verdicts using (source)
"""


OP8 = rf"""
with docs as (
  select row_number() over () as row, doc_id, {_WORDS} as ws from documents
), starts as (
  select row, i, count(*) over (partition by span) as n from (
    select row, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) as span
    from (select row, ws, unnest(range(1, len(ws) - 33)) as i from docs where len(ws) >= 35))
), covered as (
  select distinct row, unnest(range(i, i + 35)) as i from starts where n > 1
), placed as (
  select row, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from docs
), kept as (
  select row, count(*) as n, string_agg(word, ' ' order by i) as kept
  from placed anti join covered using (row, i) group by row
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from docs left join kept using (row)
"""


def _normal_words(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"[x for x in string_split_regex({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']"


OP11 = f"""
with docs as (
  select row_number() over () as row, doc_id, {_normal_words("text")} as ws from documents
), items as (
  select cast(item_id as varchar) as item, {_normal_words("text")} as ws from benchmark
), patterns as (
  select distinct item, least(10, len(ws)) as size, array_to_string(list_slice(ws, i, i + 9), ' ') as pattern
  from (select item, ws, unnest(range(1, greatest(2, len(ws) - 8))) as i from items where len(ws) > 0)
), windows as (
  select row, i, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') as pattern from (
    select row, ws, size, unnest(range(1, len(ws) - size + 2)) as i
    from docs, (select distinct size from patterns) where len(ws) >= size)
), found as (select row, i, size, item from windows join patterns using (size, pattern)
), hit as (
  select row, count(distinct place) as n_hit from (select row, unnest(range(i, i + size)) as place from found) group by row
), listed as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct row, item from found where item is not null) group by row
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (row) left join listed using (row)
"""


def _crc32(keys: str) -> str:
    """Common table expressions up to ``crcs`` (key, crc): the CRC-32 of each ASCII ``key``
    of a query; for WITH RECURSIVE."""
    return f"""
bits as (
  select i, i as c, 0 as step from range(256) t(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from bits where step < 8
), bytes as (select i, c from bits where step = 8
), reading as (
  select key, 1 as place, cast(4294967295 as bigint) as crc from ({keys})
  union all select key, place + 1, xor(crc >> 8, bytes.c)
  from reading join bytes on bytes.i = xor(crc, cast(ascii(substr(key, place, 1)) as bigint)) & 255 where place <= length(key)
), crcs as (select key, xor(crc, 4294967295) as crc from reading where place = length(key) + 1
)"""


#: The state behind a user or assistant row, and the states that a kept row leads to.
_NEXT = (2, 2, 3, 2)
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def _way(left: str, to: int, cost: str, letters: str, rows: str) -> str:
    to_ = f"{left}[{to + 1}]"
    return f"{{'c': {cost} + {to_}.c, 'a': '{letters}' || {to_}.a, 'r': {rows} || {to_}.r}}"


def _made(state: int) -> str:
    return f"'{'assistant' if state == 2 else 'user'}:'"


def _used(state: int) -> str:
    """The cheapest edit of a row from a state, least of equals; left: what follows."""
    ways = [_way("b", state, "4", "D", "''")]
    for head, to in _KEPT[state].items():
        ways.append(f"case when stays and head = '{head}' then {_way('b', to, 'cut', 'K', 'role || chr(58) || text || chr(10)')} end")
    again = _way("b", _NEXT[state], "3 + cut", "R", f"{_made(state)} || text || chr(10)")
    return f"list_min([{', '.join(ways)}, case when stays then {again} end])"


def _with_insertions(state: int) -> str:
    one, two = _NEXT[state], _NEXT[_NEXT[state]]
    rows = f"{_made(state)} || chr(10)"
    both = f"{rows} || {_made(one)} || chr(10)"
    return f"list_min([m[{state + 1}], {_way('m', one, '3', 'I', rows)}, {_way('m', two, '6', 'II', both)}])"


OP12 = rf"""
with recursive {_crc32("select distinct coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations")},
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, crc % 20 as kind
    from conversations join crcs on key = coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')
  ) where kind <> 0
), ordered as (
  select *, substr(role, 1, 1) as head, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from damaged
), faults as (
  select *, lag(head) over (partition by conv_id order by n) as before,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from ordered
), rows as (
  select conv_id, n, role, text, head, fault in ('truncated', '') as stays, case when fault = 'truncated' then 3 else 0 end as cut from faults
), best as (
  select conv_id, max(n) + 1 as n, [
    {{'c': 0, 'a': '', 'r': ''}},
    {{'c': 6, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:' || chr(10)}},
    {{'c': 3, 'a': 'I', 'r': 'assistant:' || chr(10)}},
    {{'c': 0, 'a': '', 'r': ''}}] as b
  from rows group by conv_id
  union all
  select conv_id, n, [{", ".join(_with_insertions(s) for s in range(4))}] as b
  from (
    select rows.conv_id, rows.n, [{", ".join(_used(s) for s in range(4))}] as m
    from best join rows on rows.conv_id is not distinct from best.conv_id and rows.n = best.n - 1
  )
), figures as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, sum(cast(fault = 'blank' as int)) as blank,
    sum(cast(fault = 'duplicate' as int)) as duplicate, sum(cast(fault = 'truncated' as int)) as truncated,
    sum(cast(before is not null and before || head not in ('su', 'ua', 'au') as int)) as illegal
  from faults group by conv_id
), convs as (select distinct conv_id from conversations)
select convs.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(b[1].c, 0) as bigint) as cost, coalesce(b[1].a, '') as audit,
  sha256(coalesce(left(b[1].r, greatest(length(b[1].r) - 1, 0)), '')) as repaired_sha256
from convs left join figures on figures.conv_id is not distinct from convs.conv_id
  left join best on best.conv_id is not distinct from convs.conv_id and best.n = 1
"""

# A run's windows of eight words are found again one period on: at least 16 words of it
# have an equal word there. So stretches of such windows, by distance, are its candidates;
# one inside another of a smaller distance has that as its period.
OP13 = rf"""
with recursive {_crc32("select distinct cast(doc_id as varchar) as key from documents where doc_id is not null")},
docs as (
  select row_number() over () as row, doc_id, ws, len(ws) as n, crc % 10 = 0 and len(ws) > 0 as planted,
    case when len(ws) > 0 then (crc // 10) % len(ws) end as a, 3 + (crc // 10) % 8 as turns
  from (select doc_id, {_WORDS} as ws from documents) left join crcs on key = cast(doc_id as varchar)
), words as (
  select row, i, ws[1 + case when planted and i >= a then a + (i - a) % (1 + (n - a) // turns) else i end] as word
  from (select *, unnest(range(n)) as i from docs)
), texts as (select row, list(word order by i) as ws from words group by row
), grams as (
  select row, i, md5(array_to_string(list_slice(ws, i + 1, i + 8), ' ')) as gram
  from (select row, ws, unnest(range(len(ws) - 7)) as i from texts where len(ws) >= 24)
), again as (
  select x.row, x.i, y.i - x.i as q from grams x join grams y on x.row = y.row and x.gram = y.gram and x.i < y.i
), stretches as (
  select row, min(i) as start, count(*) + 7 + q as length, q as period
  from (select *, i - row_number() over (partition by row, q order by i) as island from again)
  group by row, q, island having count(*) + 7 + q >= greatest(24, 3 * q)
), runs as (
  select * from stretches s where not exists (
    select 1 from stretches t where t.row = s.row and t.period < s.period
      and t.start <= s.start and t.start + t.length >= s.start + s.length)
), told as (
  select row, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by row
), greatest_runs as (
  select * from runs qualify row_number() over (partition by row order by length / cast(period as double) desc, start, period) = 1
), dropped as (
  select distinct row, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select row, string_agg(word, ' ' order by i) as kept from words anti join dropped using (row, i) group by row
)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(start as bigint) as start, cast(length as bigint) as length,
  cast(period as bigint) as period, cast(1000 * length // period as bigint) as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from docs left join told using (row) left join greatest_runs using (row) left join kept using (row)
"""

ORACLE: dict[str, str] = {
    "op3_chat_format": OP3,
    "op4_source_mix": OP4,
    "op8_substring_dedup": OP8,
    "op9_quality_rules": OP9,
    "op11_decontamination": OP11,
    "op12_conversation_repair": OP12,
    "op13_periodic_runs": OP13,
}
