"""DuckDB statements for spelling variants, conversation repair and page texts."""

from __future__ import annotations

#: For each byte, what the CRC-32 checksum becomes by it; made from the polynomial.
_BYTES = """bytes as materialized (
  select i, list_reduce([i::bigint, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as made
  from range(256) as r(i)
)"""


def _checksums(source: str) -> str:
    """``checksums`` (key, h) for ``source`` (key, bits: a text's UTF-8 in hexadecimal)."""
    return f"""{_BYTES},
read as (
  select key, bits, 1 as k, 4294967295::bigint as c from {source}
  union all
  select key, bits, k + 2, xor(made, c >> 8)
  from read join bytes on i = xor(c, ('0x' || substr(bits, k, 2))::bigint) & 255
  where k < length(bits)
), checksums as (
  select key, xor(c, 4294967295::bigint) as h from read where k > length(bits)
)"""


_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spelling() -> str:
    return f"""with recursive runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'),
    '[a-zÀ-ÿ]+')) as run
  from documents where text is not null
), per_doc as materialized (
  select run, count(*) as n, hex(coalesce(doc_id::varchar, '') || ':' || run) as bits,
    row_number() over () as key
  from runs group by doc_id, run
), {_checksums("per_doc")}, summed as (
  select run, n, h from per_doc join checksums using (key)
), words as materialized (
  select word, sum(n)::bigint as n from (
    select n, case when h % 199 = 0 then left(run, h % length(run))
      || substr(run, h % length(run) + 2) else run end as word from summed)
  where length(word) >= 6 group by word having sum(n) >= 5
), shorter as materialized (
  select word, i, left(word, i) || substr(word, i + 2) as rest
  from (select word, unnest(range(length(word))) as i from words)
), near as materialized (
  select distinct a.word as a, b.word as b from shorter a join shorter b
    on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select s.word, w.word from shorter s join words w on s.rest = w.word
  union select w.word, s.word from shorter s join words w on s.rest = w.word
), best as (
  select a as word, count(*) as n_near, min({{'less': -n, 'word': b}}) as top
  from near join words on word = b group by a
), forms as materialized (
  select w.word, n, coalesce(n_near, 0) as n_near,
    case when -top.less >= 5 * n then top.word end as form,
    case when -top.less >= 5 * n then -top.less end as form_n
  from words w left join best using (word)
), chain as (
  select word, word as at from forms
  union all select chain.word, forms.form from chain join forms on chain.at = forms.word
  where forms.form is not null
)
select f.word, f.form, c.at as root, f.n, f.n_near::bigint as n_near,
  f.form_n::bigint as form_n
from forms f join chain c on c.word = f.word
  join forms e on e.word = c.at and e.form is null"""


_STATES = "0sua"
_AFTER = {"0": "u", "s": "u", "u": "a", "a": "u"}
_NAMES = {"u": "user", "a": "assistant"}


def _put(edit: str, cost: str, before: str, line: str | None = None) -> str:
    """A way to the end with one more edit in front of the way ``before``."""
    rest = f"{before}.rest"
    if line:
        rest = f"list_prepend({line}, {before}.rest)"
    return f"""case when {before} is not null then
      {{'cost': {before}.cost + {cost}, 'audit': '{edit}' || {before}.audit, 'rest': {rest}}} end"""


def _inserted(name: str, source: str) -> str:
    """Each state's cheapest way when one more turn may be inserted first."""
    ways = []
    for state in _STATES:
        then = _AFTER[state]
        more = _put("I", "3", f"w{then}", f"'{_NAMES[then]}:'")
        ways.append(f"case when w{state} is null then {more} else least(w{state}, {more}) end as w{state}")
    return f"{name} as (select * exclude ({', '.join('w' + s for s in _STATES)}), {', '.join(ways)} from {source})"


def _repair() -> str:
    steps = []
    for state in _STATES:
        then = _AFTER[state]
        ways = [_put("D", "4", f"w{state}")]
        go = "not must_go"
        ways.append(
            f"case when {go} then {_put('R', '3 + more', 'w' + then, repr(_NAMES[then] + ':') + ' || text')} end"
        )
        ways.append(
            f"case when {go} and initial = '{then}' then {_put('K', 'more', 'w' + then, 'role || chr(58) || text')} end"
        )
        if state == "0":
            ways.append(
                f"case when {go} and initial = 's' then {_put('K', 'more', 'ws', 'role || chr(58) || text')} end"
            )
        steps.append(f"least({', '.join(ways)}) as w{state}")
    ended = """select conv_id, n as i, {'cost': 0::bigint, 'audit': '', 'rest': []::varchar[]} as w0,
      null as ws, null as wu, {'cost': 0::bigint, 'audit': '', 'rest': []::varchar[]} as wa"""
    white = r"[\x20\x09-\x0D]"
    return rf"""with recursive shown as materialized (
  select row_number() over () as key, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    hex(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')) as bits
  from conversations
), {_checksums("shown")}, ruled as materialized (
  select shown.*, h % 20 as rule from shown join checksums using (key)
), damaged as (
  select conv_id, turn, case when rule = 4 then 'user' else role end as role,
    case rule when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case rule when 0 then 0 when 3 then 2 else 1 end)) as copy
  from ruled
), placed as (
  select *, row_number() over (partition by conv_id
      order by turn nulls first, role, sha256(text), copy) - 1 as i,
    count(*) over (partition by conv_id) as n,
    left(role, 1) as initial,
    row_number() over (partition by conv_id, role, text
      order by turn nulls first, copy) > 1 as again,
    regexp_replace(text, '{white}+$', '') as trimmed
  from damaged
), faults as materialized (
  select *, case when trimmed = '' then 'blank' when again then 'duplicate'
      when right(trimmed, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(initial) over (partition by conv_id order by i) as last
  from placed
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (last is not null and last || initial not in ('su', 'ua', 'au'))
      as illegal
  from faults group by conv_id
), coded as (
  select conv_id, n, i, role, text, initial, fault in ('blank', 'duplicate') as must_go,
    case fault when 'truncated' then 3 else 0 end as more
  from faults
), ended as ({ended} from (select distinct conv_id, n from coded)
), {_inserted("ended_once", "ended")}, {_inserted("ended_twice", "ended_once")},
ways as (
  select * from ended_twice
  union all (
    with step as (
      select w.conv_id, c.i, {", ".join(steps)}
      from ways w join coded c on c.conv_id is not distinct from w.conv_id and c.i = w.i - 1
    ), {_inserted("once", "step")}, {_inserted("twice", "once")}
    select * from twice
  )
), cheapest as (
  select conv_id, w0.cost as cost, w0.audit as audit,
    sha256(array_to_string(w0.rest, chr(10))) as repaired_sha256
  from ways where i = 0
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
  coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
  left join counted c on c.conv_id is not distinct from o.conv_id
  left join cheapest d on d.conv_id is not distinct from o.conv_id"""


# References of the HTML standard that the given pages use.
_REFERENCES = (
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;", "''"),
    ("&copy;?", "©"),
    ("&middot;?", "·"),
    ("&amp;?", "&"),
)


def _pages() -> str:
    """For pages that mark their article and hold nothing but its blocks there."""
    shown = r"regexp_replace(block, '<[^>]*>', '', 'g')"
    for pattern, letter in _REFERENCES:
        shown = f"regexp_replace({shown}, '{pattern}', '{letter}', 'g')"
    return rf"""with cut as (
  select page_id, url, row_number() over () as page, regexp_split_to_array(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1),
    '</?(p|h1)>') as blocks
  from pages
), shown as (
  select page_id, url, list_filter(list_transform(blocks, lambda block:
    trim(regexp_replace({shown}, '\s+', ' ', 'g'))), lambda b: b <> '') as blocks
  from cut
)
select page_id, url, array_to_string(blocks, chr(10) || chr(10)) as text,
  length(array_to_string(blocks, chr(10) || chr(10))) as n_chars
from shown"""


def build() -> dict[str, str]:
    return {
        "op11_spelling": _spelling(),
        "op12_repair": _repair(),
        "op13_pages": _pages(),
    }
