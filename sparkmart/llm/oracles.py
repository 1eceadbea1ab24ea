"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from sparkmart.llm import oracles_more

# The kinds of secrets, and where the part that must be long begins.
_SECRETS = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"""
        r"""[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
    "github": ("gh[pousr]_([A-Za-z0-9]+)", 1, 36),
    "slack": ("xox[abprs]-([A-Za-z0-9-]+)", 1, 10),
    "google": ("AIza([A-Za-z0-9_-]+)", 1, 35),
    "private_key": ("-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY(-+)", 2, 5),
}


def _secrets() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    kinds = []
    for place, (kind, (pattern, group, least)) in enumerate(_SECRETS.items()):
        p = quoted(pattern)
        kinds.append(
            f"""select doc_id, {place} as place, '{kind}' as kind,
  regexp_split_to_array(body, {p}) as gaps, regexp_extract_all(body, {p}) as found,
  regexp_extract_all(body, {p}, {group}) as part, {least} as least from texts"""
        )
    union = "\nunion all\n".join(kinds)
    return f"""
with texts as (
  select doc_id, coalesce(text, '') as body from documents
), cut as (
{union}
), every as (
  select doc_id, place, kind, least, unnest(range(1, len(found) + 1)) as i, found, gaps, part
  from cut where len(found) > 0
), spans as (
  select doc_id, place, kind,
    list_sum(list_transform(gaps[:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) as low,
    length(found[i]) as size
  from every where length(part[i]) >= least
), rows as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign,
    count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || cast(low as bigint) || ':' || cast(low + size as bigint), ','
      order by low, place) filter (place < 3) as base,
    string_agg(kind || ':' || cast(low as bigint) || ':' || cast(low + size as bigint), ','
      order by low, place) as spans
  from spans group by doc_id
)
select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from texts t left join rows r on t.doc_id = r.doc_id
"""


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _decontaminate() -> str:
    return f"""
with docs as (
  select doc_id, {_WORDS} as words from documents
), items as (
  select item_id, {_WORDS} as words from benchmark
), windows as (
  select item_id, unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1),
    lambda i: words[i:i + 9])) as part
  from items where len(words) > 0
), sizes as (
  select distinct len(part) as n from windows
), starts as (
  select doc_id, n, unnest(range(1, len(words) - n + 2)) as i, words
  from docs, sizes where len(words) >= n
), found as (
  select s.doc_id, s.i, s.n, w.item_id
  from starts s join windows w on s.words[s.i:s.i + s.n - 1] = w.part
), hit as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as place from found) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit h on d.doc_id = h.doc_id left join named m on d.doc_id = m.doc_id
"""


def _minhash() -> str:
    return r"""
with recursive texts as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents
), sets as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5
      then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i:i + 4], ' '))) end as items
  from texts
), items as (
  select doc_id, len(items) as n, unnest(items) as item from sets
), shared as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny,
    count(*) as common
  from items a join items b on a.item = b.item and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id
), links as (
  select x, y from shared where 100 * common >= 75 * (nx + ny - common)
), ways as (
  select x, y from links union select y, x from links
), reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, w.y from reach r join ways w on r.y = w.x
), named as (
  select x, min(y) as component_id from reach group by x
)
select s.doc_id, len(s.items) as n_shingles, n.component_id,
  s.doc_id = n.component_id as kept
from sets s join named n on s.doc_id = n.x
"""


def _chat() -> str:
    def shown(column: str, more: str = "") -> str:
        return (
            rf"case when regexp_matches({column}, '<\|[^|]*\|>|<\\+\|{more}') "
            rf"then regexp_replace({column}, '<(\\*)\|', '<\\\1|', 'g') else {column} end"
        )

    role = f"replace({shown('role', '|' + chr(92) + 'n')}, chr(10), '<|nl|>')"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all
  select -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  from (values (0, 'user'), (1, 'assistant')) t(turn, role)
), written as (
  select *, '<|im_start|>' || {role} || chr(10) || ({shown("text")}) || '<|im_end|>' || chr(10)
    as formatted
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, formatted))
    as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, formatted)
    filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(formatted)) as bigint) as formatted_chars
from written group by conv_id
"""


def _embeddings() -> str:
    return """
with recursive every as (
  select vec_id, cast(embedding as double[]) as e from embeddings
), good as (
  select vec_id, e from every
  where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as x, b.vec_id as y from good a, good b
  where a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9
), reach as (
  select vec_id as x, vec_id as y from every
  union
  select r.x, l.y from reach r join links l on r.y = l.x
), named as (
  select x, min(y) as component_id from reach group by x
), counted as (
  select x, count(*) as n from links group by x
)
select e.vec_id, coalesce(c.n, 0) as n_links, n.component_id,
  e.vec_id = n.component_id as kept
from every e join named n on e.vec_id = n.x left join counted c on e.vec_id = c.x
"""


def _kept_share(by: str, power: float, budget: float, steps: int = 12) -> str:
    """``target_<by>``: the tokens to be kept of each value, at most those that it has."""
    parts = [
        f"""parts_{by} as materialized (
  select {by}, sum(n) as seen, pow(sum(n), {power}) / sum(pow(sum(n), {power})) over () as part,
    {budget} * sum(sum(n)) over () as goal
  from cells group by {by}
), scale0_{by} as (
  select min(goal) as x from parts_{by}
)"""
    ]
    for i in range(steps):
        parts.append(
            f"""scale{i + 1}_{by} as materialized (
  select greatest(min(x), coalesce((min(goal) - sum(case when part * x >= seen then seen
    else 0 end)) / nullif(sum(case when part * x < seen then part else 0 end), 0), min(x))) as x
  from parts_{by}, scale{i}_{by}
)"""
        )
    parts.append(
        f"""target_{by} as materialized (
  select {by}, least(seen, part * x) as goal from parts_{by}, scale{steps}_{by}
)"""
    )
    return ", ".join(parts)


def _mix(rounds: int = 400, measured: int = 8, budget: float = 0.8) -> str:
    """Temperatures 0.7 for source and language, 1 for topic; cells count up to their tokens.

    Fitting ends at the first multiple of ``measured`` rounds that meets all targets.
    """
    misses = " union all ".join(
        f"""select k, abs(sum(least(w, n)) / min(goal_{by}) - 1) as off
    from measured group by k, {by}"""
        for by in "slt"
    )
    return (
        r"""with recursive described as (
  select doc_id, source, lang, coalesce(text, '') as body,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'),
      lambda w: w <> '')) as n
  from documents
), docs as (
  select doc_id, source, lang, n, coalesce(source, '') as s, coalesce(lang, '') as l,
    case when contains(body, 'Licensed under') or contains(body, 'Released under')
        or contains(body, 'All rights reserved') or contains(body, 'Copyright') then 'legal'
      when contains(body, '@') then 'contact' when contains(body, ' | ') then 'table'
      when n < 100 then 'short' when n > 1000 then 'long' else 'prose' end as t
  from described
), cells as materialized (
  select s, l, t, sum(n)::double as n from docs where n > 0 group by all
), """
        + ", ".join(
            _kept_share(by, power, budget) for by, power in (("s", 0.7), ("l", 0.7), ("t", 1.0))
        )
        + f""", fit as (
  select 0 as k, s, l, t, n, n as w, a.goal as goal_s, b.goal as goal_l, c.goal as goal_t
  from cells join target_s a using (s) join target_l b using (l) join target_t c using (t)
  union all
  select k + 1, s, l, t, n, w * max(factor) over (partition by v), goal_s, goal_l, goal_t
  from (
    select *, (goal - (sum(n) over (partition by v) - sum(n) over upto))
      / nullif(sum(w) over upto, 0) as factor
    from (
      select *, case k % 3 when 0 then s when 1 then l else t end as v,
        case k % 3 when 0 then goal_s when 1 then goal_l else goal_t end as goal
      from fit where k < {3 * rounds}
    )
    window upto as (partition by v order by w / n, s, l, t rows unbounded preceding)
  )
), measured as materialized (
  select * from fit where k > 0 and k % {3 * measured} = 0
), misses as (
  select k, max(off) as off from ({misses}) group by k
), chances as (
  select s, l, t, least(w, n) / n as p from measured
  where k = (select min(k) from misses where off <= 1e-6)
), drawn as (
  select d.*, case when n > 0 then coalesce(p, 0) else 0 end as p,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
      / 4294967296.0 as place
  from docs d left join chances c on d.s = c.s and d.l = c.l and d.t = c.t
)
select doc_id, source, lang, t as topic, n as n_tokens, round(p::double, 6) as probability,
  place < p as kept
from drawn"""
    )


def build() -> dict[str, str]:
    return {
        "op1_embeddings": _embeddings(),
        "op2_decontaminate": _decontaminate(),
        "op5_mix": _mix(),
        "op7_chat": _chat(),
        "op9_minhash": _minhash(),
        "op10_secrets": _secrets(),
        **oracles_more.build(),
    }
