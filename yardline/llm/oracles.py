"""The same results as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from yardline.llm import quality_rules as rules
from yardline.llm.decontaminate import MIN_PERCENT, MIN_WORDS
from yardline.llm.merkle import FAN

_SEP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


def _dense(column: str) -> str:
    return f"length(regexp_replace({column}, '{_SEP}', '', 'g'))"


def _count(column: str, characters: str) -> str:
    return f"(length({column}) - length(translate({column}, '{characters}', '')))"


_PHRASES = " or ".join(f"contains(lower(x), '{p}')" for p in rules.BOILERPLATE)
_FAILS = f"""regexp_matches(x, '{_WORD}') and (
    100 * {_count('x', rules.MARKS)} > {rules.MAX_MARK_PERCENT} * {_dense('x')}
    or (x = upper(x) and x <> lower(x) and {_count('x', ' ')} >= {rules.MIN_SHOUTED_WORDS - 1})
    or {_count('x', rules.MENU_MARKS)} >= {rules.MIN_MENU_MARKS}
    or {_PHRASES})"""

QUALITY_RULES = f"""
with b as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws,
         string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as x from b),
failing as (
  select doc_id, count(*) as n_failed_lines, cast(sum({_dense('x')}) as bigint) as lost_chars
  from lines where {_FAILS} group by doc_id),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from b),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as k from starts),
repeats as (
  select doc_id, count(distinct j) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as j from windows where k > 1) group by doc_id),
s as (
  select doc_id, cast(len(ws) as bigint) as n_words, cast({_dense('t')} as bigint) as word_chars,
         cast({_count('t', rules.SYMBOLS)} as bigint) as n_symbols,
         cast(len(list_filter(ls, lambda x: regexp_matches(x, '{_WORD}')))
              - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '{_WORD}')))) as bigint) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_failed_lines, 0) as n_failed_lines,
         coalesce(lost_chars, 0) as lost_chars
  from b left join repeats using (doc_id) left join failing using (doc_id))
select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed,
       not (n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
       and 100 * lost_chars <= {rules.MAX_LOST_PERCENT} * word_chars as kept
from s"""

CHAT_FORMAT = """
with rows_ as (
  select distinct conv_id, turn, coalesce(nullif(lower(trim(role)), ''), 'user') as role,
         coalesce(text, '') as text from conversations),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as position from rows_),
whole as (
  select conv_id, count(*) as n_turns, list(role || chr(0) || text order by position) as turns from placed group by conv_id),
one as (select turns, n_turns, min(conv_id) as conv_id, count(*) as n_copies from whole group by turns, n_turns),
prefixes as (select distinct turns[1:n] as turns from (select turns, unnest(range(1, n_turns)) as n from one)),
kept as (select conv_id, n_turns, n_copies from one where not exists (select 1 from prefixes p where p.turns = one.turns))
select conv_id, cast((position - 1) // 1024 as bigint) as part, n_turns, n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by position) as text
from placed join kept using (conv_id) group by all"""

NEAR_DUPLICATES = f"""
with recursive b as (
  select doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{_WORD}'),
         lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as ws from documents),
shingles as (
  select distinct doc_id, [ws[i], ws[i + 1]] as s from (select doc_id, ws, unnest(range(1, len(ws))) as i from b where len(ws) > 1)
  union all select doc_id, ws from b where len(ws) = 1),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as k from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id
  group by all),
links as (
  select a, b from pairs join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * k >= 80 * (x.n + y.n - k)),
sym as (select a, b from links union all select b, a from links),
reach(v, u) as (select doc_id, doc_id from documents union select v, b from reach join sym on u = a)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join sizes using (doc_id)
join (select v, min(u) as component_id from reach group by v) c on c.v = d.doc_id"""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', 1 + ((cast('0x' || substr(h, {1 + 5 * group}, 5) as integer) >> {shift}) & 31), 1)"
    for group in range(8) for shift in (15, 10, 5, 0)
)
WARC = f"""
with b as (select page_id, sha1(coalesce(html, '')) as h, octet_length(encode(coalesce(html, ''))) as n from pages),
o as (select h, max(page_id) as top from b group by h)
select page_id, cast(n as bigint) as payload_bytes, {_BASE32} as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id = top then null else top end as refers_to
from b join o using (h)"""

_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
#: Every alignment with enough equal words, sought by joining words instead of seeds.
DECONTAMINATION = f"""
with d as (select doc_id, {_TOKENS} as ws from documents),
b as (select distinct item_id, {_TOKENS} as ws from benchmark),
dw as (select doc_id, len(ws) as n, unnest(range(len(ws))) as i, unnest(ws) as w from d),
iw as (select item_id, len(ws) as m, unnest(range(len(ws))) as j, unnest(ws) as w from b),
aligned as (
  select doc_id, item_id, i - j as shift, m, n, least(m, {MIN_WORDS}) as width, list(j) as js
  from dw join iw using (w) group by all having 100 * count(*) >= {MIN_PERCENT} * least(m, {MIN_WORDS})),
starts as (
  select *, unnest(range(greatest(0, -shift), least(m, n - shift) - width + 1)) as a from aligned),
good as (
  select doc_id, item_id, shift, js, unnest(range(a, a + width)) as covered from starts
  where 100 * len(list_filter(js, lambda x: x >= a and x < a + width)) >= {MIN_PERCENT} * width),
told as (
  select doc_id, item_id, shift, count(distinct covered) as n_words, cast(any_value(len(js)) as bigint) as n_equal
  from good group by doc_id, item_id, shift)
select doc_id, item_id, n_words, n_equal, cast(greatest(shift, 0) as bigint) as doc_word,
       cast(greatest(-shift, 0) as bigint) as item_word
from told qualify row_number() over (
  partition by doc_id, item_id order by n_words desc, n_equal desc, greatest(shift, 0), greatest(-shift, 0)) = 1"""

#: Unsigned crc32 of a text of decimal digits: each byte goes in by eight shifts.
_POLYNOMIAL = 0xEDB88320
_CRC32 = f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ord(c)::bigint)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda b, i: xor(b >> 1, {_POLYNOMIAL} * (b & 1)))), 4294967295::bigint)"""


def _merkle_field(value: str) -> str:
    return f"coalesce(octet_length(encode(cast({value} as varchar))) || ':' || cast({value} as varchar), '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_merkle_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


#: Enough for 8^12 rows and groups.
_HEIGHT = 12


def _merkle_tree(name: str, leaves: str) -> str:
    """Levels name_0, name_1, ... of (grp, pos, h, n) with the siblings before and after each node."""
    levels = [f"{name}_0 as ({leaves})"]
    for k in range(_HEIGHT):
        run = f"partition by grp, pos // {FAN} order by pos"
        levels.append(
            f"""{name}_s{k} as (select *,
              case when n > 1 then coalesce(string_agg(h, '') over ({run} rows between unbounded preceding and 1 preceding), '') else '' end as before,
              case when n > 1 then coalesce(string_agg(h, '') over ({run} rows between 1 following and unbounded following), '') else '' end as after
              from {name}_{k})"""
        )
        levels.append(
            f"""{name}_{k + 1} as (select grp, pos // {FAN} as pos,
              case when n > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h,
              cast(ceil(n / {FAN}) as bigint) as n from {name}_s{k} group by grp, pos // {FAN}, n)"""
        )
    return ",\n".join(levels)


def _steps(name: str) -> str:
    """Every leaf's siblings, level by level."""
    joins = " ".join(
        f"join {name}_s{k} s{k} on s{k}.grp is not distinct from l.grp and s{k}.pos = l.pos // {FAN**k}" for k in range(1, _HEIGHT)
    )
    listed = ", ".join(f"{{'b': s{k}.before, 'a': s{k}.after, 'up': s{k}.n > 1}}" for k in range(1, _HEIGHT))
    return f"select l.grp, l.pos, l.h, [{{'b': l.before, 'a': l.after, 'up': l.n > 1}}, {listed}] as steps from {name}_s0 l {joins}"


MERKLE_MANIFEST = f"""
with d as (
  select doc_id, lang, {_merkle_leaf('text')} as leaf,
         case when {_CRC32} % 3 = 0
              then {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as changed
  from documents),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from d),
{_merkle_tree('g', 'select lang as grp, pos, leaf as h, n from placed')},
{_merkle_tree('t', f"select '' as grp, row_number() over (order by encode(grp) nulls first) - 1 as pos, h, count(*) over () as n from g_{_HEIGHT}")},
inner_ as ({_steps('g')}),
outer_ as ({_steps('t')}),
named as (select grp as lang, h as subroot, row_number() over (order by encode(grp) nulls first) - 1 as place from g_{_HEIGHT}),
whole as (
  select p.doc_id, p.leaf, p.changed, subroot, (select h from t_{_HEIGHT}) as root,
         list_filter(i.steps || o.steps, lambda s: s.up) as steps
  from placed p join inner_ i on i.grp is not distinct from p.lang and i.pos = p.pos
  join named on named.lang is not distinct from p.lang join outer_ o on o.pos = place),
told as (
  select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.b || s.a), '')) as proof_sha256,
         list_reduce(list_prepend({{'b': '', 'a': coalesce(changed, leaf), 'up': true}}, steps),
                     lambda x, s: {{'b': '', 'a': sha256(s.b || x.a || s.a), 'up': true}}).a as folded_root
  from whole)
select *, folded_root = root as verified from told"""

ORACLES = {
    "op3_chat_format": CHAT_FORMAT,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op5_decontamination": DECONTAMINATION,
    "op6_quality_rules": QUALITY_RULES,
    "op7_warc": WARC,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
