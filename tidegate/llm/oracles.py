"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidegate.llm.licences import DIGESTS, KNOWN

# What counts as one word, what stands between words, and which lines name a holder, stated anew.
_SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("version", "v"), ("v2", "v 2"), ("v3", "v 3"),
    ("non commercial", "noncommercial"), ("share alike", "sharealike"), ("sub license", "sublicense"),
    ("merchantibility", "merchantability"), ("noninfringment", "noninfringement"),
    ("organisation", "organization"), ("authorised", "authorized"),
)
_GAPS = r"[^\p{L}\p{N}]+"
_HOLDER = (
    r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*$"
    r"|^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op4() -> str:
    def same(words: str) -> str:
        out = f"trim({words})"
        for found, put in _SPELLINGS:
            out = f"regexp_replace({out}, '\\b{found}\\b', '{put}', 'g')"
        return out

    def form(text: str) -> str:
        return same(f"regexp_replace({text}, {_quoted(_GAPS)}, ' ', 'g')")

    def lowered(text: str) -> str:
        return f"regexp_replace(lower(coalesce({text}, '')), {_quoted(_HOLDER)}, ' ', 'g')"

    values = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in KNOWN)
    digests = ", ".join(f"({_quoted(k)}, {_quoted(d)})" for k, d in DIGESTS)
    return f"""
with known as (
  select digest, min(licence) as licence
  from (select licence, sha256({form(lowered("text"))}) as digest from (values {values}) v(licence, text)
    union all select * from (values {digests}) d(licence, digest)) group by digest),
docs as (select doc_id, {lowered("text")} as body from documents),
lines as (select doc_id, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) - 1 as line_no from docs),
notices as (
  select doc_id, count(*) as n, string_agg(line_no || ':' || licence, ',' order by line_no) as notices
  from (select doc_id, line_no, sha256({form("line")}) as digest from lines) join known using (digest) group by doc_id),
whole as (select doc_id, licence from (select doc_id, sha256({form("body")}) as digest from docs) join known using (digest))
select doc_id, coalesce(licence, '') as whole_licence, coalesce(n, 0) as n_notices, coalesce(notices, '') as notices
from docs left join whole using (doc_id) left join notices using (doc_id)"""


_OP5 = r"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
word as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as i from split),
windows as (
  select doc_id, i, sha256(array_to_string(words[i : i + 34], ' ')) as h
  from (select doc_id, words, unnest(range(1, len(words) - 33)) as i from split)),
again as (select h from windows group by h having count(*) > 1),
starts as (select doc_id, i from windows semi join again using (h)),
marked as (
  select doc_id, i, word,
    count(starts.i) over (partition by word.doc_id order by word.i rows between 34 preceding and current row) > 0 as gone
  from word left join starts using (doc_id, i)),
kept as (
  select doc_id, count_if(gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept
  from marked group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from split left join kept using (doc_id)"""

_OP10 = r"""
with norm as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
item as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
windows as (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[i : i + 9], ' ') as key
  from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from item where len(words) > 0)),
sizes as (select distinct n from windows),
places as (
  select doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') as key
  from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from norm, sizes)),
found as (select doc_id, places.n, i, item_id from places join windows on places.n = windows.n and places.key = windows.key),
hit as (
  select doc_id, count(distinct word_no) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as word_no from (select distinct doc_id, n, i from found)) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from norm left join hit using (doc_id) left join items using (doc_id)"""


def _op12(levels: int = 6, top_levels: int = 3) -> str:
    """Trees level by level, for sources of up to 16**levels rows and up to 16**top_levels sources."""

    def leaf(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        fields = [f"case when {v} is null then '-' else strlen({v}::varchar) || ':' || {v}::varchar end" for v in values]
        return f"sha256({' || '.join(fields)})"

    def tree(name: str, group: str, leaves: str, depth: int) -> str:
        """Nodes of each level with what lies left and right of them in their run."""
        parts = [f"{name}0 as ({leaves})"]
        for k in range(depth):
            parts.append(
                f"""{name}{k + 1} as (select {group}, i // 16 as i, sha256(string_agg(h, '' order by i)) as h, any_value((c + 15) // 16) as c
  from {name}{k} where c > 1 group by {group}, i // 16),
{name}_sides{k} as (select {group}, i,
    coalesce(string_agg(h, '') over (run rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') over (run rows between 1 following and unbounded following), '') as r
  from {name}{k} where c > 1 window run as (partition by {group}, i // 16 order by i))"""
            )
        ends = " union all ".join(f"select {group}, h from {name}{k} where c = 1" for k in range(depth + 1))
        return ",\n".join([*parts, f"{name}_root as ({ends})"])

    def fold(name: str, group: str, before: str, depth: int, at: str) -> tuple[str, str]:
        parts = []
        for k in range(depth):
            parts.append(
                f"""{name}_fold{k} as (select d.* exclude (folded, proof),
    case when s.i is null then folded else sha256(l || folded || r) end as folded,
    proof || coalesce(l || r, '') as proof
  from {before} d left join {name}_sides{k} s on s.{group} is not distinct from d.{group} and s.i = d.{at} // {16**k})"""
            )
            before = f"{name}_fold{k}"
        return ",\n".join(parts), before

    crc_byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295::bigint] || [ascii(x)::bigint for x in string_split(doc_id::varchar, '')], lambda c, b: {crc_byte}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    low, after_low = fold("low", "source", "marked", levels, "place")
    top, after_top = fold("top", "one", "placed", top_levels, "rank")
    leaves = "select source, place as i, leaf as h, count(*) over (partition by source) as c from marked"
    return f"""
with marked as (
  select doc_id, source, 1 as one, row_number() over (partition by source order by doc_id) - 1 as place, {leaf("text")} as leaf,
    case when {crc} % 5 = 0 then {leaf(lowered)} else leaf end as folded, '' as proof
  from documents),
{tree("low", "source", leaves, levels)},
ranked as (select source, 1 as one, h, row_number() over (order by source nulls first) - 1 as rank from low_root),
{tree("top", "one", "select one, rank as i, h, count(*) over () as c from ranked", top_levels)},
{low},
placed as (
  select d.*, ranked.h as subroot, ranked.rank as rank from {after_low} d join ranked on ranked.source is not distinct from d.source),
{top}
select doc_id, leaf, subroot, top_root.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = top_root.h as verified
from {after_top}, top_root"""


def llm_oracles() -> dict[str, str]:
    return {"op4_licences": _op4(), "op5_lempel_ziv": _OP5, "op10_decontaminate": _OP10, "op12_merkle": _op12()}
