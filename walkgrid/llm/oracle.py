"""SQL texts of the queries that SQL can express, for DuckDB over the same tables."""

from walkgrid.llm.licences import NAMES, NOTICES, SPELLINGS, TEXTS

ORACLE: dict[str, str] = {}

_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE["op1_decontaminate"] = f"""
with bench as (select cast(item_id as varchar) item, {_WORDS} w from benchmark where text is not null),
windows as (select distinct item, least(len(w), 10) size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') s
  from bench, unnest(range(1, len(w) - least(len(w), 10) + 2)) u(i) where len(w) > 0),
docs as (select doc_id, coalesce({_WORDS}, []) w from documents),
places as (select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') s
  from docs, (select distinct size from windows) z, unnest(range(1, len(w) - size + 2)) u(i) where len(w) >= size),
hits as (select doc_id, item, i, p.size from places p join windows using (size, s)),
words as (select doc_id, count(distinct j) n from hits, unnest(range(i, i + size)) u(j) group by doc_id),
items as (select doc_id, count(*) n, string_agg(item, ',' order by item) ids from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(words.n, 0) n_hit, coalesce(items.n, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, words.n is not null contaminated
from docs d left join words using (doc_id) left join items using (doc_id)"""

ORACLE["op3_line_dedup"] = """
with lines as (select doc_id, source, text, pos, line from (select doc_id, source, text, string_split(text, chr(10)) ls from documents), unnest(ls) with ordinality u(line, pos)),
pages as (select source, count(*) pages from documents group by source),
counts as (select source, line, count(distinct doc_id) n from lines where trim(line) != '' group by source, line),
bad as (select source, line from counts join pages using (source) where n >= 5 and n > 0.1 * pages),
kept as (select l.doc_id, count(*) n_lines, count(b.line) n_dropped, coalesce(string_agg(l.line, chr(10) order by pos) filter (where b.line is null), '') t
  from lines l left join bad b on l.source = b.source and l.line = b.line group by l.doc_id)
select d.doc_id, d.source, coalesce(n_lines, 0) n_lines, coalesce(n_dropped, 0) n_dropped, length(t) kept_chars, sha256(t) kept_sha256
from documents d left join kept using (doc_id)"""

_ESCAPED = r"replace(text, '\', '\\')"
for _control in ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}\\{_control[1:]}')"

ORACLE["op6_chat"] = f"""
with turns as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') text from conversations
  union all select -7, i, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(i, r)),
ordered as (select *, lag(r) over (partition by conv_id order by turn, r, text) before from turns),
ok as (select *, (before is null and r in ('system', 'user')) or (before in ('system', 'assistant') and r = 'user') or (before = 'user' and r = 'assistant') step from ordered)
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || text || chr(10), '' order by turn, r, text)) turns_sha256,
  coalesce(sum(length(text)) filter (where r = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, r, text) filter (where r = 'assistant'), '')) loss_sha256,
  sum(length(case when r in ('system', 'user', 'assistant') then r else 'role ' || hex(r) end) + 5 + length({_ESCAPED}) + 8)::bigint formatted_chars,
  bool_and(step) valid, bool_and(step) and arg_max(r, struct_pack(a := turn, b := r, c := text)) = 'assistant' complete
from ok group by conv_id"""


def _normal(text: str) -> str:
    """The canonical form, by DuckDB's regular expressions."""
    low = f"lower({text})"
    for old, new in SPELLINGS.items():
        low = f"replace({low}, '{old}', '{new}')"
    low = rf"regexp_replace({low}, '(^|\n)[^\pL\pN\n\x{{a9}}]*(copyright|\x{{a9}})[^\n]*([12][0-9][0-9][0-9]|\(c\)|\x{{a9}}|<year>)[^\n]*', '\1 ', 'g')"
    return rf"trim(regexp_replace({low}, '[!-/:-@\[-`{{-~\x{{a9}}\x{{2013}}\x{{2014}}\x{{2018}}\x{{2019}}\x{{201c}}\x{{201d}}\t\r\n\v\f ]+', ' ', 'g'))"


_KNOWN = ", ".join("('" + a + "', '" + b.replace("'", "''") + "')" for a, b in [*TEXTS.items(), *((i, n.format(name)) for name, i in NAMES.items() for n in NOTICES)])
ORACLE["op8_licences"] = f"""
with known as (select {_normal("t")} norm, min(licence) licence from (values {_KNOWN}) v(licence, t) group by 1),
lines as (select doc_id, unnest(string_split(text, chr(10))) line from documents),
notices as (select doc_id, licence from (select doc_id, {_normal("line")} norm from lines where contains(lower(line), 'licen')) join known using (norm)),
per as (select doc_id, count(*) n, string_agg(distinct licence, ',' order by licence) ids from notices group by doc_id),
whole as (select doc_id, {_normal("text")} norm from documents)
select w.doc_id, sha256(norm) canonical_sha256, licence, coalesce(n, 0) n_notices, coalesce(ids, '') licences
from whole w left join known using (norm) left join per using (doc_id)"""
