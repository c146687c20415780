"""DuckDB SQL of the training-data queries that SQL can express, over the raw tables."""

from __future__ import annotations

from riverbend.llm import quality as Q

_EXACT_TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
  where a.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5"""


def _js(p: str, q: str) -> str:
    half = "case when {a} > 0 then 0.5 * {a} * log2(2 * {a} / ({p} + {q})) else 0 end"
    return f"({half.format(a=p, p=p, q=q)} + {half.format(a=q, p=p, q=q)})"


_SPACE = r"[ \t\n\x0B\f\r]"
_CLASS = [r"\p{Ll}", r"[\p{Lu}\p{Lt}]", r"[\p{Lo}\p{Lm}\p{M}]", r"\p{Nd}", "[#*$%&|<>]"]
_COUNTS = ", ".join(f"len(regexp_extract_all(t, '{c}')) as c{k}" for k, c in enumerate(_CLASS))
_SUMS = ", ".join(f"sum(c{k}) as c{k}" for k in range(Q.CLASSES))
_TOTAL = " + ".join(f"{{0}}.c{k}" for k in range(Q.CLASSES))
_CHAR_JS = " + ".join(_js(f"(cast(b.c{k} as double) / greatest(1, {_TOTAL.format('b')}))",
                          f"(cast(r.c{k} as double) / greatest(1, {_TOTAL.format('r')}))") for k in range(Q.CLASSES))

_QUALITY = rf"""
with d as (select row_number() over () as i, doc_id, lang, coalesce(text, '') as t from documents),
listed as (
  select *, list_filter(string_split_regex(t, '{_SPACE}+'), lambda x: x <> '') as words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as lines
  from d),
b0 as (
  select i, doc_id, lang, length(t) as n_chars, len(words) as n_words, length(list_aggregate(words, 'string_agg', '')) as wc,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, {_COUNTS}
  from listed),
b1 as (select * replace (coalesce(wc, 0) as wc) from b0),
b as (select *, wc - c0 - c1 - c2 - c3 - c4 as c5 from b1),
token as (select i, lang, unnest(words) as word, unnest(range(len(words))) as place from listed),
triple as (
  select i, place, word, lead(word) over w as word2, lead(word, 2) over w as word3
  from token window w as (partition by i order by place)),
repeated as (
  select i, place, count(*) over (partition by i, word, word2, word3) as n from triple where word3 is not null),
marked as (
  select i, count(distinct spot) as n from (select i, unnest([place, place + 1, place + 2]) as spot from repeated where n > 1)
  group by i),
counted as (select lang, word, count(*) as n from token group by lang, word),
best as (
  select * from (select *, row_number() over (partition by lang order by n desc, word) as k from counted
                 where n >= {Q.MIN_COMMON})
  where k <= {Q.COMMON}),
sized as (select lang, sum(n_words) as n, {_SUMS} from b group by lang having sum(n_words) > 0),
reference as (
  select '*' as ref, sum(n) as n, {_SUMS} from sized
  union all by name
  select '=' || lang as ref, n, {', '.join(f'c{k}' for k in range(Q.CLASSES))} from sized where lang is not null),
common as (
  select '=' || lang as ref, word, n from best where lang is not null
  union all
  select * from (select '*' as ref, word, sum(n) as n from counted group by word having sum(n) >= {Q.MIN_COMMON}
                 order by n desc, word limit {Q.COMMON})),
share as (select c.ref, c.word, c.n, cast(c.n as double) / r.n as q from common c join reference r using (ref)),
named as (
  select b.*, case when lang in (select lang from sized where lang is not null) then '=' || lang else '*' end as ref from b),
present as (
  select t.i, s.word, count(*) as n, cast(count(*) as double) / any_value(x.n_words) as p, any_value(s.q) as q
  from token t join named x using (i) join share s on s.ref = x.ref and s.word = t.word
  group by t.i, s.word),
met as (select i, sum(n) as n, sum(q) as q, sum({_js('p', 'q')}) as js from present group by i),
others as (
  select ref, cast(any_value(r.n) - coalesce(sum(s.n), 0) as double) / any_value(r.n) as q
  from reference r left join share s using (ref) group by ref),
apart as (
  select b.i, b.doc_id, b.n_chars, b.n_words, b.wc, b.c4, b.n_dup_lines, coalesce(k.n, 0) as n_repeat_words,
         sqrt(greatest(0, {_CHAR_JS})) as char_js, o.q as q0,
         cast(b.n_words - coalesce(m.n, 0) as double) / greatest(1, b.n_words) as p0,
         coalesce(m.js, 0) as met_js, coalesce(m.q, 0) as met_q
  from named b left join reference r using (ref) left join others o using (ref) left join met m using (i)
  left join marked k using (i)),
judged as (
  select *, n_words < {Q.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
         sqrt(greatest(0, {_js('p0', 'q0')} + met_js + 0.5 * (1 - q0 - met_q))) as word_js
  from apart)
select doc_id, n_words, wc as word_chars, c4 as n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and not coalesce(n_chars >= {Q.MIN_CHARS} and char_js > {Q.MAX_CHAR_JS}, false)
       and not coalesce(word_js > {Q.MAX_WORD_JS} + {Q.WORD_NOISE} / sqrt(cast(n_words as double)), false) as kept
from judged"""

_FILL_IN_MIDDLE = """
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
c as (
  select doc_id, t, length(t) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1,
         cast('0x' || substr(h, 9, 8) as bigint) as h2, cast('0x' || substr(h, 17, 8) as bigint) as h3,
         cast('0x' || substr(h, 25, 8) as bigint) as h4
  from d),
f as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from c),
p as (select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1) as suf from f)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(t) as restored_sha256
from p"""

_WARC = """
with p as (
  select page_id, url, coalesce(html, '') as t, row_number() over () as i from pages),
h as (select *, sha1(t) || '0' as x, octet_length(encode(t)) as n from p),
r as (
  select *, row_number() over (partition by x, n order by page_id nulls last, i) as k,
         first_value(page_id) over (partition by x, n order by page_id nulls last, i) as first
  from h)
select page_id, url, n as payload_bytes,
       list_aggregate(list_transform(range(32), lambda j:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((cast('0x' || substr(x, 1 + cast(j * 5 // 4 as integer), 2) as integer)
                      >> (3 - cast(j * 5 % 4 as integer))) & 31), 1)), 'string_agg', '') as payload_digest,
       case when k = 1 then 'response' else 'revisit' end as record_type,
       case when k > 1 then first end as refers_to
from r"""

def _rounds(n: int) -> str:
    """Assign and move, ``n`` times, then assign: tables a1, b1, ... a{n + 1}; means move b0."""
    out = []
    for r in range(1, n + 2):
        out.append(f"""
a{r} as materialized (
  select p.i, p.part, min(d) as d, arg_min(k, d * 64 + k) as k
  from (select p.i, p.part, b.k, list_sum(list_transform(list_zip(p.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) as d
        from p join b{r - 1} b using (part)) p
  group by p.i, p.part)""")
        if r <= n:
            out.append(f"""
m{r} as (
  select part, k, j, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as x
  from (select a.part, a.k, unnest(range(len(p.v))) as j, unnest(p.v) as x from a{r} a join p using (i, part))
  group by part, k, j),
b{r} as materialized (
  select b.part, b.k, coalesce(m.v, b.v) as v
  from b{r - 1} b left join (select part, k, list(x order by j) as v from m{r} group by part, k) m using (part, k))""")
    return ",".join(out)


_VECTOR_CODES = f"""
with e as materialized (
  select row_number() over () as i, vec_id, label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
u as (select e.*, unnest(range(16)) as part, len(q) // 16 as w from e),
p as materialized (select i, part, list_slice(q, part * w + 1, (part + 1) * w) as v from u),
f as (select i, row_number() over (order by vec_id nulls last, q) - 1 as k from e),
b0 as materialized (select part, k, v from f join p using (i) where k < 64),
{_rounds(2)},
coded as (
  select i, string_agg(printf('%02x', k), '' order by part) as code, cast(sum(d) as bigint) as error from a3 group by i),
named as (select vec_id, label, code, error from coded join e using (i)),
books as (select sha256(string_agg(cast(x as varchar), ',' order by part, k, j)) as h
          from (select part, k, unnest(range(len(v))) as j, unnest(v) as x from b2))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select h from books) as codebooks_sha256
from named"""

ORACLE = {"op5_quality_rules": _QUALITY, "op6_exact_top_k": _EXACT_TOP_K, "op11_fill_in_middle": _FILL_IN_MIDDLE,
          "op12_warc": _WARC, "op13_vector_codes": _VECTOR_CODES}
