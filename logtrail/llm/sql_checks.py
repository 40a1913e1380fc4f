"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

from logtrail.llm import url_model


def _rule(column: str) -> str:
    rules = sorted(url_model.RULES, key=lambda r: (-len(r.text), r.text))
    whens = " ".join(f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{r.text if column == 'rule' else r.verdict}'" for r in rules)
    return f"case {whens} end"


def _urls() -> str:
    n = url_model.RUN
    keys = {f"g{k}": f"substr(padded, i + {n - k + 1}, {k})" for k in range(1, n + 1)} | {f"x{k}": f"substr(padded, i + {n - k}, {k})" for k in range(n)}
    chance = {}
    for side in ("allow", "block"):
        p = "(1.0::double / 256)"
        for k in range(1, n + 1):
            p = f"((coalesce(t_g{k}.{side}, 0) + {url_model.PRIOR}::double * {p}) / (coalesce(t_x{k - 1}.{side}, 0) + {url_model.PRIOR}::double))"
        chance[side] = p
    joins = " ".join(f"left join counts t_{c} on t_{c}.name = '{c}' and t_{c}.key = a.{c}" for c in keys)
    counts = " union all ".join(f"select '{c}' name, {c} \"key\", ruled from spots where ruled is not null and not held" for c in keys)
    upper = "".join(map(chr, range(65, 91)))
    return f"""
with parts as (
  select row_number() over () no, page_id,
    coalesce(case when position('://' in url) > 0 then translate(regexp_extract(substr(url, position('://' in url) + 3), '^[^/?#]*'), '{upper}', '{upper.lower()}') end, '') host,
    coalesce(case when position('://' in url) > 0 then regexp_extract(substr(url, position('://' in url) + 3), '^[^/?#]*([^?#]*)', 1) end, '') path
  from pages),
ruled as materialized (select *, {_rule('rule')} rule, {_rule('verdict')} ruled,
    case when page_id % {url_model.FOLDS} = {url_model.CALIBRATION} then true else false end held from parts),
chars as (select no, ruled, held, '{'^' * (n - 1)}' || host || path || chr(10) padded, unnest(range(0, length(host || path) + 1)) i from ruled),
spots as materialized (select no, ruled, held, {', '.join(f'{key} {name}' for name, key in keys.items())} from chars),
counts as materialized (
  select name, "key", count(*) filter (where ruled = 'allow') allow, count(*) filter (where ruled = 'block') block
  from ({counts}) group by name, "key"),
scored as materialized (
  select a.no, avg(ln({chance['allow']}) - ln({chance['block']})) ratio from spots a {joins} group by a.no),
bins as (
  select floor(ratio * {url_model.STEP}) bin, count(*) filter (where ruled = 'allow') allow, count(*) filter (where ruled = 'block') block
  from scored join ruled using (no) where held and ruled is not null group by 1),
sums as (
  select bin, (sum(allow) over (order by bin rows between current row and unbounded following))::double / sum(allow) over ()
    + coalesce(sum(block) over (order by bin rows between unbounded preceding and 1 preceding), 0)::double / sum(block) over () good
  from bins),
gaps as (select bin, good, coalesce(lag(bin) over (order by bin) + 1, bin) lower_edge from sums),
best as (select coalesce((select (lower_edge + bin) / 2.0 / {url_model.STEP} from gaps where good is not null order by round(good, 9) desc, bin limit 1), 0.0) threshold)
select page_id, host, path, rule, coalesce(ruled, case when ratio >= threshold then 'allow' else 'block' end) verdict
from ruled join scored using (no), best
"""


URLS = _urls()

_HEX = "(strpos('0123456789abcdef', substr(hex, {at} + 1, 1)) - 1)"
_PAIR = f"({_HEX.format(at='(5 * i) // 4')} * 16 + greatest({_HEX.format(at='(5 * i) // 4 + 1')}, 0))"

WARC = f"""
with digests as (select page_id, octet_length(encode(coalesce(html, ''))) payload_bytes, sha1(coalesce(html, '')) hex from pages),
latest as (select hex, max(page_id) final from digests group by hex)
select page_id, payload_bytes::bigint payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_PAIR}) >> (3 - ((5 * i) % 4))::int) % 32 + 1, 1)), 'string_agg', '') payload_digest,
  case when coalesce(page_id <> final, final is not null) then 'revisit' else 'response' end record_type,
  case when coalesce(page_id <> final, final is not null) then final end refers_to
from digests join latest using (hex)
"""

TOP_K = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) x from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint score from usable q join usable c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int rank, vec_id, score from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""

JACCARD = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') w
  from documents),
sets as materialized (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) s
  from words),
classes as materialized (select min(doc_id) doc_id, s from (select doc_id, list_sort(s) s from sets) group by s),
grams as materialized (select doc_id, len(s) n, unnest(s) g from classes),
links as materialized (
  select a.doc_id a, b.doc_id b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id and 10 * a.n >= 9 * b.n and 10 * b.n >= 9 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select doc_id a, doc_id b from classes where len(s) > 0 union select reach.a, links.b from reach join links on reach.b = links.a),
roots as (select a doc_id, min(b) component_id from reach group by a)
select sets.doc_id, len(sets.s)::bigint n_shingles, coalesce(roots.component_id, sets.doc_id) component_id
from sets left join classes on list_sort(sets.s) = classes.s left join roots on roots.doc_id = classes.doc_id
"""

DIVERGENCE = """
with docs as (select row_number() over () id, coalesce(text, '') text, coalesce(lang, '') lang, coalesce(source, '') source from documents),
words as (
  select id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) term
  from docs),
kept as materialized (select lang, term, count(*)::hugeint n from words group by lang, term having count(distinct id) >= 3),
langs as (select lang, count(*)::hugeint v, sum(n) n from kept group by lang),
counts as materialized (select lang, source, term, count(*)::hugeint n from words semi join kept using (lang, term) group by all),
sizes as (select lang, source, sum(n) n from counts group by all),
groups as materialized (
  select d.lang, d.source, coalesce(l.v, 0) v, coalesce(s.n, 0) n from (select distinct lang, source from docs) d
  left join langs l on l.lang = d.lang left join sizes s on s.lang = d.lang and s.source = d.source),
parts as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.n + g.v) p
  from groups g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
of_lang as (select k.lang, k.term, 1 + (1000000000 * (k.n + 1)) // (l.n + l.v) q from kept k join langs l on l.lang = k.lang),
values as (
  select a.lang, a.source, 'pair' part, b.source item, sum((a.p - b.p) * (a.p - b.p) // b.p) value
  from parts a join parts b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source
  union all
  select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source where a.v = 0
  union all
  select p.lang, p.source, 'term', p.term, (p.p - o.q) * (p.p - o.q) // o.q from parts p join of_lang o on o.lang = p.lang and o.term = p.term where p.n > 0 and p.p > o.q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) rank from values)
select lang, source, part, item, value::bigint "value", rank::int rank from ranked where part = 'pair' or rank <= 200
"""
