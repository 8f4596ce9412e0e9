"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

WARC_REVISIT = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as digest from pages
), o as (select html, max(page_id) as original from p where n >= 1000 group by html)
select p.page_id, p.n::bigint as payload_bytes, p.digest as payload_digest,
  case when o.original <> p.page_id then 'revisit' else 'response' end as record_type,
  case when o.original <> p.page_id then o.original end as refers_to
from p left join o on p.html = o.html
"""

URL_RULES = r"""
with recursive u as (
  select page_id, coalesce(url, '') as url, instr(coalesce(url, ''), '://') as pos from pages
), s as (
  select page_id, url, pos, case when pos > 0 then substr(url, pos + 3) else '' end as rest from u
), h as (
  select page_id, url, pos,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from s
), r as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from h
), v as (
  select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block' end as said,
    case when pos > 0 then list_distinct(list_concat(
      ['scheme:' || translate(split_part(url, '://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')],
      [('host:' || x) for x in string_split(host, '.') if x <> ''],
      [('path:' || x) for x in [regexp_replace(regexp_replace(y, '\.[A-Za-z]+$', ''), '^[0-9]+$', '0')
        for y in string_split(path, '/')] if x <> ''],
      [('ending:' || x) for x in [regexp_extract(path, '\.([A-Za-z]+)$', 1)] if x <> ''],
      [('query:' || x) for x in [split_part(y, '=', 1)
        for y in string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&')] if x <> '']
    )) else [] end as tokens,
    row_number() over () as k from r
), l as (select k, said, tokens from v where said is not null
), n as (select count(*) as n, ceil(0.005 * count(*)) as least from l
), e as (select k, said, unnest(tokens) as t from l
), t as (
  select k, said, t from e where t in (select t from e, n group by t, said, least having count(*) >= least)
), c as (
  select k, said, [t] as tokens, t as last from t
  union all select c.k, c.said, c.tokens || [t.t], t.t from c join t on c.k = t.k and t.t > c.last
), f as (
  select tokens, said, count(*) as together, sum(count(*)) over (partition by tokens) as one from c group by tokens, said
), m as (
  select tokens, said, together / one as confidence, together / n as support, array_to_string(tokens, chr(31)) as id
  from f, n where together >= least and together / one >= 0.9
), b as (
  select v.k, m.said, row_number() over (partition by v.k order by confidence desc, support desc, id, m.said) as place
  from v join m on list_has_all(v.tokens, m.tokens) where v.said is null
)
select page_id, host, path, rule, coalesce(v.said, b.said, 'allow') as verdict
from v left join b on v.k = b.k and b.place = 1
"""

_REACH = """, reach(id, other) as (
  select id, id from nodes union select reach.id, links.b from reach join links on links.a = reach.other
), roots as (select id, min(other) as component_id from reach group by id
), counts as (select a as id, count(*) as n_links from links group by a)
"""

ROTATION_CODES = """
with recursive nodes as (
  select vec_id as id, label, cast(embedding as double[]) as e from embeddings
), links as (
  select x.id as a, y.id as b from nodes x join nodes y on x.label = y.label and x.id <> y.id
  where list_cosine_similarity(x.e, y.e) >= 0.98
)""" + _REACH + """
select r.id as vec_id, coalesce(c.n_links, 0) as n_links, r.component_id, r.id = r.component_id as kept
from roots r left join counts c on c.id = r.id
"""

NGRAM_JOIN = r"""
with recursive nodes as (
  select doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x09-\x0D\x20]+'), lambda x: x <> '') as w
  from documents
), grams as (
  select distinct id, gram from (select id, unnest(
    case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as gram from nodes)
), sizes as (select id, count(*) as n from grams group by id
), shared as (
  select x.id as a, y.id as b, count(*) as k from grams x join grams y on x.gram = y.gram and x.id <> y.id group by all
), links as (
  select a, b from shared join sizes x on x.id = a join sizes y on y.id = b where 5 * k >= 4 * (x.n + y.n - k)
)""" + _REACH + """
select r.id as doc_id, coalesce(c.n_links, 0) as n_links, r.component_id, r.id = r.component_id as kept
from roots r left join counts c on c.id = r.id
"""

LEXICAL_SEARCH = r"""
with doc_terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents where text is not null
), item_terms as (
  select item_id, term, count(*) as n from (select item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark where text is not null) group by all
), tf as (select doc_id, term, count(*) as tf from doc_terms group by all
), sizes as (select doc_id, sum(tf)::bigint as n from tf group by doc_id
), totals as (select count(*) as nn, sum(n)::bigint as ll from sizes
), df as (select term, count(*) as df from tf group by term
), scores as (
  select item_id, doc_id, sum(i.n * floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double))::bigint
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * s.n * nn) // ll))))::bigint as score
  from item_terms i join tf using (term) join df using (term) join sizes s using (doc_id) cross join totals group by item_id, doc_id
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
where rank <= 10
"""

ORACLE = {
    "op3_warc_revisit": WARC_REVISIT, "op5_rotation_codes": ROTATION_CODES, "op6_ngram_join": NGRAM_JOIN,
    "op9_url_rules": URL_RULES, "op13_geometric_blocks": LEXICAL_SEARCH,
}
