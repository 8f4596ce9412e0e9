"""SQL that gives the registered queries' results from the given tables.

Written apart from the Spark code, over exploded rows with joins and window functions, so that the
two can check each other. Common table expressions are named once and put in front of the
statements that use them.
"""

from __future__ import annotations

import re

from tidewell.functions import stems
from tidewell.plans import fixtures as fx

PARTS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql.strip()


def oracle(name: str, sql: str) -> None:
    """Register ``sql`` with the common table expressions it needs, in order of definition."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for other, body in PARTS.items():
            if other not in needed and re.search(rf"\b{other}\b", text):
                needed.add(other)
                todo.append(body)
    heads = [f"{p} AS MATERIALIZED (\n{PARTS[p]}\n)" for p in PARTS if p in needed]
    ORACLE[name] = ("WITH " + ",\n".join(heads) + "\n" if heads else "") + sql.strip()


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[^\\pL]+'), lambda x: x <> '')"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- derived tables ---------------------------------------------------------

part("corpus_rows", """
SELECT md5(CAST(d.doc_id AS VARCHAR)) AS doc_id,
       CAST(floor(epoch(e.ts)) AS BIGINT) AS ticks,
       CAST(CAST(floor(epoch(e.ts)) AS BIGINT) AS VARCHAR) || '-' || md5(CAST(d.doc_id AS VARCHAR)) AS stream_id,
       strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS zulu,
       d.source || '.example.com' AS schost,
       'http://' || d.source || '.example.com/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR) AS doc_link,
       d.source AS src, d.text AS body_text,
       d.source || '-' || strftime(e.ts, '%Y%m%d') || '.parquet' AS src_file
FROM documents d JOIN events e ON d.doc_id = e.event_id
""")

part("sentence_rows", """
SELECT doc_id, unnest(string_split(body_text, chr(10))) AS sentence,
       generate_subscripts(string_split(body_text, chr(10)), 1) - 1 AS sent_no
FROM corpus_rows
""")

part("token_rows", f"""
SELECT doc_id, sent_no, unnest({_words('sentence')}) AS token,
       generate_subscripts({_words('sentence')}, 1) - 1 AS tok_no
FROM sentence_rows
""")

part("tagged_rows", """
SELECT doc_id, 1 AS tagger_rank, 'serif' AS tagger, sent_no, tok_no, token,
       CASE WHEN length(token) < 5 THEN NULL
            ELSE (['PER','ORG','LOC','MISC','VEH','TIME'])[length(token) % 6 + 1] END AS entity_type
FROM token_rows
UNION ALL
SELECT doc_id, 2, 'lingpipecounter', sent_no, tok_no, token,
       CASE WHEN length(token) < 4 THEN NULL ELSE (['PER','ORG','LOC','MISC'])[length(token) % 4 + 1] END
FROM token_rows
""")

part("run_marks", """
SELECT *, CASE WHEN tok_no = 0 OR entity_type IS DISTINCT FROM lag(entity_type) OVER w THEN 1 ELSE 0 END AS is_new,
       max(tok_no) OVER (PARTITION BY doc_id, tagger_rank, sent_no) AS last_tok
FROM tagged_rows
WINDOW w AS (PARTITION BY doc_id, tagger_rank, sent_no ORDER BY tok_no)
""")

part("run_rows", """
SELECT doc_id, tagger_rank, tagger, sent_no, run_no, min(tok_no) AS first_tok, any_value(entity_type) AS entity_type,
       max(tok_no) = max(last_tok) AS is_end, string_agg(token, ' ' ORDER BY tok_no) || ' ' AS mention
FROM (SELECT *, sum(is_new) OVER (PARTITION BY doc_id, tagger_rank, sent_no ORDER BY tok_no) AS run_no FROM run_marks)
GROUP BY doc_id, tagger_rank, tagger, sent_no, run_no
""")

part("mention_rows", """
SELECT * FROM run_rows
WHERE entity_type IS NOT NULL AND (is_end OR entity_type IN ('ORG', 'LOC', 'PER', 'VEH', 'TIME'))
""")

part("count_rows", """
SELECT doc_id, mention AS entity,
       CAST(CASE WHEN arg_min(tagger_rank, (tagger_rank, sent_no, first_tok)) = 1
                   OR arg_min(is_end, (tagger_rank, sent_no, first_tok))
                 THEN count(*) ELSE 1 + count(*) FILTER (WHERE is_end) END AS INTEGER) AS cnt
FROM mention_rows WHERE length(mention) < 50 GROUP BY doc_id, mention
""")

part("label_marks", """
SELECT *, CASE WHEN tok_no = 0 OR label <> lag(label) OVER w THEN 1 ELSE 0 END AS is_new
FROM (SELECT doc_id, sent_no, tok_no, token,
             CASE WHEN length(token) < 5 THEN 'O'
                  ELSE (['PERSON','ORGANIZATION','LOCATION','O','O','O'])[length(token) % 6 + 1] END AS label
      FROM token_rows)
WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_no)
""")

part("retag_rows", """
SELECT doc_id, entity, CAST(count(*) AS INTEGER) AS cnt
FROM (SELECT doc_id, string_agg(token, ' ' ORDER BY tok_no) || ' ' ||
             CASE any_value(label) WHEN 'LOCATION' THEN '1' WHEN 'ORGANIZATION' THEN '2' ELSE '3' END AS entity
      FROM (SELECT *, sum(is_new) OVER (PARTITION BY doc_id, sent_no ORDER BY tok_no) AS run_no FROM label_marks)
      WHERE label <> 'O' GROUP BY doc_id, sent_no, run_no)
WHERE length(entity) > 3 AND length(entity) < 30 GROUP BY doc_id, entity
""")


def _norm(x: str) -> str:
    return f"regexp_replace(lower({x}), '[[:punct:]\\s]+', '', 'g')"


part("retag_names", """
SELECT doc_id, regexp_replace(entity, ' [0-9]$', '') AS entity, cnt FROM retag_rows
""")

part("name_words", """
SELECT entity, unnest(string_split(trim(entity), ' ')) AS form,
       generate_subscripts(string_split(trim(entity), ' '), 1) AS place
FROM (SELECT DISTINCT entity FROM retag_names)
""")

_PLAIN = "regexp_replace({}, '<[^>]*>', ' ', 'g')"
for _ref, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©"),
                   ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_ref}', '{_char}')"
_PLAIN = f"trim(regexp_replace({_PLAIN}, '\\s+', ' ', 'g'))"

part("page_rows", r"""
SELECT md5(CAST(page_id AS VARCHAR)) AS doc_id, url, html,
       regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g') AS seen
FROM pages
""")

_BREAK = r"(?i)</?([dou]l|d[dt]|li|div|p|pre|br|hr|h[1-6r]|t(able|body|foot|head|itle|[drh])|html|head(er)?|body|main|nav|footer|aside|article|section|form|fig(ure|caption)|blockquote|address|caption|center|details|dialog|dir|fieldset|legend|menu|option|select|summary)(\s[^>]*)?/?>"
part("block_rows", rf"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY piece_no) - 1 AS block_no, tx,
       len(string_split(tx, ' ')) AS words,
       CASE WHEN linked_tx = '' THEN 0 ELSE len(string_split(linked_tx, ' ')) END AS linked_words
FROM (SELECT doc_id, piece_no, {_PLAIN.format('piece')} AS tx,
             {_PLAIN.format("array_to_string(regexp_extract_all(piece, '(?is)<a\\s[^>]*>(.*?)</a>', 1), ' ')")} AS linked_tx
      FROM (SELECT doc_id, unnest(string_split_regex(seen, '{_BREAK}')) AS piece,
                   generate_subscripts(string_split_regex(seen, '{_BREAK}'), 1) AS piece_no FROM page_rows))
WHERE tx <> ''
""")

part("judged_rows", """
SELECT *, ld <= 0.333333 AND CASE WHEN coalesce(lag(ld) OVER w, 0) <= 0.555556
          THEN words > 16 OR coalesce(lead(words) OVER w, 0) > 15 OR coalesce(lag(words) OVER w, 0) > 4
          ELSE words > 40 OR coalesce(lead(words) OVER w, 0) > 17 END AS is_content
FROM (SELECT *, CAST(linked_words AS DOUBLE) / words AS ld FROM block_rows)
WINDOW w AS (PARTITION BY doc_id ORDER BY block_no)
""")

part("article_rows", """
SELECT p.doc_id, coalesce(a.article, '') AS article, p.seen
FROM page_rows p LEFT JOIN (SELECT doc_id, string_agg(tx, chr(10) ORDER BY block_no) AS article
                            FROM judged_rows WHERE is_content GROUP BY doc_id) a ON a.doc_id = p.doc_id
""")

# --- sources and sinks ------------------------------------------------------

oracle("scan_items", "SELECT 'documents.parquet' AS chunk, md5(CAST(doc_id AS VARCHAR)) AS doc_id, source FROM documents")
oracle("manifest_scan", "SELECT 'documents.parquet' AS chunk, lang, count(*) AS records FROM documents GROUP BY lang")
oracle("quarantine", """
SELECT 'documents.parquet' AS path, count(*) AS expected, count(*) AS rows, NULL::VARCHAR AS error FROM documents
UNION ALL SELECT 'no_such_chunk.parquet', NULL, NULL, 'missing'
""")
oracle("tsv_roundtrip", "SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, text FROM documents")
oracle("ingest_xz", "SELECT source, doc_id, md5(text) AS digest FROM documents")
oracle("entity_map_roundtrip", """
SELECT c.doc_id, CAST(count(r.entity) AS INTEGER) AS n_entities, CAST(coalesce(sum(r.cnt), 0) AS INTEGER) AS mentions
FROM corpus_rows c LEFT JOIN count_rows r ON r.doc_id = c.doc_id GROUP BY c.doc_id
""")
oracle("entity_map_dump", "SELECT doc_id, entity, cnt FROM count_rows")
for _name in ("sink_codec", "sink_mode"):
    oracle(_name, "SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, md5(text) AS digest FROM documents")
oracle("sink_partitions", "SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, md5(text) AS digest, 24 AS files FROM documents")
oracle("sink_by_file", """
SELECT src_file, count(*) AS records, CAST(sum(length(body_text)) AS BIGINT) AS chars FROM corpus_rows GROUP BY src_file
""")

# --- projections, filters, day counts ---------------------------------------

oracle("has_text", "SELECT stream_id, doc_id FROM corpus_rows WHERE body_text IS NOT NULL AND body_text <> ''")
oracle("doc_text", "SELECT doc_id, body_text AS text FROM corpus_rows WHERE body_text <> ''")
oracle("doc_url", "SELECT doc_id, url FROM page_rows WHERE url IS NOT NULL")
oracle("doc_host", "SELECT doc_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host FROM page_rows")
oracle("doc_chunk_hour", """
SELECT doc_id, string_split(src_file, '.')[1] AS chunk, zulu AS time,
       CAST((ticks // 3600) % 24 AS INTEGER) AS hour FROM corpus_rows
""")
oracle("doc_chunk_hour_compat", """
SELECT doc_id, string_split(src_file, '.')[1] AS chunk, zulu AS time,
       CAST((ticks // 3600000) % 24 AS INTEGER) AS hour FROM corpus_rows
""")
oracle("doc_props", """
SELECT stream_id, doc_id AS docno, schost AS url, src AS type, zulu AS time FROM corpus_rows WHERE body_text <> ''
""")
oracle("docs_per_day", """
SELECT CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) AS day, count(*) AS docs
FROM documents d JOIN events e ON d.doc_id = e.event_id GROUP BY 1
""")

# --- mentions and entities --------------------------------------------------

oracle("ne_spans", """
SELECT doc_id, tagger_rank, CAST(sent_no AS INTEGER) AS sent_no, mention, entity_type, is_end FROM mention_rows
""")
oracle("mention_list", "SELECT doc_id, mention, entity_type FROM mention_rows")
oracle("ne_doc_counts", "SELECT doc_id, entity, cnt FROM count_rows")
oracle("ne_doc_types", """
SELECT doc_id, mention AS entity,
       CAST(arg_min(CASE entity_type WHEN 'PER' THEN 1 WHEN 'LOC' THEN 2 WHEN 'ORG' THEN 3 ELSE 4 END,
                    (tagger_rank, sent_no, first_tok)) AS INTEGER) AS type_code
FROM mention_rows WHERE length(mention) < 50 AND entity_type IN ('PER', 'LOC', 'ORG', 'VEH')
GROUP BY doc_id, mention
""")
oracle("ner_typed_counts", "SELECT doc_id, entity, cnt FROM retag_rows")
oracle("doc_entity_map", """
SELECT c.doc_id, CAST(count(r.entity) AS INTEGER) AS n_entities,
       coalesce(string_agg(r.entity || '=' || CAST(r.cnt AS VARCHAR), '|' ORDER BY r.entity), '') AS entities
FROM corpus_rows c LEFT JOIN count_rows r ON r.doc_id = c.doc_id GROUP BY c.doc_id
""")
oracle("entity_total", "SELECT entity, CAST(sum(cnt) AS BIGINT) AS total FROM count_rows GROUP BY entity")
oracle("entity_norm", f"SELECT doc_id, mention, {_norm('mention')} AS norm FROM mention_rows WHERE {_norm('mention')} <> ''")
oracle("entity_norm_distinct", f"SELECT entity, min({_norm('entity')}) AS norm FROM count_rows WHERE {_norm('entity')} <> '' GROUP BY entity")
oracle("doc_entity_norm", f"SELECT doc_id, entity, {_norm('entity')} AS norm, cnt FROM count_rows WHERE {_norm('entity')} <> ''")
oracle("lemma_lookup", """
SELECT w.entity, string_agg(CASE WHEN s.form IS NOT NULL THEN left(w.form, length(w.form) - 1) ELSE w.form END,
                            ' ' ORDER BY w.place) AS lemmatised
FROM name_words w
LEFT JOIN (SELECT DISTINCT a.form FROM name_words a JOIN name_words b ON b.form = left(a.form, length(a.form) - 1)
           WHERE a.form LIKE '%s' AND length(a.form) > 3) s ON s.form = w.form
GROUP BY w.entity
""")

# --- page blocks ------------------------------------------------------------

oracle("html_blocks", "SELECT doc_id, CAST(block_no AS INTEGER) AS block_no, tx AS text FROM block_rows")
oracle("block_features", """
SELECT doc_id, CAST(block_no AS INTEGER) AS block_no, CAST(words AS INTEGER) AS words,
       CAST(linked_words AS INTEGER) AS linked_words, round(CAST(linked_words AS DOUBLE) / words, 4) AS link_density FROM block_rows
""")
oracle("block_classify", """
SELECT doc_id, CAST(block_no AS INTEGER) AS block_no, is_content, CAST(words AS INTEGER) AS words FROM judged_rows
""")
oracle("article_text", "SELECT doc_id, article FROM article_rows")
oracle("article_or_visible", f"""
SELECT '0-' || doc_id AS stream_id, coalesce(nullif(article, ''), {_PLAIN.format('seen')}) AS text
FROM article_rows WHERE {_PLAIN.format('seen')} <> ''
""")

# --- index ------------------------------------------------------------------

part("section_rows", """
SELECT r.doc_id, 'body' AS section, 1 AS section_no, r.tagger_rank, r.sent_no, r.tok_no, r.token, r.entity_type FROM tagged_rows r
UNION ALL
SELECT r.doc_id, 'title', 0, r.tagger_rank, r.sent_no, r.tok_no, r.token, r.entity_type
FROM tagged_rows r WHERE r.sent_no = 0
""")

part("placed_rows", """
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section_no, tagger_rank, sent_no, tok_no) - 1 AS pos,
       CASE WHEN tagger_rank = 1 THEN 'Serif_' ELSE 'Lingpipe_' END || entity_type AS entity_field
FROM section_rows
""")

part("term_rows", """
SELECT doc_id, pos, 0 AS surface, lower(token) AS term, 'Lemma' AS fields
FROM placed_rows WHERE length(token) > 1 OR lower(token) = 'i'
UNION ALL
SELECT doc_id, pos, 1, token,
       concat_ws(',', CASE WHEN tagger_rank = 1 THEN section END,
                 CASE WHEN entity_type IN ('PER', 'ORG', 'LOC', 'MISC') THEN entity_field END)
FROM placed_rows
""")

part("freq_rows", "SELECT doc_id, term, count(*) AS tf FROM term_rows GROUP BY doc_id, term")
part("length_rows", """
SELECT c.doc_id, count(t.term) AS doc_len FROM corpus_rows c LEFT JOIN term_rows t ON t.doc_id = c.doc_id GROUP BY c.doc_id
""")
part("vocab_rows", "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM freq_rows GROUP BY term")

oracle("term_stream", """
SELECT doc_id, term, CAST(pos AS INTEGER) AS pos, CAST(surface AS INTEGER) AS surface, fields FROM term_rows
""")
oracle("stopword_filter", f"SELECT doc_id, term, CAST(tf AS INTEGER) AS tf FROM freq_rows WHERE term NOT IN ({_quoted(fx.STOPWORDS)})")
oracle("inverted_index", """
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf, """ + ",\n".join(
    f"CAST(count(*) FILTER (WHERE list_contains(string_split(fields, ','), '{f}')) AS INTEGER) AS tf_{f.lower()}"
    for f in ("Lemma", "title", "body", "Serif_PER", "Serif_ORG", "Serif_LOC", "Serif_MISC",
              "Lingpipe_PER", "Lingpipe_ORG", "Lingpipe_LOC", "Lingpipe_MISC")) + """,
       string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM term_rows GROUP BY doc_id, term
""")
oracle("lexicon", "SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab_rows")
oracle("doc_lengths", "SELECT doc_id, CAST(doc_len AS INTEGER) AS doc_len FROM length_rows")
oracle("meta_index", """
SELECT left(stream_id, 320) AS stream_id, left(doc_id, 200) AS docno, left(schost, 500) AS url,
       left(src, 140) AS type, left(zulu, 50) AS time FROM corpus_rows
""")
oracle("collection_stats", """
SELECT count(*) AS docs, CAST(sum(doc_len) AS BIGINT) AS tokens, round(avg(doc_len), 4) AS avg_len,
       (SELECT count(*) FROM vocab_rows) AS unique_terms FROM length_rows
""")
oracle("index_by_letter", """
SELECT CASE WHEN term[1] BETWEEN 'a' AND 'z' THEN term[1] ELSE '_' END AS letter, term, df, cf FROM vocab_rows
""")
oracle("index_by_shard", """
SELECT CAST(('0x' || substr(md5(c.stream_id), 1, 4))::INTEGER % 4 AS INTEGER) AS shard, f.term,
       count(*) AS df, CAST(sum(f.tf) AS BIGINT) AS cf
FROM freq_rows f JOIN corpus_rows c ON c.doc_id = f.doc_id GROUP BY 1, 2
""")
oracle("index_merge", "SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab_rows")
# Stems of the vocabulary, step by step; ``c`` has a v or c for each letter of ``s``.
_CLASSES = ("list_reduce(string_split(s, ''), lambda acc, x: acc || CASE WHEN contains('aeiou', x) THEN 'v' "
            "WHEN x = 'y' AND right(acc, 1) = 'c' THEN 'v' ELSE 'c' END, '')")


def _less(text: str, n: str) -> str:
    return f"substr({text}, 1, length({text}) - {n})"


def _measure_of(classes: str) -> str:
    return f"len(regexp_extract_all({classes}, 'vc'))"


def _swap(rules: dict[str, str], least: int) -> str:
    x = f"regexp_extract(s, '({'|'.join(rules)})$')"
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in rules.items())
    return (f"CASE WHEN {x} <> '' AND {_measure_of(_less('c', f'length({x})'))} > {least} "
            f"THEN {_less('s', f'length({x})')} || CASE {x} {cases} END ELSE s END")


_O = "(c LIKE '%cvc' AND NOT regexp_matches(s, '[wxy]$'))"
_O_BEFORE_E = f"({_less('c', '1')} LIKE '%cvc' AND NOT regexp_matches({_less('s', '1')}, '[wxy]$'))"
_FOURTH = f"regexp_extract(s, '({'|'.join(stems.STEP_4)})$')"
_STEPS = (
    (_swap(stems.STEP_1A, -1), "false"),
    (f"CASE WHEN s LIKE '%eed' THEN CASE WHEN {_measure_of(_less('c', '3'))} > 0 THEN {_less('s', '1')} ELSE s END "
     f"WHEN s LIKE '%ed' AND contains({_less('c', '2')}, 'v') THEN {_less('s', '2')} "
     f"WHEN s LIKE '%ing' AND contains({_less('c', '3')}, 'v') THEN {_less('s', '3')} ELSE s END",
     f"(s LIKE '%ed' AND s NOT LIKE '%eed' AND contains({_less('c', '2')}, 'v')) OR (s LIKE '%ing' AND contains({_less('c', '3')}, 'v'))"),
    (f"CASE WHEN NOT cut THEN s WHEN regexp_matches(s, '(at|bl|iz)$') THEN s || 'e' "
     f"WHEN c LIKE '%cc' AND s[-1] = s[-2] AND s[-1] NOT IN ('l', 's', 'z') THEN {_less('s', '1')} "
     f"WHEN {_measure_of('c')} = 1 AND {_O} THEN s || 'e' ELSE s END", "false"),
    (f"CASE WHEN s LIKE '%y' AND contains({_less('c', '1')}, 'v') THEN {_less('s', '1')} || 'i' ELSE s END", "false"),
    (_swap(stems.STEP_2, 0), "false"),
    (_swap(stems.STEP_3, 0), "false"),
    (f"CASE WHEN {_FOURTH} <> '' AND {_measure_of(_less('c', f'length({_FOURTH})'))} > 1 "
     f"AND ({_FOURTH} <> 'ion' OR regexp_matches(s, '[st]ion$')) THEN {_less('s', f'length({_FOURTH})')} ELSE s END", "false"),
    (f"CASE WHEN s LIKE '%e' AND ({_measure_of(_less('c', '1'))} > 1 OR ({_measure_of(_less('c', '1'))} = 1 AND NOT {_O_BEFORE_E})) "
     f"THEN {_less('s', '1')} ELSE s END", "false"),
    (f"CASE WHEN s LIKE '%ll' AND {_measure_of('c')} > 1 THEN {_less('s', '1')} ELSE s END", "false"),
)


def _stem_parts(name: str, source: str) -> None:
    """``(w, stem)`` of the distinct words of a table ``(w)``."""
    part(f"{name}_0", f"SELECT DISTINCT w, w AS s, false AS cut FROM {source}")
    for i, (value, cut) in enumerate(_STEPS, 1):
        part(f"{name}_{i}", f"SELECT w, {value} AS s, {cut} AS cut FROM (SELECT w, s, cut, {_CLASSES} AS c FROM {name}_{i - 1})")
    part(f"{name}_stems", f"SELECT w, CASE WHEN length(w) <= 2 THEN w ELSE s END AS stem FROM {name}_{len(_STEPS)}")


part("low_rows", "SELECT lower(term) AS w FROM vocab_rows")
_stem_parts("vocab", "low_rows")
oracle("index_segments", """
SELECT t.term, v.term_id, c.doc_no, t.doc_id, CAST(count(*) AS INTEGER) AS tf, string_agg(CAST(t.pos AS VARCHAR), ',' ORDER BY t.pos) AS positions
FROM term_rows t JOIN (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM vocab_rows) v ON v.term = t.term
JOIN (SELECT doc_id, row_number() OVER (ORDER BY stream_id) - 1 AS doc_no FROM corpus_rows) c ON c.doc_id = t.doc_id
GROUP BY ALL
""")
oracle("vocab_conflate", """
SELECT s.stem, count(DISTINCT f.term) AS forms, count(DISTINCT f.doc_id) AS df, CAST(sum(f.tf) AS BIGINT) AS cf
FROM freq_rows f JOIN vocab_stems s ON s.w = lower(f.term) GROUP BY s.stem
""")
part("piped_rows", f"""
SELECT s.stem AS term, t.doc_id, t.pos FROM term_rows t JOIN vocab_stems s ON s.w = lower(t.term)
WHERE lower(t.term) NOT IN ({_quoted(fx.STOPWORDS)})
""")
oracle("index_pipeline", """
SELECT term, doc_id, CAST(count(*) AS INTEGER) AS tf, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM piped_rows GROUP BY term, doc_id
""")
oracle("direct_index", """
SELECT c.doc_id, coalesce(string_agg(f.term || ':' || CAST(f.tf AS VARCHAR), ' ' ORDER BY f.term), '') AS terms
FROM corpus_rows c LEFT JOIN freq_rows f ON f.doc_id = c.doc_id GROUP BY c.doc_id
""")

oracle("index_exists", "SELECT doc_id, true AS refused FROM corpus_rows")

# --- retrieval --------------------------------------------------------------

part("topic_words", f"""
SELECT item_id AS number, unnest({_words('text')}) AS word,
       generate_subscripts({_words('text')}, 1) - 1 AS place
FROM benchmark
""")
part("topic_rows", f"""
SELECT number, place, lower(word) AS term FROM topic_words WHERE lower(word) NOT IN ({_quoted(fx.STOPWORDS)})
""")
part("weight_rows", "SELECT number, term, count(*) AS weight FROM topic_rows GROUP BY number, term")
part("totals", "SELECT count(*) AS n, avg(doc_len) AS mean FROM length_rows")


def _bm25(weights: str, postings: str, tf: str, df: str, lengths: str = "length_rows", totals: str = "totals") -> str:
    """Scored documents per topic from tables of weights, postings and document frequencies."""
    return f"""
SELECT q.number, p.doc_id,
       round(sum(q.weight * ln((t.n - d.df + 0.5) / (d.df + 0.5) + 1) * {tf} * 2.2
                 / ({tf} + 1.2 * (0.25 + 0.75 * l.doc_len / t.mean))), 4) AS score
FROM {weights} q JOIN {postings} p ON p.term = q.term JOIN {df} d ON d.term = q.term
JOIN {lengths} l ON l.doc_id = p.doc_id CROSS JOIN {totals} t GROUP BY q.number, p.doc_id"""


def _top(scored: str, start: int = 0, end: int = 9) -> str:
    return f"""
SELECT number, doc_id, CAST(place - 1 AS INTEGER) AS rank, score
FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id) AS place FROM {scored})
WHERE place BETWEEN {start + 1} AND {end + 1}"""


part("score_rows", _bm25("weight_rows", "freq_rows", "p.tf", "vocab_rows"))
part("top_rows", _top("score_rows"))

part("topic_low", f"SELECT lower(word) AS w FROM topic_words WHERE lower(word) NOT IN ({_quoted(fx.STOPWORDS)})")
_stem_parts("topic", "topic_low")
part("piped_weights", "SELECT t.number, s.stem AS term, count(*) AS weight FROM topic_rows t JOIN topic_stems s ON s.w = t.term GROUP BY 1, 2")
part("piped_freq", "SELECT doc_id, term, count(*) AS tf FROM piped_rows GROUP BY doc_id, term")
part("piped_df", "SELECT term, count(*) AS df FROM piped_freq GROUP BY term")
part("piped_lengths", "SELECT c.doc_id, count(p.term) AS doc_len FROM corpus_rows c LEFT JOIN piped_rows p ON p.doc_id = c.doc_id GROUP BY c.doc_id")
part("piped_totals", "SELECT count(*) AS n, avg(doc_len) AS mean FROM piped_lengths")
part("piped_scores", _bm25("piped_weights", "piped_freq", "p.tf", "piped_df", "piped_lengths", "piped_totals"))
oracle("ranked_pipeline", _top("piped_scores"))
oracle("topics", "SELECT number, CAST(place AS INTEGER) AS place, lower(word) AS term FROM topic_words")
oracle("ranked_topk", "SELECT * FROM top_rows")
oracle("ranked_site", _top("(SELECT s.* FROM score_rows s JOIN corpus_rows c ON c.doc_id = s.doc_id WHERE c.schost LIKE '%7.example.com')"))
oracle("ranked_scope", _top("(SELECT * FROM score_rows WHERE doc_id LIKE 'a%')", 1, 5))
oracle("ranked_decorated", """
SELECT t.*, c.schost AS url, c.src AS type, c.zulu AS time FROM top_rows t JOIN corpus_rows c ON c.doc_id = t.doc_id
""")

part("bo1_rows", """
SELECT number, term, round(tf * log2((1 + p) / p) + log2(1 + p), 6) AS bo1
FROM (SELECT r.number, f.term, sum(f.tf) AS tf, any_value(v.cf) / any_value(t.n) AS p
      FROM top_rows r JOIN freq_rows f ON f.doc_id = r.doc_id JOIN vocab_rows v ON v.term = f.term CROSS JOIN totals t
      WHERE r.rank < 3 GROUP BY r.number, f.term)
""")
part("wider_rows", """
SELECT number, term, round(sum(w), 6) AS weight
FROM (SELECT number, term, bo1 / max(bo1) OVER (PARTITION BY number) AS w
      FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY bo1 DESC, term) AS place FROM bo1_rows) WHERE place <= 10
      UNION ALL SELECT number, term, weight / max(weight) OVER (PARTITION BY number) FROM weight_rows)
GROUP BY number, term
""")
part("wider_scores", _bm25("wider_rows", "freq_rows", "p.tf", "vocab_rows"))
oracle("ranked_qe", _top("wider_scores"))

part("spot_positions", "SELECT DISTINCT doc_id, term, pos FROM term_rows WHERE term IN (SELECT term FROM topic_rows)")
part("neighbour_rows", """
SELECT a.number, a.term AS t1, b.term AS t2 FROM topic_rows a JOIN topic_rows b ON b.number = a.number AND b.place = a.place + 1
""")
part("phrase_rows", """
SELECT n.t1 || ' ' || n.t2 AS term, x.doc_id, count(*) AS tf
FROM (SELECT DISTINCT t1, t2 FROM neighbour_rows) n JOIN spot_positions x ON x.term = n.t1
JOIN spot_positions y ON y.term = n.t2 AND y.doc_id = x.doc_id AND y.pos = x.pos + 1 GROUP BY 1, 2
""")
part("phrase_weights", "SELECT number, t1 || ' ' || t2 AS term, count(*) AS weight FROM neighbour_rows GROUP BY 1, 2")
part("phrase_df", "SELECT term, count(*) AS df FROM phrase_rows GROUP BY term")
part("phrase_scores", _bm25("phrase_weights", "phrase_rows", "p.tf", "phrase_df"))
oracle("ranked_proximity", _top("""(SELECT number, doc_id, round(sum(score), 4) AS score
    FROM (SELECT * FROM score_rows UNION ALL SELECT * FROM phrase_scores) GROUP BY number, doc_id)"""))

part("field_rows", """
SELECT doc_id, term, sum(CASE WHEN fields = 'Lemma' THEN 1.0 ELSE 0 END
    + CASE WHEN list_contains(string_split(fields, ','), 'title') THEN 2.0 ELSE 0 END
    + CASE WHEN list_contains(string_split(fields, ','), 'body') THEN 1.0 ELSE 0 END
    + CASE WHEN list_contains(string_split(fields, ','), 'Serif_PER') THEN 0.5 ELSE 0 END)::DOUBLE AS wtf
FROM term_rows WHERE term IN (SELECT term FROM topic_rows) GROUP BY doc_id, term
""")
part("field_scores", _bm25("weight_rows", "field_rows", "p.wtf", "vocab_rows"))
oracle("ranked_fields", _top("field_scores"))

# --- entity linking ---------------------------------------------------------

part("link_rows", r"""
SELECT page, target, spot FROM (
  SELECT md5(CAST(page_id AS VARCHAR)) AS page, unnest(regexp_extract_all(html, '(?is)<a href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS target,
         lower(trim(regexp_replace(unnest(regexp_extract_all(html, '(?is)<a href="([^"]*)"[^>]*>(.*?)</a>', 2)), '[^\pL]+', ' ', 'g'))) AS spot
  FROM pages) WHERE spot <> ''
""")

oracle("entity_kb_join", f"""
SELECT k.norm, 'kb:' || substr(md5(k.norm), 1, 8) AS kb_id, k.score, d.doc_id, d.cnt
FROM (SELECT doc_id, {_norm('entity')} AS norm, cnt FROM retag_names) d
JOIN (SELECT {_norm('spot')} AS norm, CAST(count(*) AS INTEGER) AS score FROM link_rows GROUP BY 1) k ON k.norm = d.norm
WHERE d.norm <> ''
""")

MAX_WORDS = 8


def _gram_parts(name: str, source: str) -> None:
    """Word sequences of a table ``(doc_id, tx)`` with their offsets."""
    part(f"{name}_words", f"""
SELECT doc_id, tok, w, sum(length(w) + length(g)) OVER (PARTITION BY doc_id ORDER BY tok) AS w_end
FROM (SELECT doc_id, unnest(regexp_extract_all(tx, '\\pL+')) AS w,
             unnest(string_split_regex(tx, '\\pL+')[1:len(regexp_extract_all(tx, '\\pL+'))]) AS g,
             generate_subscripts(regexp_extract_all(tx, '\\pL+'), 1) - 1 AS tok FROM {source})
""")
    unions = []
    for n in range(1, MAX_WORDS + 1):
        gram = " || ' ' || ".join(["lower(w)"] + [f"lower(lead(w, {k}) OVER o)" for k in range(1, n)])
        last = "w_end" if n == 1 else f"lead(w_end, {n - 1}) OVER o"
        unions.append(f"SELECT doc_id, tok, {n} AS n, {gram} AS gram, w_end - length(w) AS c_start, {last} AS c_end "
                      f"FROM {name}_words WINDOW o AS (PARTITION BY doc_id ORDER BY tok)")
    part(f"{name}_grams", "SELECT * FROM (\n" + "\nUNION ALL\n".join(unions)
         + "\n) WHERE gram IN (SELECT spot FROM link_rows)")


part("visible_rows", f"SELECT doc_id, {_PLAIN.format('seen')} AS tx FROM page_rows")
_gram_parts("visible", "visible_rows")

part("stat_rows", """
SELECT p.spot, p.target, p.links, s.spot_links, s.link_docs, greatest(coalesce(f.doc_freq, 0), s.link_docs) AS doc_freq,
       s.link_docs / greatest(coalesce(f.doc_freq, 0), s.link_docs) AS lp
FROM (SELECT spot, target, count(*) AS links FROM link_rows GROUP BY spot, target) p
JOIN (SELECT spot, count(*) AS spot_links, count(DISTINCT page) AS link_docs FROM link_rows GROUP BY spot) s ON s.spot = p.spot
LEFT JOIN (SELECT gram, count(DISTINCT doc_id) AS doc_freq FROM visible_grams GROUP BY gram) f ON f.gram = p.spot
""")
part("choice_rows", """
SELECT spot, target AS entity, lp, links / spot_links AS commonness FROM stat_rows
WHERE lp >= 0.02 AND links / spot_links >= 0.005
""")
part("spot_rows", "SELECT spot, min(lp) AS lp, count(*) AS n_cand FROM choice_rows GROUP BY spot")

part("doc_rows", "SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, text AS tx FROM documents")
_gram_parts("doc", "doc_rows")
part("article_texts", f"""
SELECT '0-' || doc_id AS doc_id, coalesce(nullif(article, ''), {_PLAIN.format('seen')}) AS tx
FROM article_rows WHERE {_PLAIN.format('seen')} <> ''
""")
_gram_parts("article", "article_texts")


def _link_parts(name: str) -> None:
    """Mentions, mentions without overlaps, and the best annotations by prior."""
    part(f"{name}_hits", f"""
SELECT g.doc_id, g.tok, g.n, g.c_start, g.c_end, g.gram AS spot, s.lp FROM {name}_grams g JOIN spot_rows s ON s.spot = g.gram
""")
    part(f"{name}_clean", f"""
SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tok, n) - 1 AS ord FROM {name}_hits a
WHERE NOT EXISTS (
  SELECT 1 FROM {name}_hits b WHERE b.doc_id = a.doc_id AND b.tok < a.tok + a.n AND a.tok < b.tok + b.n
  AND (b.c_end - b.c_start > a.c_end - a.c_start OR (b.c_end - b.c_start = a.c_end - a.c_start AND b.c_start < a.c_start)))
""")
    part(f"{name}_prior", f"""
SELECT m.doc_id, m.c_start, m.c_end, m.spot, c.entity, round(m.lp * c.commonness, 6) AS score
FROM {name}_clean m JOIN (SELECT spot, entity, commonness,
       row_number() OVER (PARTITION BY spot ORDER BY commonness DESC, entity) AS place FROM choice_rows) c
  ON c.spot = m.spot AND c.place = 1
""")
    part(f"{name}_best", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c_start, c_end) AS place FROM {name}_prior)
WHERE place <= 50 AND score >= 0.1
""")


_link_parts("doc")
_link_parts("article")
_link_parts("visible")

oracle("spot_stats", """
SELECT spot, target, links, CAST(spot_links AS BIGINT) AS spot_links, link_docs, doc_freq, round(lp, 6) AS link_probability FROM stat_rows
""")
oracle("spot_lp_filter", "SELECT DISTINCT spot, round(lp, 6) AS link_probability FROM stat_rows WHERE lp >= 0.02")
oracle("link_prior", """
SELECT spot, target, round(links / spot_links, 6) AS commonness,
       CAST(row_number() OVER (PARTITION BY spot ORDER BY links / spot_links DESC, target) AS INTEGER) AS rank
FROM stat_rows WHERE links / spot_links >= 0.005
""")
_PLACE = 'CAST(c_start AS INTEGER) AS start, CAST(c_end AS INTEGER) AS "end"'
oracle("spot_mentions", f"SELECT doc_id, spot, {_PLACE} FROM doc_hits")
oracle("spot_overlap_filter", f"SELECT doc_id, spot, {_PLACE} FROM doc_clean")
oracle("candidates", f"""
SELECT m.doc_id, {_PLACE}, m.spot, c.entity, round(c.commonness, 6) AS commonness
FROM doc_clean m JOIN choice_rows c ON c.spot = m.spot
""")
_URI = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?"


def _dotless(path: str) -> str:
    """A path without its dot segments."""
    segments = f"string_split(CASE WHEN {path} LIKE '/%' THEN substr({path}, 2) ELSE {path} END, '/')"
    kept = (f"list_reduce(list_transform({segments}, lambda s: [s]), lambda acc, x: CASE WHEN x[1] = '.' THEN acc "
            "WHEN x[1] = '..' THEN acc[:len(acc) - 1] ELSE acc || x END, CAST([] AS VARCHAR[]))")
    return (f"(CASE WHEN {path} LIKE '%/.%' OR {path} LIKE '.%' THEN CASE WHEN {path} LIKE '/%' THEN '/' ELSE '' END "
            f"|| array_to_string({kept}, '/') || CASE WHEN {segments}[-1] IN ('.', '..') AND len({kept}) > 0 THEN '/' ELSE '' END ELSE {path} END)")


def _uri_parts(url: str, name: str) -> str:
    return ", ".join(f"regexp_extract({url}, '{_URI}', {g}) AS {name}_{part}" for part, g in (
        ("scheme", 1), ("slashes", 2), ("path", 4), ("query", 5)))


def _canonical(scheme: str, slashes: str, path: str, query: str) -> str:
    """One form of an absolute web URL from its parts; hexadecimal digits of escapes are capital."""
    authority = f"substr({slashes}, 3)"
    host = f"lower(regexp_extract({authority}, '([^@]*)$', 1))"
    named = (f"CASE lower({scheme}) WHEN 'http' THEN regexp_replace({host}, ':(80)?$', '') "
             f"WHEN 'https' THEN regexp_replace({host}, ':(443)?$', '') ELSE regexp_replace({host}, ':$', '') END")
    tail = f"(CASE WHEN {path} = '' THEN '/' ELSE {path} END || {query})"
    escapes = f"array_to_string(list_transform(string_split({tail}, '%'), lambda s, i: CASE WHEN i = 1 THEN s ELSE upper(substr(s, 1, 2)) || substr(s, 3) END), '%')"
    return f"lower({scheme}) || '://' || regexp_extract({authority}, '^(.*@)?', 0) || {named} || {escapes}"


part("href_rows", f"""
SELECT url, href, {_uri_parts("url", "b")}, {_uri_parts("href", "r")}
FROM (SELECT url, trim(unnest(regexp_extract_all(html, '(?is)<a href="([^"]*)"[^>]*>(.*?)</a>', 1))) AS href FROM pages)
""")
part("resolved_rows", f"""
SELECT b_scheme, b_slashes, {_dotless("b_path")} AS b_path, b_query,
  CASE WHEN r_scheme <> '' THEN r_scheme ELSE b_scheme END AS t_scheme,
  CASE WHEN r_scheme <> '' OR r_slashes <> '' THEN r_slashes ELSE b_slashes END AS t_slashes,
  CASE WHEN r_scheme <> '' OR r_slashes <> '' THEN r_path WHEN r_path = '' THEN b_path WHEN r_path LIKE '/%' THEN r_path
       WHEN b_path = '' THEN '/' || r_path ELSE regexp_extract(b_path, '^(.*/)?', 0) || r_path END AS t_raw,
  CASE WHEN r_scheme = '' AND r_slashes = '' AND r_path = '' AND r_query = '' THEN b_query ELSE r_query END AS t_query
FROM href_rows
""")
part("url_edges", f"""
SELECT DISTINCT {_canonical("b_scheme", "b_slashes", "b_path", "b_query")} AS page,
       {_canonical("t_scheme", "t_slashes", "t_path", "t_query")} AS target
FROM (SELECT *, {_dotless("t_raw")} AS t_path FROM resolved_rows)
WHERE t_scheme IN ('http', 'https') AND length(t_slashes) > 2
""")
oracle("link_graph", "SELECT page, target FROM url_edges")
oracle("link_degrees", """
SELECT target AS node, count(*) AS degree, 'in' AS direction FROM url_edges GROUP BY target
UNION ALL SELECT page, count(*), 'out' FROM url_edges GROUP BY page
""")
oracle("annot_topk", f"SELECT doc_id, {_PLACE}, spot, entity, score FROM doc_best")
oracle("annot_list", """
SELECT doc_id, string_agg(entity || '=' || CAST(score AS VARCHAR), '|' ORDER BY place) AS entities FROM doc_best GROUP BY doc_id
""")
oracle("annot_lines", """
SELECT d.doc_id, d.doc_id || coalesce(string_agg(chr(9) || replace(b.entity, ',', '%2C') || ',' || CAST(b.score AS VARCHAR), '' ORDER BY b.place), '') AS line
FROM doc_rows d LEFT JOIN doc_best b ON b.doc_id = d.doc_id GROUP BY d.doc_id
""")


def _mention_lines(name: str, source: str, key: str) -> str:
    return f"""
SELECT d.doc_id AS {key}, d.doc_id || coalesce(string_agg(
         chr(9) || b.spot || ',' || CAST(CAST(b.c_start AS INTEGER) AS VARCHAR) || ',' || replace(b.entity, ',', '%2C') || ',' || CAST(b.score AS VARCHAR),
         '' ORDER BY b.place), '') AS line
FROM {source} d LEFT JOIN {name}_best b ON b.doc_id = d.doc_id GROUP BY d.doc_id"""


oracle("annot_mentions", _mention_lines("doc", "doc_rows", "doc_id"))
oracle("article_link", _mention_lines("article", "article_texts", "stream_id"))
oracle("annot_render", """
SELECT d.doc_id, coalesce(r.parts, '') || substr(d.tx, CAST(coalesce(r.done, 0) AS BIGINT) + 1) AS rendered
FROM doc_rows d LEFT JOIN (
  SELECT doc_id, max(c_end) AS done, string_agg(
      substr(tx, CAST(last_end AS BIGINT) + 1, CAST(c_start - last_end AS BIGINT)) || '<a href="#" onmouseover=''manage(' || entity || ')'' >'
      || substr(tx, CAST(c_start AS BIGINT) + 1, CAST(c_end - c_start AS BIGINT)) || '</a>', '' ORDER BY c_start) AS parts
  FROM (SELECT b.*, d.tx, coalesce(lag(b.c_end) OVER (PARTITION BY b.doc_id ORDER BY b.c_start), 0) AS last_end
        FROM doc_best b JOIN doc_rows d ON d.doc_id = b.doc_id) GROUP BY doc_id) r ON r.doc_id = d.doc_id
""")
oracle("entity_label", """
SELECT b.doc_id, CAST(b.c_start AS INTEGER) AS start, b.entity, l.label
FROM doc_best b LEFT JOIN (
  SELECT target, spot AS label FROM (
    SELECT target, spot, sum(count(*)) OVER (PARTITION BY target) AS links,
           row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, spot) AS place FROM link_rows GROUP BY target, spot)
  WHERE place = 1 AND links > 1) l ON l.target = b.entity
""")

part("edge_rows", "SELECT DISTINCT page, target FROM link_rows")
part("in_rows", "SELECT target, count(*) AS n FROM edge_rows GROUP BY target")
def _vote_parts(name: str, clean: str) -> None:
    """What the candidates of a text's mentions receive from the mentions around them."""
    part(f"{name}near_rows", f"""
SELECT a.doc_id, a.ord, a.spot, b.spot AS other, b.lp AS other_lp FROM {clean}_clean a JOIN {clean}_clean b
  ON b.doc_id = a.doc_id AND b.ord BETWEEN a.ord - 30 AND a.ord + 30 AND b.ord <> a.ord
""")
    part(f"{name}near_choices", f"""
SELECT p.spot, p.other, x.entity, y.entity AS other_entity, y.commonness, s.n_cand
FROM (SELECT DISTINCT spot, other FROM {name}near_rows) p JOIN choice_rows x ON x.spot = p.spot
JOIN choice_rows y ON y.spot = p.other JOIN spot_rows s ON s.spot = p.other
""")
    part(f"{name}related_rows", f"""
SELECT q.a, q.b, coalesce(s.c, 0) AS shared,
       CASE WHEN s.c IS NULL THEN 0.0 WHEN least(x.n, y.n) = w.n THEN 1.0
            ELSE greatest(0.0, 1 - (ln(greatest(x.n, y.n)) - ln(s.c)) / (ln(w.n) - ln(least(x.n, y.n)))) END AS rel
FROM (SELECT DISTINCT least(entity, other_entity) AS a, greatest(entity, other_entity) AS b
      FROM {name}near_choices WHERE entity <> other_entity) q
JOIN in_rows x ON x.target = q.a JOIN in_rows y ON y.target = q.b
LEFT JOIN (SELECT e.target AS a, f.target AS b, count(*) AS c FROM edge_rows e JOIN edge_rows f ON f.page = e.page AND e.target < f.target
           GROUP BY 1, 2) s ON s.a = q.a AND s.b = q.b
CROSS JOIN (SELECT count(*) AS n FROM pages) w
""")
    part(f"{name}given_rows", f"""
SELECT n.spot, n.other, n.entity, sum(v.rel * n.commonness) / max(n.n_cand) AS vote,
       max(v.rel) AS rel, max(n.n_cand) = 1 AS certain
FROM {name}near_choices n JOIN (SELECT a, b, rel FROM {name}related_rows UNION ALL SELECT b, a, rel FROM {name}related_rows
                          UNION ALL SELECT DISTINCT entity, entity, 1.0 FROM choice_rows) v
  ON v.a = n.entity AND v.b = n.other_entity GROUP BY n.spot, n.other, n.entity
""")
    part(f"{name}received_rows", f"""
SELECT m.doc_id, m.ord, m.c_start, m.c_end, m.spot, m.lp, c.entity, c.commonness,
       coalesce(r.votes, 0) AS votes, coalesce(r.related, 0) AS related,
       coalesce(k.n_context, 0) AS n_context, coalesce(k.weight, 0) AS weight
FROM {clean}_clean m JOIN choice_rows c ON c.spot = m.spot
LEFT JOIN (SELECT n.doc_id, n.ord, g.entity, sum(g.vote) AS votes,
                  sum(CASE WHEN g.certain THEN g.rel * n.other_lp ELSE 0 END) AS related
           FROM {name}near_rows n JOIN {name}given_rows g ON g.spot = n.spot AND g.other = n.other GROUP BY n.doc_id, n.ord, g.entity) r
  ON r.doc_id = m.doc_id AND r.ord = m.ord AND r.entity = c.entity
LEFT JOIN (SELECT n.doc_id, n.ord, count(*) AS n_context, sum(CASE WHEN s.n_cand = 1 THEN n.other_lp ELSE 0 END) AS weight
           FROM {name}near_rows n JOIN spot_rows s ON s.spot = n.other GROUP BY n.doc_id, n.ord) k ON k.doc_id = m.doc_id AND k.ord = m.ord
""")


_vote_parts("", "doc")
_vote_parts("page_", "visible")
oracle("relatedness", "SELECT a, b, CAST(shared AS BIGINT) AS shared, round(rel, 6) AS relatedness FROM related_rows")

part("vote_choice", """
SELECT doc_id, c_start, c_end, spot, entity,
       round((lp + CASE WHEN n_context > 0 THEN votes / n_context ELSE 0 END) / 2, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY commonness DESC, entity) AS place
      FROM (SELECT *, max(votes) OVER (PARTITION BY doc_id, ord) AS top FROM received_rows)
      WHERE round(votes, 6) >= round(top * (1 - 0.7::DOUBLE), 6))
WHERE place = 1
""")
part("score_choice", """
SELECT doc_id, c_start, c_end, spot, entity, score
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY score DESC, commonness DESC, entity DESC) AS best
      FROM (SELECT *, round(1 / (1 + exp(-(-3.0 + 2.0 * round(lp, 6) + 3.0 * round(commonness, 6)
                + 1.5 * round(CASE WHEN weight > 0 THEN related / weight ELSE 0 END, 6) + 0.1 * round(weight, 6)))), 6) AS score
            FROM received_rows)) WHERE best = 1
""")


def _best(name: str) -> str:
    """The first 50 annotations of a text by score, and of those the confident ones."""
    return f"""
SELECT doc_id, {_PLACE}, spot, entity, score
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c_start, c_end) AS place FROM {name})
WHERE place <= 50 AND score >= 0.1"""


oracle("link_tagme", f"SELECT doc_id, {_PLACE}, spot, entity, score FROM vote_choice")
oracle("link_features", f"""
SELECT doc_id, {_PLACE}, spot, entity, round(lp, 6) AS link_probability, round(commonness, 6) AS commonness,
       round(CASE WHEN weight > 0 THEN related / weight ELSE 0 END, 6) AS context_relatedness, round(weight, 6) AS context_weight
FROM received_rows
""")
oracle("link_training", f"""
SELECT r.doc_id, {_PLACE}, r.spot, r.entity, round(lp, 6) AS link_probability, round(commonness, 6) AS commonness,
       round(CASE WHEN weight > 0 THEN related / weight ELSE 0 END, 6) AS context_relatedness, round(weight, 6) AS context_weight,
       CAST(list_contains(l.targets, r.entity) AS INTEGER) AS label, CAST(('0x' || substr(md5(r.doc_id), 1, 4))::INTEGER % 5 AS INTEGER) AS fold
FROM page_received_rows r JOIN (SELECT page, spot, list(DISTINCT target) AS targets FROM link_rows GROUP BY page, spot) l
  ON l.page = r.doc_id AND l.spot = r.spot
""")
oracle("link_mlscore", _best("score_choice"))
oracle("link_choice", " UNION ALL ".join(
    f"SELECT *, '{method}' AS method FROM ({_best(name)})"
    for method, name in (("prior", "doc_prior"), ("tagme", "vote_choice"), ("wikiminer", "score_choice"))))
oracle("annotate_hook", """
SELECT doc_id, CAST(len(f) AS INTEGER) AS n, array_to_string(f, ' ') AS found
FROM (SELECT doc_id, regexp_extract_all(tx, '[A-Za-z]{12,}') AS f FROM doc_rows) WHERE len(f) > 0
""")

# --- streaming --------------------------------------------------------------

oracle("stream_docs_per_day", ORACLE["docs_per_day"])
oracle("stream_entity_day", """
SELECT CAST(left(strftime(to_timestamp(c.ticks) AT TIME ZONE 'UTC', '%Y%m%d'), 8) AS INTEGER) AS day, r.entity, CAST(sum(r.cnt) AS BIGINT) AS total
FROM count_rows r JOIN corpus_rows c ON c.doc_id = r.doc_id GROUP BY 1, 2
""")
oracle("stream_chunks", "SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents GROUP BY source")
oracle("stream_dedup", "SELECT stream_id, doc_id FROM corpus_rows")
