"""SQL twins of the registered queries, for an independent SQL engine."""

from __future__ import annotations

from citewell.functions.vocab import STOP_WORDS, VENUE_ALIASES
from citewell.plans import registered as reg
from citewell.operators.grid import YEARS
from citewell.functions.vocab import CONFERENCES

SQL: dict[str, str] = {}

_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"


def _normal(x: str) -> str:
    return f"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '{_SPACES}+', ' ', 'g'))"


def _key(x: str) -> str:
    """Match key of a text without an arXiv prefix."""
    return f"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


_TITLE = "split_part(text, chr(10), 1)"
_STOPS = ", ".join(_quoted(w) for w in STOP_WORDS)
_SOURCE_NO = "CAST(substr(source, 4) AS INTEGER)"

_PAPERS = f"""papers AS (
  SELECT doc_id AS id, {_TITLE} AS title, {_normal(_TITLE)} AS title_normalized,
    CASE {_SOURCE_NO} % 4 WHEN 0 THEN 'CVPR' WHEN 1 THEN 'ICCV' WHEN 2 THEN 'ECCV' END AS venue,
    CASE WHEN doc_id % 17 <> 0 THEN CAST(2022 + (doc_id // 20) % 4 AS INTEGER) END AS "year",
    'doc:' || doc_id AS dblp_key,
    CASE WHEN (doc_id // 3) % 10 = 0 THEN 'user-import' ELSE 'Conference' END AS paper_type,
    CASE WHEN (doc_id // 7) % 5 <> 0 THEN text END AS abstract,
    [lang, source] AS keywords, source AS source_query, CAST(NULL AS VARCHAR) AS doi
  FROM documents)"""

_DOC = (
    "concat_ws(' ', nullif(title, ''), nullif(abstract, ''), nullif(array_to_string(keywords, ' '), ''))"
)


def _tokens(x: str) -> str:
    masked = rf"regexp_replace(lower({x}), '[^\x00-\x7F\pP\pS\pZ\pC\pM]', '_', 'g')"
    return rf"list_filter(regexp_extract_all({masked}, '\b[a-z][a-z0-9-]{{2,}}\b'), lambda t: t NOT IN ({_STOPS}))"


_TOKENS = f"{_PAPERS}, tokens AS (SELECT id AS paper_id, {_tokens(_DOC)} AS t FROM papers)"
_VOCAB = f"""{_TOKENS},
grams AS (
  SELECT paper_id, unnest(t) AS term FROM tokens
  UNION ALL
  SELECT paper_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM tokens),
doc_terms AS (SELECT paper_id, term, count(*) AS tf FROM grams GROUP BY ALL),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM doc_terms GROUP BY term
          ORDER BY n DESC, term LIMIT 4000)"""
_WEIGHTS = f"""{_VOCAB},
raw AS (SELECT paper_id, term, tf * (ln((1.0 + (SELECT count(*) FROM papers)) / (1.0 + df)) + 1.0) AS w
        FROM doc_terms JOIN vocab USING (term)),
norms AS (SELECT paper_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY paper_id),
weights AS (SELECT paper_id, term, w / norm AS weight FROM raw JOIN norms USING (paper_id))"""
_STATS = f"""{_WEIGHTS},
stats AS (SELECT term AS keyword, count(*) AS paper_count, sum(weight) AS total FROM weights GROUP BY term),
ranked AS (SELECT keyword, paper_count, round(total, 6) AS weight,
             CAST(row_number() OVER (ORDER BY paper_count DESC, round(total, 9) DESC, keyword) AS INTEGER) AS rank
           FROM stats QUALIFY rank <= 80)"""
_TRENDS = f"""{_VOCAB},
trend AS (SELECT term AS keyword, upper(venue) AS venue, "year", count(*) AS paper_count
          FROM doc_terms JOIN vocab USING (term) JOIN papers ON paper_id = id
          WHERE upper(venue) IN ('CVPR', 'ICCV', 'ECCV') AND "year" <> 0 AND paper_type <> 'user-import'
          GROUP BY ALL)"""

_NEWEST = '"year" DESC NULLS LAST, title, id'

SQL["normalized_titles"] = f"WITH {_PAPERS} SELECT id, title_normalized FROM papers"
SQL["match_keys"] = f"SELECT item_id, {_key('text')} AS match_key FROM benchmark"
SQL["analysis_documents"] = (
    f"WITH {_PAPERS}, d AS (SELECT id, {_DOC} AS doc FROM papers) SELECT id, md5(doc) AS document_md5, length(doc) AS n_chars FROM d"
)
SQL["token_df"] = (
    f"WITH {_TOKENS}, w AS (SELECT unnest(list_distinct(t)) AS term FROM tokens) SELECT term, count(*) AS df FROM w GROUP BY term"
)
SQL["conversation_token_df"] = (
    f"WITH w AS (SELECT unnest(list_distinct({_tokens('text')})) AS term FROM conversations) SELECT term, count(*) AS df FROM w GROUP BY term"
)
SQL["vocab_4000"] = f"WITH {_VOCAB} SELECT term, n FROM vocab"
SQL["tfidf_weights"] = f"WITH {_WEIGHTS} SELECT paper_id, term, round(weight, 6) AS weight FROM weights"
SQL["keyword_weight"] = f"WITH {_STATS} SELECT keyword, paper_count, round(total, 6) AS weight FROM stats"
SQL["top_keywords"] = f"WITH {_STATS} SELECT keyword, paper_count, weight, rank FROM ranked"
SQL["keyword_link_table"] = (
    f"WITH {_STATS} SELECT keyword, paper_id FROM ranked JOIN doc_terms ON keyword = term"
)
SQL["drilldown"] = f"""WITH {_STATS}
SELECT id, title, venue, "year" FROM ranked JOIN doc_terms ON keyword = term JOIN papers ON id = paper_id
WHERE keyword = '{reg.DRILLDOWN_KEYWORD}' ORDER BY {_NEWEST} LIMIT 100"""
SQL["paper_vectors"] = f"""WITH {_WEIGHTS}
SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY round(weight, 6) DESC, term) - 1 AS INTEGER) AS position,
  term, round(weight, 6) AS weight
FROM weights QUALIFY position < 60"""
SQL["trends_all"] = f'WITH {_TRENDS} SELECT keyword, venue, "year", paper_count FROM trend'
SQL["trends_selected"] = f"""WITH {_TRENDS}
SELECT keyword, venue, "year", paper_count FROM trend
WHERE keyword IN (SELECT unnest({_tokens('text')}) FROM benchmark)"""
SQL["trends_listed"] = (
    f"WITH {_TRENDS} SELECT keyword, venue, \"year\", paper_count FROM trend WHERE keyword IN ('{reg.DRILLDOWN_KEYWORD}', 'que')"
)
SQL["trend_year_venue_axes"] = f"""WITH {_TRENDS}
SELECT (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST("year" AS VARCHAR) AS y FROM trend)) AS years,
  (SELECT string_agg(v, ',' ORDER BY p) FROM (VALUES ('CVPR', 1), ('ICCV', 2), ('ECCV', 3)) c(v, p)
   WHERE v IN (SELECT venue FROM trend)) AS venues"""
SQL["title_cased_terms"] = f"""WITH {_VOCAB}
SELECT term, array_to_string(list_transform(string_split(term, ''), lambda c, i:
  CASE WHEN i = 1 OR NOT regexp_matches(substr(term, i - 1, 1), '[a-z]') THEN upper(c) ELSE c END), '') AS label FROM vocab"""
SQL["run_metadata"] = """SELECT count(*) AS paper_count,
  CAST(CASE WHEN count(*) <= 1 THEN 1 ELSE least(10, greatest(2, round_even(sqrt(count(*)), 0))) END AS INTEGER) AS cluster_count,
  'tfidf' AS vectorizer, 'kmeans' AS clusterer FROM documents"""

_SHOWN = 'id, title, venue, "year"'
SQL["list_all"] = f"WITH {_PAPERS} SELECT {_SHOWN} FROM papers ORDER BY {_NEWEST} LIMIT 1000"
SQL["get_paper"] = f"WITH {_PAPERS} SELECT {_SHOWN} FROM papers WHERE id = 7"

_FIELDS = f"""{_PAPERS}, fields AS (SELECT *, lower(coalesce(venue, '')) AS f_venue, lower(coalesce(dblp_key, '')) AS f_key,
  lower('["' || array_to_string(keywords, '", "') || '"]') AS f_words FROM papers)"""


def _like(q: str) -> str:
    return " OR ".join(f"{c} LIKE '%' || {q} || '%'" for c in ("title_normalized", "f_venue", "f_key", "f_words"))


def _search(text: str) -> str:
    return f"WITH {_FIELDS} SELECT {_SHOWN} FROM fields WHERE {_like(_quoted(text.lower()))} ORDER BY {_NEWEST} LIMIT 50"


SQL["search_like"] = _search(reg.SEARCH_TEXT)
SQL["search_wildcard"] = _search(reg.WILDCARD_TEXT)
SQL["search_exact"] = f"""WITH {_PAPERS} SELECT {_SHOWN} FROM papers
WHERE title_normalized = {_quoted(' '.join(reg.EXACT_TITLE.lower().split()))} ORDER BY "year" DESC NULLS LAST, id LIMIT 50"""
SQL["backlog"] = f"""WITH {_PAPERS} SELECT {_SHOWN} FROM papers WHERE abstract IS NULL OR trim(abstract) = ''
ORDER BY CASE WHEN venue IN ('CVPR', 'ICCV', 'ECCV') THEN 0 ELSE 1 END, "year" DESC NULLS LAST, id LIMIT 200"""

_ASKED = f"""asked AS (
  SELECT item_id AS query_id, concat_ws(' ',
    CASE WHEN item_id % 3 = 0 THEN 'venue:' || ['cvpr', 'Iccv', 'ECCV'][item_id % 9 // 3 + 1] END, text,
    CASE WHEN item_id % 4 = 1 THEN 'year:' || (2022 + item_id % 5) END) AS query FROM benchmark
  UNION ALL SELECT 1000000000 + doc_id, {_TITLE} FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT 2000000000 + min(doc_id), source FROM documents GROUP BY source
  UNION ALL SELECT 3000000000 + doc_id, 'year:' || (2022 + doc_id % 5) || ' venue:' || ['cvpr', 'Iccv', 'ECCV'][doc_id % 9 // 3 + 1]
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
parsed AS (
  SELECT query_id,
    {_normal(r"regexp_replace(query, '(?i)\b(?:venue:(?:CVPR|ICCV|ECCV)|year:20\d{2})\b', '', 'g')")} AS text,
    nullif(upper(regexp_extract(query, '(?i)\\bvenue:(CVPR|ICCV|ECCV)\\b', 1)), '') AS want_venue,
    CAST(nullif(regexp_extract(query, '(?i)\\byear:(20\\d{{2}})\\b', 1), '') AS INTEGER) AS want_year FROM asked)"""
_NAMED = " OR ".join(
    f"(want_venue = '{v}' AND contains(upper(coalesce(venue, '')), '{a}'))" for v, names in VENUE_ALIASES.items() for a in names
)
_FACETS = f'(want_year IS NULL OR "year" = want_year) AND (want_venue IS NULL OR {_NAMED})'
_MATCHES = f"{_FIELDS}, {_ASKED}, matches AS (SELECT query_id, f.* FROM fields f, parsed p WHERE ({_like('p.text')}) AND {_FACETS})"

SQL["parsed_queries"] = f"WITH {_ASKED} SELECT query_id, text, want_venue, want_year FROM parsed"
SQL["batch_search"] = f"""WITH {_MATCHES}
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {_NEWEST}) AS INTEGER) AS position, id, "year", venue
FROM matches QUALIFY position <= 20"""
SQL["batch_matches"] = f"WITH {_MATCHES} SELECT query_id, count(*) AS matches, max(id) AS last_id FROM matches GROUP BY query_id"
SQL["facet_counts"] = f"""WITH {_PAPERS} SELECT 'venue:' || venue || ' year:' || "year" AS query_id, count(*) AS matches
FROM papers WHERE venue IS NOT NULL AND "year" BETWEEN {YEARS[0]} AND {YEARS[-1]} GROUP BY ALL"""
SQL["stored_of_fetched"] = f"WITH {_PAPERS} SELECT id, title FROM papers WHERE dblp_key IN (SELECT 'doc:' || doc_id FROM labels)"

_FLAT = (
    'id, title, title_normalized, venue, "year", doi, dblp_key, paper_type, source_query, md5(abstract) AS abstract_md5, '
    "array_to_string(keywords, ',') AS keywords"
)
_BATCH = f"""batch AS (
  SELECT doc_id AS seq, 'Batch ' || {_TITLE} AS title, {_normal(f"'Batch ' || {_TITLE}")} AS title_normalized,
    CASE WHEN doc_id % 3 = 0 THEN 'Workshop ' || lang END AS venue,
    CASE WHEN doc_id % 4 <> 0 THEN CAST(2000 + doc_id % 20 AS INTEGER) END AS "year",
    CASE WHEN doc_id % 6 = 0 THEN '10.1/' || doc_id END AS doi,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'new:' || (doc_id // 10) ELSE 'doc:' || (doc_id // 2) END AS dblp_key,
    CASE WHEN doc_id % 7 = 0 THEN text END AS abstract, CASE WHEN doc_id % 2 = 0 THEN [source] END AS keywords
  FROM documents),
folded AS (
  SELECT dblp_key, min(seq) AS seq, arg_max(title, seq) AS title, arg_max(title_normalized, seq) AS title_normalized,
    arg_max(venue, seq) FILTER (venue IS NOT NULL) AS venue, arg_max("year", seq) FILTER ("year" IS NOT NULL) AS "year",
    arg_max(doi, seq) FILTER (doi IS NOT NULL) AS doi, arg_max(abstract, seq) FILTER (abstract IS NOT NULL) AS abstract,
    arg_max(keywords, seq) FILTER (keywords IS NOT NULL) AS keywords
  FROM batch WHERE dblp_key IS NOT NULL GROUP BY dblp_key
  UNION ALL SELECT dblp_key, seq, title, title_normalized, venue, "year", doi, abstract, keywords FROM batch WHERE dblp_key IS NULL)"""


def _merged(source: str) -> str:
    return f"""{_PAPERS}, {_BATCH}, merged AS (
  SELECT p.id, coalesce(f.title, p.title) AS title, coalesce(f.title_normalized, p.title_normalized) AS title_normalized,
    coalesce(f.venue, p.venue) AS venue, coalesce(f."year", p."year") AS "year", coalesce(f.doi, p.doi) AS doi, p.dblp_key,
    CASE WHEN f.seq IS NULL THEN p.paper_type ELSE 'batch' END AS paper_type,
    CASE WHEN f.seq IS NULL THEN p.source_query ELSE '{source}' END AS source_query,
    coalesce(f.abstract, p.abstract) AS abstract, coalesce(f.keywords, p.keywords) AS keywords
  FROM papers p LEFT JOIN folded f ON p.dblp_key = f.dblp_key
  UNION ALL
  SELECT (SELECT max(id) FROM papers) + row_number() OVER (ORDER BY f.seq), f.title, f.title_normalized, f.venue, f."year",
    f.doi, f.dblp_key, 'batch', '{source}', f.abstract, coalesce(f.keywords, [])
  FROM folded f WHERE f.dblp_key IS NULL OR f.dblp_key NOT IN (SELECT dblp_key FROM papers))"""


SQL["merge_upsert"] = f"WITH {_merged('batch-1')} SELECT {_FLAT} FROM merged"
SQL["update_papers"] = f"""WITH {_PAPERS},
edits AS (SELECT doc_id, 'Edited ' || source AS t, CASE WHEN quality = 1 THEN 'ECCV' END AS v,
  CASE WHEN toxic = 0 THEN 2024 END AS y, [lang, 'new'] AS k FROM labels JOIN documents USING (doc_id)),
edited AS (
  SELECT id, coalesce(t, title) AS title, CASE WHEN t IS NULL THEN title_normalized ELSE lower(t) END AS title_normalized,
    CASE WHEN t IS NULL THEN venue ELSE v END AS venue, CAST(CASE WHEN t IS NULL THEN "year" ELSE y END AS INTEGER) AS "year", doi, dblp_key,
    paper_type, source_query, abstract, coalesce(k, keywords) AS keywords FROM papers LEFT JOIN edits ON id = doc_id)
SELECT {_FLAT} FROM edited"""
SQL["set_abstracts"] = f"""WITH {_PAPERS}, done AS (
  SELECT p.* EXCLUDE (abstract, keywords), CASE WHEN l.doc_id IS NULL THEN p.abstract ELSE 'Quality ' || l.quality END AS abstract,
    CASE WHEN l.toxic = 1 THEN ['flagged'] ELSE p.keywords END AS keywords FROM papers p LEFT JOIN labels l ON id = doc_id)
SELECT {_FLAT} FROM done"""
SQL["delete_ids"] = f"WITH {_PAPERS} SELECT {_FLAT} FROM papers WHERE id NOT IN (SELECT doc_id FROM labels)"
SQL["deleted_rows"] = "SELECT count(*) AS deleted FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"
SQL["purge_source"] = f"WITH {_PAPERS} SELECT {_FLAT} FROM papers WHERE source_query IS DISTINCT FROM 'src3'"
SQL["fill_venues"] = f"""WITH {_PAPERS},
missing AS (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM papers WHERE venue IS NULL OR trim(venue) = '')
SELECT p.id, CASE (rn - 1) % 3 WHEN 0 THEN 'CVPR' WHEN 1 THEN 'ICCV' WHEN 2 THEN 'ECCV' ELSE venue END AS venue, "year"
FROM papers p LEFT JOIN missing m ON p.id = m.id"""
SQL["paper_count"] = "SELECT count(*) AS paper_count FROM documents"
SQL["key_violations"] = """SELECT '10.5/' || (doc_id // 3) AS doi, count(*) AS paper_count FROM documents WHERE doc_id % 7 <> 0
GROUP BY 1 HAVING count(*) > 1"""
SQL["doi_clashes"] = """WITH d AS (SELECT doc_id, '10.9/' || source || '/' || (doc_id // 30) AS doi FROM documents)
SELECT doi, count(*) AS paper_count FROM d
WHERE doi IN (SELECT doi FROM d JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY doi HAVING count(*) > 1"""

_COLLECTED = f"""collected AS (
  SELECT doc_id AS _seq, {_TITLE} AS title, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN ' k' || (doc_id // 4) END AS dblp_key,
    CASE WHEN doc_id % 5 = 0 THEN '10.2/' || (doc_id // 20) END AS doi, source AS venue FROM documents
  UNION ALL SELECT 1000000000 + p_partkey, upper(p_name), NULL, NULL, p_brand FROM part)"""
SQL["union_sources"] = f"WITH {_COLLECTED} SELECT _seq, title, venue FROM collected"
SQL["dedup_first"] = f"""WITH {_COLLECTED} SELECT _seq, title, dblp_key, doi, venue FROM collected
QUALIFY row_number() OVER (PARTITION BY trim(coalesce(nullif(dblp_key, ''), nullif(doi, ''), lower(title))) ORDER BY _seq) = 1"""
SQL["cap_per_source"] = """SELECT source, doc_id AS _seq FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20"""

_CANONICAL = (
    "CASE WHEN contains(upper({0}), 'CVPR') THEN 'CVPR' WHEN contains(upper({0}), 'ICCV') THEN 'ICCV' "
    "WHEN contains(upper({0}), 'ECCV') THEN 'ECCV' END"
)
SQL["venue_backfill"] = f"""WITH {_PAPERS},
known AS (SELECT title_normalized AS t, {_CANONICAL.format("['CVPR Workshops', 'Nowhere', 'Proc. eccv'][id % 3 + 1]")} AS v,
    CAST(2010 + id % 10 AS INTEGER) AS y, id AS seq FROM papers),
found AS (SELECT t, arg_min(v, seq) AS v, arg_min(y, seq) AS y FROM known WHERE v IS NOT NULL GROUP BY t)
SELECT id, title, coalesce(venue, v) AS venue, CASE WHEN venue IS NULL THEN coalesce("year", y) ELSE "year" END AS "year"
FROM papers LEFT JOIN found ON title_normalized = t"""
SQL["venue_backfill_parts"] = f"""WITH known AS (
  SELECT p_name AS t, p_partkey AS seq, nullif(p_size, 0) AS y,
    {_CANONICAL.format("['iccv 2023', 'none', '', 'CVPR'][CAST(split_part(p_brand, '#', 2) AS INTEGER) % 4 + 1]")} AS v FROM part),
found AS (SELECT t, arg_min(v, seq) AS v, arg_min(y, seq) AS y FROM known WHERE v IS NOT NULL GROUP BY t)
SELECT p_partkey AS id, p_name, coalesce(v, '') AS venue, y AS "year" FROM part LEFT JOIN found ON p_name = t"""

_FIRST = f"doc_id % 3 = 0 AND {_SOURCE_NO} % 10 < 6"
_HITS = f"""hits AS (
  SELECT 'q' || doc_id % 70 AS query_id, CASE WHEN {_FIRST} THEN 'OpenAlex' ELSE 'Crossref' END AS source,
    CASE WHEN {_FIRST} THEN 0 ELSE 1 END AS priority, doc_id AS _seq, {_TITLE} AS title, CAST(2000 + doc_id % 25 AS INTEGER) AS "year"
  FROM documents),
won AS (SELECT query_id, min(priority) AS priority FROM hits GROUP BY query_id)"""
SQL["source_priority"] = f"WITH {_HITS} SELECT query_id, source, _seq FROM hits JOIN won USING (query_id, priority)"
SQL["sources_without_answer"] = f"""WITH {_HITS}, asked AS (SELECT DISTINCT 'q' || doc_id % 90 AS query_id FROM documents)
SELECT a.query_id, s.source FROM asked a LEFT JOIN won USING (query_id)
JOIN (VALUES ('OpenAlex', 0), ('Crossref', 1)) s(source, priority) ON won.priority IS NULL OR s.priority < won.priority"""
SQL["local_first"] = f"""WITH {_FIELDS}, {_HITS},
asked AS (SELECT 'q' || item_id AS query_id, {_normal('text')} AS q FROM benchmark
  UNION ALL SELECT 's' || min(doc_id), {_normal('source')} FROM documents GROUP BY source),
local AS (SELECT query_id, 'local' AS source,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY {_NEWEST}) AS INTEGER) AS position, title, "year"
  FROM fields, asked WHERE {_like('q')} QUALIFY position <= 20),
remote AS (SELECT query_id, source, CAST(row_number() OVER (PARTITION BY query_id ORDER BY _seq) AS INTEGER) AS position, title, "year"
  FROM hits JOIN won USING (query_id, priority)
  WHERE query_id IN (SELECT query_id FROM asked) AND query_id NOT IN (SELECT query_id FROM local) QUALIFY position <= 20)
SELECT * FROM local UNION ALL SELECT * FROM remote"""

_WORDS = f"list_distinct(list_filter(string_split({_key('title')}, ' '), lambda w: w <> ''))"
SQL["title_lookup"] = f"""WITH {_PAPERS},
postings AS (SELECT id AS _seq, title, unnest({_WORDS}) AS word FROM papers WHERE trim(abstract) <> ''),
spread AS (SELECT word, count(*) AS n FROM postings GROUP BY word),
wanted AS (SELECT id AS paper_id, title AS query, unnest({_WORDS}) AS word FROM papers WHERE abstract IS NULL OR trim(abstract) = ''),
rarest AS (SELECT paper_id, query, word FROM wanted JOIN spread USING (word)
  QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY n, word) = 1)
SELECT paper_id, query, _seq, title FROM rarest JOIN postings USING (word)"""
SQL["abstract_match_equal"] = f"""WITH {_PAPERS},
firsts AS (SELECT {_key('title')} AS k, arg_min(abstract, id) AS abstract FROM papers WHERE trim(abstract) <> '' GROUP BY 1)
SELECT id, md5(firsts.abstract) AS abstract_md5, 1.0::DOUBLE AS similarity FROM papers JOIN firsts ON {_key('title')} = k
WHERE papers.abstract IS NULL OR trim(papers.abstract) = ''"""
SQL["grid_coverage"] = f"""WITH {_PAPERS},
cells AS (SELECT venue, "year" FROM (VALUES {', '.join(f"('{v}', {y})" for v in CONFERENCES for y in YEARS)}) c(venue, "year"))
SELECT c.venue, c."year", count(p.id) AS paper_count FROM cells c
LEFT JOIN papers p ON contains(upper(p.venue), c.venue) AND p."year" = c."year" GROUP BY ALL"""

_UNTAGGED = "regexp_replace({0}, '<[^>]+>', ' ', 'g')"
# Entities that occur in the page table; the ampersand itself is decoded last.
_ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"))


def _decoded(x: str) -> str:
    for entity, char in _ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


SQL["strip_tags"] = f"SELECT page_id, {_UNTAGGED.format('html')} AS body FROM pages"
SQL["strip_markup"] = f"SELECT page_id, {_UNTAGGED.format(_decoded('html'))} AS body FROM pages"
SQL["hash_keys"] = f"""SELECT doc_id, 'user-import:' || substr(sha256({_normal(_TITLE)}), 1, 24) AS import_key,
  'local-pdf:' || substr(sha256('/data/' || {_TITLE}), 1, 24) AS path_key, 'openalex:' || {_TITLE} AS provider_key FROM documents"""
SQL["doi_urls"] = "SELECT doc_id, 'https://doi.org/10.1/' || doc_id AS url FROM documents"
SQL["inverted_abstract"] = "SELECT doc_id, md5(text) AS text_md5 FROM documents"
SQL["canonical_venues"] = f"""WITH {_PAPERS},
named AS (SELECT id, CASE WHEN id % 2 = 0 THEN 'Proc. ' || coalesce(lower(venue), 'misc') || ' and ECCV' ELSE venue END AS v FROM papers)
SELECT id, {_CANONICAL.format('v')} AS venue FROM named"""
SQL["keyword_lists"] = f"""WITH parts AS (
  SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), ','), ','), lambda k: {_stripped('k')}), lambda k: k <> '') AS ks FROM documents),
numbered AS (SELECT doc_id, unnest(range(len(ks))) AS position, ks FROM parts)
SELECT doc_id, CAST(position AS INTEGER) AS position, ks[position + 1] AS keyword FROM numbered"""

_TITLE_KEY = "'{0}:' || substr(sha256({1}), 1, 24)"
SQL["import_records"] = f"""WITH r AS (SELECT doc_id, {_stripped(_TITLE)} AS title, lang, source, text FROM documents WHERE doc_id % 13 <> 0)
SELECT title, CASE WHEN doc_id % 2 = 0 THEN lang || ',' || source ELSE '' END AS authors,
  CASE WHEN doc_id % 4 <> 0 THEN CAST(2000 + doc_id % 25 AS INTEGER) END AS "year",
  CASE WHEN doc_id % 3 = 0 THEN 'k:' || doc_id ELSE {_TITLE_KEY.format('bulk-import', _normal('title'))} END AS dblp_key,
  'bulk-import' AS paper_type, md5(text) AS abstract_md5 FROM r WHERE title <> ''"""
SQL["import_titles"] = f"""WITH lines AS (SELECT {_stripped('unnest(string_split(text, chr(10)))')} AS title FROM documents)
SELECT title, 'CVPR' AS venue, 2025 AS "year", {_TITLE_KEY.format('user-import', _normal('title'))} AS dblp_key,
  'user-import' AS paper_type, count(*) AS n FROM lines WHERE title <> '' GROUP BY ALL"""
SQL["dblp_pages"] = f"""SELECT 'conf/' || doc_id AS dblp_key, {_stripped(_TITLE)} AS title,
  CASE WHEN doc_id % 3 = 2 THEN source || ',' || lang ELSE lang END AS authors, source AS venue,
  CASE WHEN doc_id % 9 <> 0 THEN CAST(2000 + doc_id % 25 AS INTEGER) END AS "year",
  CASE WHEN doc_id % 2 = 0 THEN 'http://x/' ELSE 'http://y/' END || doc_id AS links, 'Conference' AS paper_type
FROM documents WHERE {_stripped(_TITLE)} <> ''"""
SQL["openalex_pages"] = f"""WITH r AS (SELECT *, {_stripped(_TITLE)} AS title,
  CASE WHEN doc_id % 4 <> 0 THEN 'European Conference on Computer Vision' ELSE source END AS venue, CAST(2022 + doc_id % 3 AS INTEGER) AS "year" FROM documents)
SELECT 'openalex:' || CASE WHEN doc_id % 3 <> 0 THEN 'W' || doc_id ELSE title END AS dblp_key, title, lang AS authors, venue, "year",
  CASE WHEN doc_id % 5 <> 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'https://doi.org/' ELSE '' END || '10.1/' || doc_id END AS doi,
  CASE WHEN doc_id % 5 <> 0 THEN 'https://doi.org/10.1/' || doc_id ELSE '' END AS links, md5(text) AS abstract_md5, source AS keywords
FROM r WHERE title <> '' AND (doc_id % 2 = 1 OR ("year" = 2023 AND venue LIKE 'European%'))"""
SQL["crossref_pages"] = f"""SELECT 'crossref:' || CASE WHEN page_id % 2 = 0 THEN '10.3/' || page_id ELSE url END AS dblp_key, url AS title,
  'Ada Lee,' AS authors, CASE WHEN page_id % 3 = 0 THEN 'ICCV' END AS venue,
  CAST(CASE page_id % 4 WHEN 0 THEN 2000 + page_id % 20 WHEN 1 THEN NULL ELSE 1990 + page_id % 5 END AS INTEGER) AS "year",
  CASE WHEN page_id % 5 <> 0 THEN url ELSE '' END AS links,
  CASE WHEN page_id % 6 <> 0 THEN md5({_UNTAGGED.format(_decoded('html'))}) END AS abstract_md5, 'Vision' AS keywords FROM pages"""
SQL["pdf_listing"] = r"""WITH p AS (SELECT doc_id, lang, source, ['/data/ICCV2025/', '/data/CV 2024 综述/', '/x/cvpr papers/', '/y/ECCV1999/'][doc_id % 4 + 1] || doc_id || '/'
    || lang || '_' || source || CASE WHEN doc_id % 3 = 0 THEN ' CVPR 2023 paper_final' ELSE '__v1. ' END || '.pdf' AS path
  FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0)
SELECT lang || ' ' || source || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' v1' END AS title,
  nullif(regexp_extract(upper(path), '(CVPR|ICCV|ECCV)(?:\D|20\d{2})', 1), '') AS venue,
  CAST(nullif(regexp_extract(path, '20\d{2}'), '') AS INTEGER) AS "year", 'local-pdf:' || substr(sha256(path), 1, 24) AS dblp_key,
  'file://' || replace(replace(path, ' ', '%20'), '综述', '%E7%BB%BC%E8%BF%B0') AS uri, 'local-pdf' AS paper_type FROM p"""
SQL["batches_of_50"] = f"""WITH {_PAPERS}, n AS (SELECT id, row_number() OVER (ORDER BY {_NEWEST}) AS row_index FROM papers)
SELECT id, row_index, (row_index - 1) // 50 AS batch_no FROM n"""
SQL["lineitem_rows"] = """WITH n AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS r FROM lineitem)
SELECT (r - 1) // 1000 AS batch_no, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orderkeys, CAST(sum(r * l_linenumber) AS BIGINT) AS weighted
FROM n GROUP BY 1"""
SQL["export_json"] = f"WITH {_PAPERS} SELECT {_FLAT} FROM papers"
SQL["provenance_row"] = f"""SELECT 'saved pages' AS source, 'https://example.org/api' AS source_url,
  '{';'.join(f'venue:{v} year:{y}' for v in CONFERENCES for y in YEARS)}' AS queries, count(*) AS count FROM documents"""
SQL["stream_import"] = f"""WITH {_BATCH}
SELECT title, title_normalized, venue, "year", doi, dblp_key, 'batch' AS paper_type, 'stream' AS source_query,
  md5(abstract) AS abstract_md5, coalesce(array_to_string(keywords, ','), '') AS keywords FROM folded"""
SQL["answers_from_pages"] = f"""WITH {_FIELDS},
asked AS (SELECT min(doc_id) AS n, source FROM documents GROUP BY source),
local AS (SELECT 'local' || n AS query_id, 'local' AS source, title, "year" FROM fields, asked a WHERE {_like('lower(a.source)')}
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY {_NEWEST}) <= 1000),
hits AS (SELECT d.source, {_stripped(_TITLE)} AS title, lang = 'en' AS openalex FROM documents d WHERE {_stripped(_TITLE)} <> ''),
answers AS (SELECT source, title, 0 AS priority FROM hits WHERE openalex UNION ALL SELECT source, title, 1 FROM hits),
won AS (SELECT source, min(priority) AS priority FROM answers GROUP BY source)
SELECT query_id, source, count(*) AS n, min(title) AS first_title, max("year") AS last_year FROM local GROUP BY ALL
UNION ALL SELECT 'fetched' || a.n, CASE WHEN priority = 0 THEN 'OpenAlex' ELSE 'DBLP' END, least(count(*), 1000), min(title),
  CASE WHEN priority = 0 THEN 2024 ELSE 2023 END
FROM answers JOIN won USING (source, priority) JOIN asked a USING (source) GROUP BY a.n, priority"""
SQL["unreadable_lines"] = """SELECT count(*) FILTER (lang IN ('de', 'fr')) AS lines, count(*) FILTER (lang = 'de') AS lost,
  count(*) FILTER (lang IS NULL OR lang <> 'de') AS imported FROM documents"""
