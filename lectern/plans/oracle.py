"""The registered queries as plain SQL over the same tables, to compare results with."""

from lectern.plans import inputs

# Request rows and what the request operators make of them, one step per common table.

_URI = r"'^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?]*([^?]*)'"


def _path(uri: str) -> str:
    return f"replace(regexp_extract({uri}, {_URI}, 1), '#', '%23')"


def _stub(uri: str) -> str:
    base = rf"regexp_extract({_path(uri)}, '([^/]+)/*$', 1)"
    ext = rf"regexp_extract({_path(uri)}, '(\.[^./]*)$', 1)"
    return f"CASE WHEN {base} <> '' THEN CASE WHEN {ext} = '' THEN {base} ELSE replace({base}, {ext}, '') END END"


def _ext(uri: str) -> str:
    return rf"nullif(regexp_extract({_path(uri)}, '\.([^./]*)$', 1), '')"


def _clean(title: str) -> str:
    return rf"regexp_replace(replace({title}, ' ', '_'), '[^a-zA-Z0-9\-_]+', '', 'g')"


def _graphic(text: str) -> str:
    return rf"regexp_replace({text}, '[^\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{S}}\p{{Zs}}]', '', 'g')"


def _class(uri: str) -> str:
    site = " OR ".join(f"contains({uri}, '{s}')" for s in ("youtu.be", "www.youtube.com", "facebook.com", "vimeo.com"))
    return f"""CASE WHEN {uri} IS NULL THEN 'TEXT'
      WHEN {site} THEN CASE WHEN contains({uri}, 'playlist') THEN 'YOUTUBE_LIST' ELSE 'YOUTUBE' END
      WHEN contains({uri}, '.mp3') THEN 'AUDIO' WHEN contains({uri}, '.mp4') THEN 'VIDEO'
      WHEN contains({uri}, '.pdf') THEN 'PDF' ELSE 'TEXT' END"""


def _type_ext(kind: str, uri: str) -> str:
    return f"CASE {kind} WHEN 'URI' THEN 'uri' WHEN 'AUDIO' THEN 'mp3' WHEN 'TEXT' THEN 'txt' ELSE {_ext(uri)} END"


def _date(created: str, form: str) -> str:
    return f"strftime(make_timestamp({created} * 1000000), '{form}')"


def _file(kind: str) -> str:
    return f"""{kind} || '/' || {_date("created", "%Y/%m/%d")} || '/' || coalesce({_clean("title")}, '')
      || '.' || {_type_ext(kind, "uri")}"""


def _id(req_no: str) -> str:
    digest = f"sha256(concat('request ', {req_no}))"
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {at}, {n})" for at, n in parts)


def _requests(source: str) -> str:
    """From request rows to routed ones; `landed` holds text and title per URI and type, or nothing."""
    return f"""
raw AS ({source}),
norm AS (
 SELECT req_no, CASE WHEN coalesce(text, '') <> '' THEN 'TEXT' ELSE 'URI' END AS type,
  {_id("req_no")} AS request_hash, nullif(text, '') AS text, nullif(title, '') AS title,
  submitted_at AS created, uri, submitted_at,
  CAST(CASE WHEN words_per_minute > 0 THEN words_per_minute END AS BIGINT) AS words_per_minute
 FROM raw),
stubbed AS (
 SELECT *, CASE WHEN type = 'URI' THEN {_class("uri")} ELSE type END AS kind,
  CASE WHEN type = 'URI' THEN coalesce(title, CASE WHEN strlen({_stub("uri")}) > 4 THEN {_graphic(_stub("uri"))} END)
   ELSE title END AS title_1
 FROM norm),
classified AS (
 SELECT * EXCLUDE (type, title, kind, title_1), kind AS type,
  CASE WHEN type = 'URI' AND strlen(title_1) > 40 THEN {_graphic("substr(title_1, 1, 40)")} ELSE title_1 END AS title
 FROM stubbed),
enriched AS (
 SELECT c.* EXCLUDE (text, title),
  coalesce(c.text, l.landed_text) AS text,
  coalesce(c.title, CASE WHEN c.text IS NULL AND strlen(l.page_title) > 3 THEN
   {_graphic("CASE WHEN strlen(l.page_title) > 40 THEN substr(l.page_title, 1, 40) ELSE l.page_title END")}
   END) AS title_2
 FROM classified c LEFT JOIN landed l ON c.uri = l.uri AND c.type = l.kind),
titled AS (
 SELECT * EXCLUDE (title_2),
  CASE WHEN type = 'YOUTUBE' AND strlen(title_2) > 3 THEN {_graphic("title_2")}
   ELSE coalesce(title_2, CASE WHEN type IN ('PDF', 'TEXT') THEN nullif(substr(text, 1, 64), '') END) END AS title,
  CAST(strlen(coalesce(text, '')) AS BIGINT) AS length
 FROM enriched),
reasoned AS (
 SELECT *, CASE
  WHEN type NOT IN ('YOUTUBE', 'PDF', 'TEXT', 'AUDIO', 'VIDEO') THEN 'unknown content type'
  WHEN type IN ('PDF', 'VIDEO') AND ({_ext("uri")}) IS NULL THEN 'could not parse ext'
  WHEN type IN ('PDF', 'TEXT') AND text IS NULL THEN 'no content'
  WHEN type IN ('PDF', 'TEXT') AND length < 3 THEN 'text too short'
  WHEN strlen(coalesce({_clean("title")}, '')) < 2 THEN 'title too small' END AS reason
 FROM titled),
routed AS (
 SELECT *, type AS route, CASE WHEN reason IS NULL THEN 'ACCEPTED' ELSE 'ERROR' END AS status,
  CASE WHEN reason IS NULL THEN 'AUDIO' END AS output_type,
  CASE WHEN reason IS NULL THEN {_file("'AUDIO'")} END AS storage_path
 FROM reasoned)
"""


_ROWS = inputs.REQUESTS_SQL.format(documents="documents")
_NO_PAGES = "landed AS (SELECT '' AS uri, '' AS kind, '' AS landed_text, '' AS page_title WHERE false)"
_REQUESTS = f"WITH {_NO_PAGES}, {_requests(_ROWS)}"

# Pages.

_TOKEN = r"'(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<![^>]*>|</?[a-zA-Z][^>]*>|[^<]+'"
_BLOCKS = rf"""
page_tokens AS (
 SELECT page_id, url, unnest(regexp_extract_all(html, {_TOKEN})) AS token,
  generate_subscripts(regexp_extract_all(html, {_TOKEN}), 1) - 1 AS pos
 FROM pages),
page_marks AS (
 SELECT *, CASE WHEN token NOT LIKE '%/>' THEN
  nullif(lower(regexp_extract(token, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)), '') END AS opened
 FROM page_tokens),
page_blocks AS (
 SELECT page_id, url, CAST(pos AS BIGINT) AS pos, token AS text,
  last_value(opened IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos) AS tag
 FROM page_marks QUALIFY NOT starts_with(token, '<'))
"""


def _unescape(text: str) -> str:
    for found, wanted in (
        ("&lt;", "'<'"),
        ("&gt;", "'>'"),
        ("&quot;", "'\"'"),
        ("&#39;", "''''"),
        ("&nbsp;", "chr(160)"),
        ("&copy;", "chr(169)"),
        ("&middot;", "chr(183)"),
        ("&amp;", "'&'"),
    ):
        text = f"replace({text}, '{found}', {wanted})"
    return text


_SPACE_POINTS = (9, 10, 11, 12, 13, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_SPACE = "' ' || " + " || ".join(f"chr({n})" for n in _SPACE_POINTS)
_EXTRACTED = f"""
page_texts AS (
 SELECT page_id, url, pos, trim({_unescape("text")}, {_SPACE}) AS text
 FROM page_blocks WHERE coalesce(tag, '') NOT IN ('script', 'style', 'meta', 'link')),
extracted AS (
 SELECT p.page_id, p.url, coalesce(string_agg(t.text, '' ORDER BY t.pos), '') AS text,
  CAST(strlen(coalesce(string_agg(t.text, '' ORDER BY t.pos), '')) AS BIGINT) AS size, count(t.text) AS n_blocks
 FROM pages p LEFT JOIN page_texts t ON p.page_id = t.page_id AND strlen(t.text) > 100
 GROUP BY p.page_id, p.url)
"""
_PAGE_TITLE = "nullif(" + _unescape(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title', 1)") + ", '')"
_LANDED = f"""{_BLOCKS}, {_EXTRACTED},
landed AS (
 SELECT e.url AS uri, 'TEXT' AS kind, nullif(e.text, '') AS landed_text, {_PAGE_TITLE} AS page_title
 FROM extracted e JOIN pages p ON e.page_id = p.page_id
 QUALIFY row_number() OVER (PARTITION BY e.url ORDER BY e.page_id DESC) = 1)
"""
_PAGE_ROWS = f"SELECT *, NULL::INTEGER AS words_per_minute FROM ({inputs.PAGE_REQUESTS_SQL.format(pages='pages')})"
_PAGE_REQUESTS = f"WITH {_LANDED}, {_requests(_PAGE_ROWS)}"

_PAPER_ROWS = f"""
SELECT *, NULL::INTEGER AS words_per_minute FROM ({inputs.PAPER_REQUESTS_SQL.format(conversations="conversations")})"""
_PAPERS = f"""
WITH landed AS (
 SELECT uri, 'PDF' AS kind, nullif(string_agg(text, '' ORDER BY page_no), '') AS landed_text, NULL::VARCHAR AS page_title
 FROM ({inputs.PAPER_PAGES_SQL.format(conversations="conversations")}) WHERE text IS NOT NULL GROUP BY uri),
{_requests(_PAPER_ROWS)}"""

# Terms.

_TERMS = r"""
WITH words AS (
 SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term <> '' GROUP BY doc_id, term),
vocabulary AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, df, ln((SELECT count(*) FROM documents) / df) AS idf FROM vocabulary)
"""

# Outlines.

_SECTIONS = rf"""
WITH lines AS ({inputs.OUTLINE_SQL.format(conversations="conversations")}),
doc_pages AS ({inputs.DOCUMENT_PAGES_SQL.format(conversations="conversations")}),
markers AS (
 SELECT doc_id, line_no, regexp_extract(line, '"([^"]*)"', 1) AS name,
  CAST(regexp_extract(line, '#([0-9]+),[0-9]+,[0-9]+', 1) AS BIGINT) AS page_start
 FROM lines WHERE regexp_matches(line, '#([0-9]+),[0-9]+,[0-9]+') AND regexp_matches(line, '"([^"]*)"')),
starts AS (SELECT * REPLACE (greatest(page_start, 1) AS page_start) FROM markers),
ranges AS (
 SELECT doc_id, line_no, name, page_start,
  coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY line_no) - 1, -1) AS page_end
 FROM starts),
slices AS (
 SELECT r.doc_id, r.line_no, r.name, r.page_start, p.page_no, p.text
 FROM ranges r JOIN doc_pages p ON r.doc_id = p.doc_id AND p.page_no >= r.page_start
  AND (r.page_end = -1 OR p.page_no <= r.page_end))
"""

# State.

_HISTORY = f"""
WITH raw AS ({_ROWS}),
history AS (
 SELECT req_no, step, CASE step WHEN 0 THEN 'URI' WHEN 1 THEN 'TEXT' ELSE 'AUDIO' END AS type,
  submitted_at + step * 60 AS created
 FROM raw CROSS JOIN (VALUES (0), (1), (2)) AS v(step) WHERE step <= req_no % 4),
lookups AS (SELECT req_no * 7 AS req_no FROM raw),
latest AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY req_no ORDER BY created DESC, step DESC) = 1)
"""
_LATEST = f"{_HISTORY} SELECT req_no, step, type, created FROM latest"
_COUNTS = f"""
WITH batches AS ({inputs.BATCHES_SQL.format(events="events")})
SELECT strftime(date_trunc('hour', submitted_ts), '%Y-%m-%d %H:%M:%S') AS window_start,
 count(*) AS n_batches, CAST(sum(n_requests) AS BIGINT) AS n_requests
FROM batches GROUP BY 1
"""
_ROUTED = f"{_REQUESTS} SELECT req_no, route, status, reason, output_type, storage_path FROM routed"
_WORDS = r"len(regexp_extract_all(text, '[^ \t\n\r\f]+'))"

ORACLE: dict[str, str] = {
    # Sources and sinks
    "request_batch_explode": f"""
WITH raw AS ({_ROWS})
SELECT req_no // 10 AS payload_id, row_number() OVER (PARTITION BY req_no // 10 ORDER BY req_no) - 1 AS pos,
 uri, title, text FROM raw
UNION ALL SELECT -1 - req_no, 0, CASE WHEN req_no % 50 = 11 THEN concat('u', req_no) END, NULL, NULL
FROM raw WHERE req_no % 50 IN (8, 9, 10, 11)""",
    "request_batch_rejects": f"""
WITH raw AS ({_ROWS})
SELECT -1 - req_no AS payload_id, CASE req_no % 50 WHEN 0 THEN concat('{{not json ', req_no)
 WHEN 1 THEN concat('{{"uri":"', req_no, '"}}') WHEN 2 THEN concat('[{{"words_per_minute":"many ', req_no, '"}}]')
 WHEN 4 THEN concat('[{{"words_per_minute":50000000000', req_no, '}}]') WHEN 5 THEN concat('[{{"words_per_minute":-5', req_no, '}}]')
 WHEN 6 THEN concat('[{{"uri":', req_no, '}}]') ELSE concat('[{{"uri":"u","words_per_minute":"', req_no, '"}}]')
 END AS payload
FROM raw WHERE req_no % 50 IN (0, 1, 2, 4, 5, 6, 7)""",
    "file_manifest": """
SELECT coalesce(source, 'none') AS source, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_bytes
FROM documents GROUP BY 1""",
    "content_scan": "SELECT coalesce(text, '') AS text FROM documents",
    "csv_scan": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
 coalesce(source, '') AS source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
    "storage_layout": f"""{_REQUESTS}
SELECT type, created_date, count(*) AS n, count(DISTINCT path) AS n_paths, CAST(sum(req_no) AS BIGINT) AS winners
FROM (SELECT type, {_date("created", "%Y-%m-%d")} AS created_date, {_file("type")} AS path, req_no FROM titled
 WHERE length({_clean("title")}) >= 2 AND ({_file("type")}) IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY type, {_date("created", "%Y-%m-%d")}, {_file("type")}
  ORDER BY req_no % 2 DESC, created DESC, request_hash DESC) = 1) GROUP BY 1, 2""",
    "flat_export_winners": f"""{_REQUESTS}
SELECT {_clean("title")} || '.mp3' AS basename, request_hash, created, storage_path,
 count(*) OVER (PARTITION BY {_clean("title")}) AS n_writers
FROM routed WHERE status = 'ACCEPTED'
QUALIFY row_number() OVER (PARTITION BY {_clean("title")} ORDER BY created DESC, request_hash DESC) = 1""",
    "request_to_json": f"""{_REQUESTS}
SELECT CAST(json_merge_patch('{{}}', json_object('type', type, 'request_hash', request_hash, 'text', text,
 'title', title, 'created', created, 'uri', uri, 'submitted_at', submitted_at,
 'words_per_minute', words_per_minute)) AS VARCHAR) AS json FROM norm""",
    # Projections, filters, predicates
    "normalize_requests": f"""{_REQUESTS}
SELECT req_no, type, request_hash, text, title, created, uri, submitted_at, words_per_minute FROM norm""",
    "classify_uri": f"WITH raw AS ({_ROWS}) SELECT req_no, uri, {_class('uri')} AS type FROM raw",
    "uri_title_ext": f"SELECT page_id, {_stub('url')} AS title_stub, {_ext('url')} AS ext FROM pages",
    "request_uri_title_ext": f"""
WITH raw AS ({_ROWS}) SELECT req_no, {_stub("uri")} AS title_stub, {_ext("uri")} AS ext FROM raw""",
    "clean_title": f"""
WITH raw AS ({_ROWS})
SELECT req_no, {_clean("title")} AS clean_title, length({_clean("title")}) > 0 AS has_content FROM raw""",
    "resolve_title": f"{_REQUESTS} SELECT req_no, type, title FROM titled",
    "storage_path": f"""{_REQUESTS}
SELECT req_no, {_file("type")} AS work_path,
 CASE WHEN length({_clean("title")}) >= 2 THEN {_file("type")} END AS storage_path FROM titled""",
    "content_fingerprint": "SELECT doc_id, sha256(text) AS fingerprint FROM documents",
    "duplicate_groups": """
SELECT sha256(text) AS fingerprint, count(*) AS n, min(doc_id) AS first_id
FROM documents GROUP BY 1 HAVING count(*) > 1""",
    "list_requests": f"""{_REQUESTS}
SELECT uri, request_hash, title, NULL::VARCHAR AS atempo, words_per_minute, length, length AS size, text,
 NULL::BIGINT AS number_of_conversions, type, created, coalesce(submitted_at, 0) AS submitted_at FROM titled""",
    "submit_response": f"""{_REQUESTS}
SELECT uri, request_hash, title, NULL::VARCHAR AS atempo, words_per_minute, NULL::BIGINT AS length,
 NULL::BIGINT AS size, text, NULL::BIGINT AS number_of_conversions, type, created, submitted_at FROM norm""",
    "route_requests": _ROUTED,
    "reject_summary": f"{_REQUESTS} SELECT reason, count(*) AS n FROM routed WHERE status = 'ERROR' GROUP BY 1",
    "contract_violations": rf"""
WITH raw AS ({_ROWS}),
sent AS (SELECT *, CASE WHEN req_no % 11 = 0 THEN concat('bad-', req_no) ELSE {_id("req_no")} END AS id FROM raw)
SELECT 'uri_required' AS rule, count(*) FILTER (WHERE coalesce(uri, '') = '') AS n FROM sent
UNION ALL SELECT 'type_pattern', count(*) FILTER (WHERE type_in NOT IN
 ('URI', 'YOUTUBE', 'TEXT', 'AUDIO', 'VIDEO', 'PDF', 'YOUTUBE_LIST')) FROM sent
UNION ALL SELECT 'request_id_pattern', count(*) FILTER (WHERE NOT regexp_full_match(id,
 '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}')) FROM sent
UNION ALL SELECT 'submitted_at_unsigned', count(*) FILTER (WHERE submitted_at < 0) FROM sent
UNION ALL SELECT 'words_per_minute_unsigned', count(*) FILTER (WHERE words_per_minute < 0) FROM sent""",
    "text_measures": """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 AND n_chars <> 0 THEN n_chars ELSE CAST(strlen(text) AS BIGINT) END AS length,
 CAST(strlen(text) AS BIGINT) AS size FROM documents""",
    "narration_defaults": f"""{_REQUESTS}
SELECT req_no, coalesce(words_per_minute, 350) AS words_per_minute, 'f5' AS espeak_voice FROM norm""",
    "uri_requests": f"""
WITH stubs AS (SELECT page_id, url AS uri, CASE WHEN strlen({_stub("url")}) > 4 THEN {_graphic(_stub("url"))} END AS stub
 FROM pages)
SELECT page_id, uri, {_class("uri")} AS type,
 CASE WHEN strlen(stub) > 40 THEN {_graphic("substr(stub, 1, 40)")} ELSE stub END AS title, '2.0' AS atempo,
 350 AS words_per_minute, 'f5' AS espeak_voice, 'api' AS submitted_with, CAST(1704067200 AS BIGINT) AS submitted_at
FROM stubs""",
    "processed_requests": f"""{_PAGE_REQUESTS}
SELECT req_no, type, title, text, length, length AS size, coalesce(words_per_minute, 350) AS words_per_minute,
 'f5' AS espeak_voice, status, reason, output_type, storage_path FROM routed""",
    "processed_documents": f"""{_PAPERS}
SELECT req_no, type, title, text, length, status, reason, storage_path FROM routed""",
    # Extraction
    "html_blocks": f"WITH {_BLOCKS} SELECT page_id, pos, tag, text FROM page_blocks",
    "extract_text": f"WITH {_BLOCKS}, {_EXTRACTED} SELECT page_id, text, size, n_blocks FROM extracted",
    "page_title": f"SELECT page_id, {_PAGE_TITLE} AS title FROM pages",
    "assemble_pages": f"""
WITH doc_pages AS ({inputs.DOCUMENT_PAGES_SQL.format(conversations="conversations")})
SELECT doc_id, count(*) AS n_pages, string_agg(text, '' ORDER BY page_no) AS text
FROM doc_pages WHERE text IS NOT NULL GROUP BY 1""",
    "enrich_text": f"""
WITH {_LANDED}, raw AS ({_PAGE_ROWS})
SELECT r.req_no, r.uri, coalesce(nullif(r.text, ''), l.landed_text) AS text,
 CASE WHEN r.text = '' THEN l.page_title END AS page_title
FROM raw r LEFT JOIN landed l ON r.uri = l.uri""",
    # Corpus analytics
    "term_frequency": f"{_TERMS} SELECT doc_id, term, tf FROM tf",
    "document_frequency": f"{_TERMS} SELECT term, df FROM vocabulary",
    "idf": f"{_TERMS} SELECT term, df, round(idf, 6) AS idf FROM weights",
    "tfidf_topk": f"""{_TERMS},
scored AS (SELECT doc_id, term, tf, round(tf * idf, 6) AS score FROM tf JOIN weights USING (term))
SELECT doc_id, term, tf, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank
FROM scored QUALIFY rank <= 10""",
    "corpus_stats": f"""{_TERMS}
SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS n_postings
FROM vocabulary""",
    "accepted_counts": _COUNTS,
    "accepted_payloads": f"""
WITH raw AS ({_ROWS}),
batches AS (
 SELECT req_no // 10 AS payload_id, count(*) AS n_requests FROM raw GROUP BY 1
 UNION ALL SELECT -1 - req_no, CAST(req_no % 50 <> 3 AS INTEGER) FROM raw WHERE req_no % 50 IN (3, 8, 9, 10, 11))
SELECT strftime(date_trunc('hour', make_timestamp((1704067200 + abs(payload_id) * 97) * 1000000)), '%Y-%m-%d %H:%M:%S')
 AS window_start, count(*) AS n_batches, CAST(sum(n_requests) AS BIGINT) AS n_requests
FROM batches GROUP BY 1""",
    "route_census": rf"""{_REQUESTS}
SELECT type, status, nullif(lower(regexp_extract(uri, '^[a-z]+://([^/?#:]*)', 1)), '') AS host, count(*) AS n
FROM routed GROUP BY 1, 2, 3""",
    "playback_estimate": f"""
SELECT source, lang, count(*) AS n_docs, CAST(sum({_WORDS}) AS BIGINT) AS words,
 round(sum({_WORDS}) / 350.0, 4) AS minutes FROM documents GROUP BY 1, 2""",
    # Outlines, latest state, lookups
    "outline_parse": f"{_SECTIONS} SELECT doc_id, line_no, name, page_start FROM markers",
    "section_ranges": f"{_SECTIONS} SELECT doc_id, line_no, name, page_start, page_end FROM ranges",
    "section_slices": f"{_SECTIONS} SELECT doc_id, line_no, name, page_start, page_no, text FROM slices",
    "section_texts": f"""{_SECTIONS}
SELECT doc_id, line_no, name, count(*) AS n_pages, string_agg(text, '' ORDER BY page_no) AS text
FROM slices WHERE text IS NOT NULL GROUP BY 1, 2, 3""",
    "latest_status": _LATEST,
    "status_lookup": f"""{_HISTORY}
SELECT i.req_no, l.step, l.type, l.created, l.req_no IS NOT NULL AS found
FROM lookups i LEFT JOIN latest l ON i.req_no = l.req_no""",
    "status_missing": f"{_HISTORY} SELECT DISTINCT req_no FROM lookups WHERE req_no NOT IN (SELECT req_no FROM history)",
    "result_lookup": f"""{_HISTORY}
SELECT req_no, step, type, created FROM history WHERE type = 'TEXT' AND req_no IN (SELECT req_no FROM lookups)""",
    # Streams
    "stream_route": _ROUTED,
    "stream_accepted_counts": _COUNTS,
    "stream_latest_status": _LATEST,
    # Extension point
    "converter_chain": f"""{_REQUESTS}
SELECT req_no, route, CASE WHEN route IN ('TEXT', 'VIDEO') THEN 'AUDIO' ELSE type END AS type,
 coalesce(words_per_minute, 350) AS words_per_minute,
 CASE WHEN route IN ('AUDIO', 'VIDEO') THEN '2.0' END AS atempo,
 CASE WHEN route = 'TEXT' THEN round({_WORDS} / coalesce(words_per_minute, 350), 4) END AS minutes
FROM routed WHERE status = 'ACCEPTED'""",
}

# The same results by another way: folded, observed, delivered twice.
ORACLE |= {
    "storage_compacted": ORACLE["storage_layout"],
    "observed_violations": ORACLE["contract_violations"],
    "stream_distinct_payloads": ORACLE["accepted_payloads"],
    "stream_current_status": _LATEST,
    "stream_page_arrivals": f"""{_PAGE_REQUESTS.replace("FROM extracted e JOIN pages p ON e.page_id = p.page_id", "FROM extracted e JOIN pages p ON e.page_id = p.page_id WHERE e.page_id % 4 IN (0, 1)")}
SELECT req_no, type, title, text, length, status, reason, storage_path FROM routed""",
    "point_lookup": f"""{_HISTORY}
SELECT req_no, step, type, created FROM history
WHERE req_no IN (SELECT min(doc_id) FROM documents GROUP BY source)""",
    "idf_of_growing_corpus": _TERMS.replace(
        "FROM documents)", "FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN concat('revised edition ', doc_id) ELSE text END AS text FROM documents))", 1
    )
    + "SELECT term, df, round(idf, 6) AS idf FROM weights",
    "corpus_sketches": f"""{_TERMS}
SELECT lang, count(DISTINCT doc_id) AS n_docs, count(term) AS n_postings, count(DISTINCT term) AS n_terms, true AS is_close
FROM documents LEFT JOIN tf USING (doc_id) GROUP BY 1""",
    "rope_ranges": f"""
WITH doc_pages AS ({inputs.DOCUMENT_PAGES_SQL.format(conversations="conversations")}),
whole AS (
 SELECT doc_id, hex(encode(string_agg(text, '' ORDER BY page_no, text))) AS h FROM doc_pages WHERE text IS NOT NULL GROUP BY 1)
SELECT doc_id, 'head' AS range_id, substr(h, 21, 160) AS data FROM whole WHERE len(h) > 20
UNION ALL SELECT doc_id, 'tail', substr(h, greatest(len(h) - 100, 0) + 1) FROM whole WHERE len(h) > 0""",
    "converted_bytes": """
WITH items AS (
 SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN 'plain' WHEN 1 THEN 'packed' WHEN 2 THEN 'turned' ELSE 'unknown' END AS route,
  strlen(text) = length(text) AS is_ascii
 FROM documents),
done AS (
 SELECT *, CASE WHEN route = 'plain' AND is_ascii THEN upper(text) WHEN route = 'packed' THEN text
  WHEN route = 'turned' AND is_ascii THEN reverse(text) END AS result FROM items)
SELECT doc_id, route, CASE WHEN result IS NULL AND route = 'turned' THEN CAST(strlen(text) AS BIGINT) ELSE CAST(strlen(result) AS BIGINT) END AS n_bytes,
 sha256(result) AS digest,
 CASE WHEN text IS NULL THEN NULL WHEN route = 'unknown' THEN 'no codec for route unknown'
  WHEN route = 'plain' AND NOT is_ascii THEN 'UnicodeDecodeError' END AS failed
FROM done""",
}
