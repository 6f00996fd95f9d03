"""The same results in DuckDB SQL, phrased on their own terms.

Error rules are a table of needles joined on ``contains``; the label of the
highest (or lowest) rank wins.
"""

from checks import inputs
from pressmill.functions import rule_values
from pressmill.functions.text import WHITESPACE

SQL = {}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def array(values: list[str]) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values: list[str], index: str) -> str:
    return f"({array(values)})[CAST({index} AS BIGINT) + 1]"


BLANKS = lit(WHITESPACE)
strip = lambda text: f"trim({text}, {BLANKS})"
strip_lines = lambda text: f"array_to_string(list_transform(string_split({text}, chr(10)), lambda line: {strip('line')}), ' ')"

# -- shared inputs ---------------------------------------------------------------

ARTICLES = """articles AS (SELECT event_id AS article_id, event_type AS status, concat('u', user_id) AS media_url,
    concat('https://u', user_id, '.example/', event_id) AS url, event_id % 7 AS batch_id,
    CAST(event_id % 8 AS INT) AS tries, value FROM events)"""
SCRAPED = """scraped AS (SELECT event_id AS article_id, event_type AS status, CAST(event_id % 8 AS INT) AS tries,
    concat('https://x.example/', event_id) AS target_url,
    CAST(CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 200 WHEN 3 THEN 503 END AS INT) AS status_code FROM events)"""
STORIES = """stories AS (SELECT doc_id, text, lang AS language, source AS domain,
    concat('https://', source, '.example/', doc_id) AS url, string_split(text, chr(10))[1] AS title,
    CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS DATE) AS VARCHAR) AS publication_date FROM documents)"""
SOURCES = "sources AS (SELECT CAST(substr(source, 4) AS BIGINT) % 4 AS collection_id, source AS name FROM documents)"

# -- sources and sinks -------------------------------------------------------------

SQL["read_stories"] = f"""WITH {STORIES} SELECT url, domain, language, publication_date,
    CAST(length(title) AS INT) AS title_chars, true AS no_capture_time FROM stories"""
SQL["write_stories"] = f"WITH {STORIES} SELECT url, domain, language, md5(title) AS title_md5 FROM stories"
SQL["unwrap_envelope"] = """SELECT doc_id, lang AS language, md5(text) AS text_md5 FROM documents
    WHERE (doc_id // 100) % 3 <> 2"""
SQL["read_article_lines"] = """SELECT doc_id, lang AS language, md5(text) AS text_md5 FROM documents
    WHERE doc_id % 10 NOT IN (3, 5, 7, 9)"""
SQL["malformed_lines"] = """SELECT CASE doc_id % 10 WHEN 3 THEN '{"doc_id": 3, "text": "cut' WHEN 5 THEN ''
    WHEN 7 THEN '[1, 2]' ELSE 'extra' END AS line, count(*) AS n FROM documents
    WHERE doc_id % 10 IN (3, 5, 7, 9) GROUP BY 1"""

BODIES = """bodies AS (SELECT doc_id AS article_id, concat('https://x.example/', doc_id) AS url, doc_id % 4 AS tries,
    CASE doc_id % 11 WHEN 4 THEN NULL WHEN 7 THEN NULL ELSE nullif(text, '') END AS body,
    sha256(concat(doc_id, '|html|', doc_id % 4)) AS id FROM documents)"""
SQL["put_content"] = f"""WITH {BODIES} SELECT id AS content_id, CAST(article_id AS VARCHAR) AS article_id,
    url AS target_url, 'html' AS kind, md5(body) AS body_md5 FROM bodies WHERE body IS NOT NULL"""
SQL["get_content"] = f"""WITH {BODIES} SELECT article_id, CASE WHEN body IS NOT NULL THEN id END AS content_id,
    md5(body) AS body_md5 FROM bodies"""
SQL["content_info"] = f"""WITH {BODIES} SELECT article_id,
    CASE WHEN body IS NOT NULL THEN CAST(article_id AS VARCHAR) END AS stored_article_id,
    CASE WHEN body IS NOT NULL THEN url END AS stored_url,
    CASE WHEN body IS NOT NULL THEN 'html' END AS stored_kind FROM bodies"""

# -- import and batches --------------------------------------------------------------

FAULTS = {1: "type:ap_syndicated", 4: "missing:guid", 6: "missing:language", 7: "type:media_id",
          9: "type:publish_date", 10: "type:story_tags", 12: "type:title", 13: "type:metadata", 15: "malformed"}
_refused = ", ".join(map(str, FAULTS))
SQL["validate_articles"] = f"""SELECT doc_id, doc_id % 17 = 2 AS ap_syndicated,
    CASE WHEN doc_id % 17 <> 5 THEN concat('g', doc_id) END AS guid, lang AS language,
    CASE WHEN doc_id % 17 = 8 THEN 12 ELSE doc_id END AS media_id, doc_id AS stories_id,
    '2024-01-05' AS publish_date, CAST(CASE WHEN doc_id % 17 = 11 THEN 2 ELSE 0 END AS INT) AS n_tags,
    md5(text) AS title_md5, CASE WHEN doc_id % 17 = 14 THEN '2' END AS geocoder
    FROM documents WHERE doc_id % 17 NOT IN ({_refused})"""
SQL["rejected_articles"] = "SELECT doc_id, CASE doc_id % 17 " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in FAULTS.items()
) + f" END AS reasons FROM documents WHERE doc_id % 17 IN ({_refused})"
SQL["stamp_articles"] = f"""SELECT doc_id AS stories_id, lang, (SELECT max(event_id % 7) + 1 FROM events) AS batch_id,
    concat('f', doc_id % 3, '.json') AS imported_from, 'UNPROCESSED' AS status, CAST(0 AS INT) AS tries,
    CAST(CASE WHEN doc_id % 17 = 11 THEN 2 ELSE 0 END AS INT) AS n_tags, true AS no_result
    FROM documents WHERE doc_id % 17 NOT IN ({_refused})"""
SQL["next_batch_id"] = f"WITH {ARTICLES} SELECT coalesce(max(batch_id), 0) + 1 AS batch_id FROM articles"
SQL["latest_batch_id"] = f"WITH {ARTICLES} SELECT coalesce(max(batch_id), 0) AS batch_id FROM articles"
SQL["first_open_batch_id"] = f"""WITH {ARTICLES} SELECT coalesce(min(batch_id), 0) AS batch_id FROM articles
    WHERE status = 'error' AND batch_id >= 3"""
SQL["delete_batch"] = """WITH rows AS (SELECT event_id AS article_id,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 END AS batch_id FROM events)
    SELECT * FROM rows WHERE batch_id IS DISTINCT FROM (SELECT max(batch_id) FROM rows)"""
SQL["append_articles"] = """SELECT event_id AS article_id, event_type AS status, NULL AS lang FROM events
    UNION ALL SELECT doc_id, NULL, lang FROM documents"""

# -- story search ----------------------------------------------------------------------

_word = lambda text, words: f"regexp_matches({text}, '(?i)(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_]){words}([^\\p{{L}}\\p{{M}}\\p{{N}}_]|$)')"
SQL["collection_domains"] = f"WITH {SOURCES} SELECT name FROM sources WHERE collection_id = 1"
SQL["search_stories"] = f"""WITH {STORIES}, {SOURCES} SELECT doc_id, domain, publication_date FROM stories
    WHERE publication_date >= '2024-01-03' AND publication_date <= '2024-01-24' AND doc_id % 29 <> 5
      AND domain IN (SELECT name FROM sources WHERE collection_id = 1) AND {_word('text', 'of[ ' + chr(10) + ']+the')}"""
SQL["search_phrase_index"] = SQL["search_stories"]
SQL["story_search_job"] = f"""WITH {STORIES}, {SOURCES} SELECT doc_id, language, url FROM stories
    WHERE publication_date >= '2024-01-01' AND publication_date <= '2024-01-15'
      AND domain IN (SELECT name FROM sources WHERE collection_id = 2) AND {_word('text', 'les')}"""

# -- work selection ----------------------------------------------------------------------

DRAW = lambda key, seed: f"CAST(concat('0x', substr(md5(concat({key}, '|{seed}')), 1, 15)) AS BIGINT)"
SQL["fetch_tasks"] = f"WITH {ARTICLES} SELECT article_id, url, tries FROM articles WHERE status = 'error' AND batch_id = 3"
SQL["fetch_tasks_limited"] = f"""WITH {ARTICLES} SELECT article_id, url FROM articles WHERE status = 'click'
    ORDER BY article_id LIMIT 1500"""
SQL["fetch_tasks_large_limit"] = f"""WITH {ARTICLES}, rows AS (
    SELECT CASE WHEN article_id % 500 <> 0 THEN article_id // 2 END AS article_id FROM articles)
    SELECT article_id FROM rows ORDER BY article_id NULLS FIRST LIMIT 9000"""
SQL["retry_filter"] = f"""WITH {ARTICLES} SELECT * FROM (
    SELECT article_id, CASE WHEN article_id % 13 = 0 THEN NULL ELSE tries END AS tries FROM articles
    WHERE status = 'click' ORDER BY article_id LIMIT 1500) WHERE coalesce(tries, 0) <= 5"""
SQL["shuffle_tasks"] = f"WITH {ARTICLES} SELECT article_id, url, {DRAW('article_id', 7)} AS draw FROM articles"
SQL["assign_blocks"] = """WITH tasks AS (
    SELECT event_id AS article_id, concat('u', user_id) AS media_url FROM events WHERE event_id % 19 NOT IN (3, 8)),
sites AS (SELECT media_url, row_number() OVER (ORDER BY count(*) DESC, media_url) - 1 AS turn FROM tasks GROUP BY media_url)
SELECT article_id, media_url, CAST(CASE WHEN turn % 16 < 8 THEN turn % 16 ELSE 15 - turn % 16 END AS INT) AS block
FROM tasks JOIN sites USING (media_url)"""
SQL["even_blocks"] = """WITH RECURSIVE tasks AS (
    SELECT event_id AS article_id, CASE WHEN event_id % 10 < 6
        THEN concat('h', CAST(floor(sqrt(event_id % 1000)) AS INT)) ELSE concat('u', user_id) END AS media_url FROM events),
sites AS (SELECT media_url, count(*) AS size, (SELECT count(*) FROM tasks) AS total FROM tasks GROUP BY media_url),
heavy AS (SELECT *, row_number() OVER (ORDER BY size DESC, media_url) AS k FROM sites WHERE size * 64 >= total),
placed AS (
    SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS media_url, CAST(NULL AS BIGINT) AS block,
        [CAST(0 AS BIGINT) FOR x IN range(8)] AS loads
    UNION ALL
    SELECT h.k, h.media_url, list_position(loads, list_min(loads)) - 1,
        [CASE WHEN i = list_position(loads, list_min(loads)) THEN loads[i] + h.size ELSE loads[i] END FOR i IN range(1, 9)]
    FROM placed p JOIN heavy h ON h.k = p.k + 1),
room AS (SELECT b, (SELECT arg_max(loads, k) FROM placed)[b + 1] AS load FROM range(8) t(b)),
level AS (SELECT min(l) AS level FROM (
    SELECT l, sum(greatest(0, l - load)) AS fits FROM room, range((SELECT count(*) + 1 FROM tasks)) t(l) GROUP BY l)
    WHERE fits >= (SELECT coalesce(sum(size), 0) FROM sites WHERE size * 64 < total)),
ends AS (SELECT b, sum(greatest(0, level - load)) OVER (ORDER BY b) AS upto FROM room, level),
light AS (SELECT media_url, coalesce(sum(size) OVER (ORDER BY size DESC, media_url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_task
    FROM sites WHERE size * 64 < total),
blocks AS (SELECT media_url, block FROM placed WHERE k > 0
    UNION ALL SELECT media_url, (SELECT count(*) FROM ends WHERE upto <= first_task) FROM light)
SELECT article_id, media_url, CAST(block AS INT) AS block FROM tasks JOIN blocks USING (media_url)"""
SQL["stripe"] = f"""WITH {ARTICLES} SELECT article_id, url,
    CAST((row_number() OVER (ORDER BY article_id) - 1) % 4 AS INT) AS block FROM articles"""
SQL["language_gate"] = """WITH rows AS (SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE lang END AS language FROM documents)
    SELECT doc_id, language, CASE WHEN language IS DISTINCT FROM 'en' THEN 'ERROR: Not in English' END AS text FROM rows"""
SQL["pause_plan"] = f"""WITH rows AS (SELECT doc_id, source AS domain, lang FROM documents),
    seen AS (SELECT *, coalesce(lag(domain) OVER (ORDER BY doc_id), (SELECT max_by(domain, doc_id) FROM rows)) AS before FROM rows),
    paused AS (SELECT *, CASE WHEN lang = 'en' AND domain = before THEN 1 + {DRAW('doc_id', 3)} % 5 ELSE 0 END AS pause FROM seen)
    SELECT doc_id, domain, pause, CAST(sum(pause) OVER (ORDER BY doc_id) AS BIGINT) AS start_offset FROM paused"""
SQL["pause_plan_per_block"] = f"""WITH rows AS (SELECT event_id AS article_id, event_type AS domain, CAST(event_id % 7 AS INT) AS block FROM events),
    seen AS (SELECT *, coalesce(lag(domain) OVER w, last_value(domain) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS before
        FROM rows WINDOW w AS (PARTITION BY block ORDER BY article_id)),
    paused AS (SELECT *, CASE WHEN domain = before THEN 1 + {DRAW('article_id', 5)} % 5 ELSE 0 END AS pause FROM seen)
    SELECT article_id, block, pause, CAST(sum(pause) OVER (PARTITION BY block ORDER BY article_id) AS BIGINT) AS start_offset FROM paused"""

SQL["fetch_plan_job"] = f"""WITH {ARTICLES},
    tasks AS (SELECT article_id, media_url, {DRAW('article_id', 7)} AS draw FROM articles
        WHERE status = 'click' AND coalesce(tries, 0) <= 5),
    sites AS (SELECT media_url, row_number() OVER (ORDER BY count(*) DESC, media_url) - 1 AS turn FROM tasks GROUP BY media_url),
    dealt AS (SELECT article_id, media_url, draw,
        CAST(CASE WHEN turn % 16 < 8 THEN turn % 16 ELSE 15 - turn % 16 END AS INT) AS block FROM tasks JOIN sites USING (media_url)),
    seen AS (SELECT *, coalesce(lag(media_url) OVER w, last_value(media_url) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS before
        FROM dealt WINDOW w AS (PARTITION BY block ORDER BY draw)),
    paused AS (SELECT *, CASE WHEN media_url = before THEN 1 + {DRAW('draw', 7)} % 5 ELSE 0 END AS pause FROM seen)
    SELECT article_id, media_url, block, pause, CAST(sum(pause) OVER (PARTITION BY block ORDER BY draw) AS BIGINT) AS start_offset FROM paused"""
SQL["extract_plan_job"] = f"""WITH {ARTICLES} SELECT article_id, url,
    CAST((row_number() OVER (ORDER BY article_id) - 1) % 4 AS INT) AS block FROM articles
    WHERE status = 'error' AND batch_id = (SELECT max(batch_id) FROM articles)"""
SQL["extract_plan_first"] = f"""WITH {ARTICLES} SELECT article_id, url,
    CAST((row_number() OVER (ORDER BY article_id) - 1) % 3 AS INT) AS block FROM articles
    WHERE status = 'error' AND batch_id = (SELECT min(batch_id) FROM articles WHERE status = 'error' AND batch_id > 2)"""

# -- fetch outcome -----------------------------------------------------------------------

FETCHES = """fetches AS (SELECT doc_id AS article_id, concat('https://x.example/', doc_id) AS url,
    page_id IS NOT NULL AND page_id % 10 <> 9 AS ok, page_id, pages.url AS landing_url, html,
    CASE WHEN page_id % 4 = 0 THEN 404 WHEN page_id IS NOT NULL THEN 200 END AS status_code
    FROM documents LEFT JOIN pages ON page_id = doc_id)"""
SQL["attach_responses"] = f"""WITH {FETCHES} SELECT article_id, CASE WHEN ok THEN 'CONTENT-FETCHED' ELSE 'FAILED' END AS status,
    CAST(status_code AS INT) AS status_code, CAST(strlen(html) AS BIGINT) AS n_bytes FROM fetches"""
SQL["one_response_per_url"] = """SELECT concat('https://u', user_id) AS url, max(event_id) AS capture,
    max_by(value, event_id) AS value FROM events GROUP BY user_id"""
SQL["cap_responses"] = """WITH caps AS (SELECT page_id, CASE
        WHEN page_id % 7 = 3 THEN 'BAD_CONTENT_LENGTH' WHEN page_id % 7 = 0 THEN 'HEADERS_TOO_LARGE'
        WHEN page_id % 7 = 1 THEN 'CONTENT_AUDIO' WHEN page_id % 7 = 2 THEN 'CONTENT_VIDEO'
        WHEN page_id % 5 = 0 THEN 'TOO_LONG' WHEN strlen(html) > 52428800 THEN 'TOO_LARGE' END AS capped,
        CASE WHEN page_id % 5 = 0 THEN 'TOO_LONG' WHEN strlen(html) > 3000 THEN 'TOO_LARGE' END AS capped_small FROM pages)
    SELECT page_id, capped, CASE WHEN capped IS NULL THEN 'CONTENT-FETCHED' ELSE 'FAILED' END AS status, capped_small FROM caps"""
SQL["decode_body"] = """SELECT page_id, md5(CASE page_id % 8 WHEN 5 THEN 'DECODING_ERROR' WHEN 7 THEN NULL ELSE html END) AS content_md5,
    CASE page_id % 8 WHEN 0 THEN 'UTF_8' WHEN 1 THEN 'latin-1' WHEN 2 THEN 'utf-16-le' WHEN 3 THEN 'windows-1252'
        WHEN 4 THEN CASE WHEN strlen(html) = length(html) THEN 'ascii' ELSE 'utf-8' END
        WHEN 5 THEN 'utf-8' WHEN 6 THEN 'utf-8' END AS used_encoding FROM pages"""
SQL["fetch_error_label"] = """SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'ERROR: requests.exceptions.ConnectionError'
    WHEN 1 THEN 'ERROR: requests.exceptions.ReadTimeout' WHEN 2 THEN 'ERROR: Too Many redirects'
    WHEN 3 THEN 'ERROR: bad chunk' WHEN 4 THEN 'ERROR: Article not found' WHEN 5 THEN 'ERROR: Article not found' END AS label FROM pages"""
SQL["build_scraping_result"] = f"""WITH {FETCHES} SELECT article_id, url AS target_url, landing_url,
    CASE WHEN page_id IS NOT NULL THEN sha256(concat(article_id, '|html|', article_id % 4)) END AS content_html,
    CAST(NULL AS VARCHAR) AS content_text,
    CASE WHEN page_id % 5 = 0 THEN 300.5::DOUBLE WHEN page_id IS NOT NULL THEN 0.25::DOUBLE END AS elapsed,
    CASE WHEN page_id IS NOT NULL THEN 'utf-8' END AS encoding, CAST(status_code AS INT) AS status_code,
    CAST(make_timestamp(article_id * 1000000) AS TIMESTAMP) AS scraped_at,
    CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'audio/mpeg' WHEN 2 THEN 'video/mp4' WHEN 3 THEN NULL
        WHEN 4 THEN 'text/html' WHEN 5 THEN 'text/html' WHEN 6 THEN 'text/html' END AS content_type FROM fetches"""

# -- error rules -------------------------------------------------------------------------


def rule_table(rules) -> str:
    """``VALUES`` of (rank, label, condition number, field, kind, needle)."""
    rows = []
    for rank, (label, tests) in enumerate(rules):
        text = "NULL" if label is rule_values.KEEP_PAGE_TEXT else lit(rule_values.LABEL_PREFIX + label)
        number = 0
        for field, kind, values in tests:
            for value in values:
                number += kind == "all"
                rows.append(f"({rank}, {text}, {number if kind == 'all' else field and number}, '{field}', '{kind}', {lit(value)})")
            number += 1
    return "(VALUES " + ", ".join(rows) + ") AS r(rank, label, part, field, kind, needle)"


def parts_per_rule(rules) -> str:
    return ", ".join(f"({rank}, {sum(len(v) if k == 'all' else 1 for _, k, v in tests)})"
                     for rank, (_, tests) in enumerate(rules))


def matches(rules, rows: str, key: str) -> str:
    """Query of (key, rank, label) for all rules a row fulfils; ``rows`` has url and text."""
    return f"""SELECT {key}, rank, label FROM (
        SELECT {key}, r.rank, any_value(r.label) AS label, count(DISTINCT (r.part, CASE WHEN r.kind = 'all' THEN r.needle END)) AS held
        FROM {rows} x JOIN {rule_table(rules)} ON CASE r.kind
            WHEN 'equals' THEN CASE r.field WHEN 'url' THEN x.url ELSE x.text END = r.needle
            WHEN 'ends' THEN suffix(CASE r.field WHEN 'url' THEN x.url ELSE x.text END, r.needle)
            ELSE contains(CASE r.field WHEN 'url' THEN x.url ELSE x.text END, r.needle) END
        GROUP BY {key}, r.rank)
    JOIN (VALUES {parts_per_rule(rules)}) AS need(rank, parts) USING (rank) WHERE held = parts"""


_k = len(inputs.URL_NEEDLES)
SQL["url_rules"] = f"""WITH rows AS (SELECT page_id, '' AS text, concat(url, '/', {pick(inputs.URL_NEEDLES, f'page_id % {_k}')}, '/',
        {pick(inputs.URL_NEEDLES, f'(page_id * 7 + page_id // {_k}) % {_k}')}) AS url FROM pages),
    hits AS ({matches(rule_values.URL_RULES, 'rows', 'page_id')})
    SELECT page_id, max_by(label, rank) AS label FROM rows LEFT JOIN hits USING (page_id) GROUP BY page_id"""
_k = len(inputs.TEXT_NEEDLES)
_first, _second = pick(inputs.TEXT_NEEDLES, f"doc_id % {_k}"), pick(inputs.TEXT_NEEDLES, f"(doc_id * 11 + 5) % {_k}")
SQL["page_text_rules"] = f"""WITH rows AS (SELECT doc_id, '' AS url, lower(CASE doc_id % 3 WHEN 0 THEN {_first}
        WHEN 1 THEN concat(text, {_first}) ELSE concat({_first}, text, {_second}) END) AS text FROM documents),
    hits AS ({matches(rule_values.PAGE_TEXT_RULES, 'rows', 'doc_id')})
    SELECT doc_id, max_by(label, rank) AS label FROM rows LEFT JOIN hits USING (doc_id) GROUP BY doc_id"""
# In these pages an unclosed paragraph lasts until </article> or the end, a closed
# one until its own end tag, and no text node is blank.
_cut = "'(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>|</?[a-zA-Z][^>]*>'"


def plain(markup: str) -> str:
    """Text of a piece of page markup."""
    # a known entity may lack its semicolon before a tag
    text = f"regexp_replace({markup}, '&(amp|quot|copy|middot|lt|gt)<', '&\\1;<', 'g')"
    text = f"regexp_replace({text}, {_cut}, '', 'g')"
    text = f"regexp_replace({text}, '&([a-z]+)$', '\\1')"
    for name, character in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")]:
        text = f"replace({text}, '&{name};', '{character}')"
    return text


_plain_html = plain("html")
_u, _t = len(inputs.EMPTY_URL_NEEDLES), len(inputs.EMPTY_TEXT_NEEDLES)
SQL["empty_page_rules"] = f"""WITH rows AS (SELECT page_id,
        CASE WHEN page_id % 5 = 0 THEN url ELSE concat(url, '/', {pick(inputs.EMPTY_URL_NEEDLES, f'page_id % {_u}')}, '/',
            {pick(inputs.EMPTY_URL_NEEDLES, f'(page_id * 3 + 1) % {_u}')}) END AS url,
        CASE WHEN page_id % 4 = 0 THEN {pick(inputs.EMPTY_TEXT_NEEDLES, f'page_id % {_t}')}
            ELSE {_plain_html} END AS raw, lower(raw) AS text FROM pages),
    hits AS ({matches(rule_values.EMPTY_PAGE_RULES, 'rows', 'page_id')}),
    best AS (SELECT page_id, max(rank) AS rank FROM hits GROUP BY page_id)
    SELECT rows.page_id, CASE WHEN best.rank IS NOT NULL THEN coalesce(label, raw) END AS result
    FROM rows LEFT JOIN best USING (page_id) LEFT JOIN hits ON hits.page_id = rows.page_id AND hits.rank = best.rank"""
_k = len(inputs.LAST_NEEDLES)
SQL["last_resort_rules"] = f"""WITH rows AS (SELECT page_id, '' AS text, CASE WHEN page_id % 8 = 0 THEN url ELSE concat(url,
        {pick(inputs.LAST_NEEDLES, f'page_id % {_k}')}, {pick(inputs.LAST_NEEDLES, f'(page_id // {_k}) % {_k}')}) END AS url FROM pages),
    hits AS ({matches(rule_values.LAST_RESORT_RULES, 'rows', 'page_id')})
    SELECT page_id, coalesce(min_by(label, rank), 'ERROR: No text gathered') AS label
    FROM rows LEFT JOIN hits USING (page_id) GROUP BY page_id"""

# -- pages and extraction ------------------------------------------------------------------

PARAGRAPHS = f"""pieces AS (SELECT page_id, html, string_split(html, '<p>') AS piece FROM pages),
    starts AS (SELECT page_id, html, piece, unnest(range(2, len(piece) + 1)) AS i FROM pieces),
    texts AS (SELECT page_id, i, {strip(plain("CASE WHEN contains(piece[i], '</p>') THEN string_split(piece[i], '</p>')[1] ELSE string_split(array_to_string(piece[i:], '<p>'), '</article>')[1] END"))} AS text FROM starts)"""
SQL["page_parts"] = f"""SELECT page_id, md5({plain('html')}) AS text_md5, len(string_split(html, '<p>')) - 1 AS n_paragraphs,
    false AS parse_failed FROM pages"""
SQL["page_paragraphs"] = f"""WITH {PARAGRAPHS}, joined AS (SELECT page_id, string_agg(text, ' ' ORDER BY i) AS text FROM texts GROUP BY page_id)
    SELECT page_id, length(text) AS n_chars, md5(text) AS text_md5 FROM joined"""
SQL["resolve_pages"] = f"""WITH {PARAGRAPHS}, joined AS (SELECT page_id, string_agg(text, ' ' ORDER BY i) AS text FROM texts GROUP BY page_id)
    SELECT page_id, md5(text) AS text_md5, '' AS error, false AS extract_exception FROM joined"""
SQL["paragraph_text"] = f"SELECT doc_id, {strip_lines('text')} AS text FROM documents"
SQL["empty_paragraphs"] = "SELECT doc_id, doc_id % 5 IN (0, 1, 4) AS is_empty FROM documents"

_own = strip("text")
SITE_RESULTS = {
    "X1": "text", "X2": _own, "X3": _own, "X4": _own, "X5": "concat(text, ' ', lang)", "X6": _own, "X7": _own,
    "X8": _own, "X9": "CASE WHEN doc_id % 2 = 0 THEN 'ERROR: 403 Forbidden' ELSE 'ERROR: No text gathered' END",
    "X10": "'ERROR: No text gathered'", "X11": "text", "X12": "'ERROR: Video/ Image content only'",
    "X13": f"CASE WHEN doc_id % 3 = 2 THEN 'ERROR: No text gathered' ELSE {_own} END", "X14": _own,
    "X15": "array_to_string(string_split(text, chr(10)), ' ')", "X16": _own, "X17": "CAST(NULL AS VARCHAR)",
    "X18": _own, "X19": _own, "X20": "text",
}
for _id, _result in SITE_RESULTS.items():
    SQL[f"site_{_id.lower()}"] = f"SELECT doc_id, {_result} AS result, false AS extract_exception FROM documents"

MIXED = f"""mixed AS (SELECT doc_id, text, lang, source, doc_id % 12 AS kind, doc_id % 29 = 0 AS no_body, doc_id % 31 AS failure,
    {_own} AS whole, {strip_lines('text')} AS lines FROM documents)"""
_label = lambda name: f"'ERROR: {name}'"
# what page rules, site rules and empty-page rules say about a page; null for none
_FOUND = f"""CASE kind WHEN 0 THEN {_label('No text gathered')}
    WHEN 1 THEN CASE WHEN no_body THEN '' ELSE whole END
    WHEN 2 THEN {_label('Article has been archived')} WHEN 4 THEN {_label('404 Page not found')}
    WHEN 5 THEN CASE WHEN no_body THEN {_label('No text gathered')} ELSE {_label('Blocked from website')} END
    WHEN 6 THEN CASE WHEN no_body THEN {_label('No text gathered')} ELSE {_label('404 Page not found')} END
    ELSE CASE WHEN no_body THEN {_label('No text gathered')} END END"""
_TEXT = """CASE WHEN no_body THEN '' WHEN kind = 1 THEN 'x' WHEN kind IN (2, 4, 6) THEN '' WHEN kind = 5 THEN concat('Access Denied ', whole) ELSE lines END"""
SQL["resolve_strict"] = f"""WITH {MIXED} SELECT doc_id, CASE WHEN lang <> 'en' THEN {_label('Not in English')}
    WHEN kind = 3 THEN {_label('Video/ Image content only')}
    WHEN failure = 0 THEN {_label('requests.exceptions.ReadTimeout')} WHEN failure = 1 THEN {_label('odd failure')}
    WHEN no_body THEN {_label('Article not found')} ELSE coalesce({_FOUND}, {_TEXT}) END AS text, false AS extract_exception FROM mixed"""
# an empty page of kinds 0 and 1 is judged by the empty-page rules last
_ERROR = f"""CASE WHEN no_body AND kind = 1 THEN {_label('No text gathered')} ELSE coalesce({_FOUND}, '') END"""
SQL["resolve_pair"] = f"WITH {MIXED} SELECT doc_id, {_TEXT} AS text, {_ERROR} AS error, false AS extract_exception FROM mixed"
SQL["extraction_update"] = f"""WITH {MIXED} SELECT doc_id, true AS text_extracted, substr({_TEXT}, 1, 250) AS abstract,
    {_ERROR} AS parsing_error FROM mixed WHERE doc_id % 6 <> 0"""

# -- state -----------------------------------------------------------------------------------

SQL["apply_scrape"] = f"""WITH {SCRAPED}, hit AS (SELECT event_id AS article_id, CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS n FROM events WHERE value >= 20)
    SELECT article_id, CASE WHEN n IS NULL THEN status WHEN article_id % 3 = 0 THEN 'FAILED' ELSE 'CONTENT-FETCHED' END AS status,
    CAST(tries + coalesce(n, 0) AS INT) AS tries,
    CASE WHEN n IS NULL THEN target_url ELSE concat('https://y.example/', article_id) END AS target_url,
    CAST(CASE WHEN n IS NULL THEN status_code ELSE 200 + n END AS INT) AS status_code,
    CASE WHEN n IS NOT NULL THEN concat('h', article_id) END AS content_html FROM scraped LEFT JOIN hit USING (article_id)"""
SQL["apply_extraction"] = f"""WITH {SCRAPED} SELECT article_id, status,
    CAST(tries + CASE WHEN status <> 'error' THEN 1 ELSE 0 END AS INT) AS tries,
    CASE WHEN status <> 'error' THEN true END AS text_extracted, CASE WHEN status <> 'error' THEN status END AS abstract,
    CASE WHEN status <> 'error' THEN '' END AS parsing_error, target_url, status_code,
    CASE WHEN status <> 'error' THEN concat('t', article_id) END AS content_text FROM scraped"""

# -- counts and progress ---------------------------------------------------------------------

SQL["count_status"] = """SELECT CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS status, count(*) AS count FROM events GROUP BY 1"""
SQL["count_status_codes"] = f"WITH {SCRAPED} SELECT status_code, count(*) AS count FROM scraped GROUP BY 1"
SQL["diff_counts"] = """WITH rows AS (SELECT event_type AS before, CASE WHEN event_type = 'view' THEN 'done' WHEN value > 50 THEN NULL ELSE event_type END AS after FROM events),
    new AS (SELECT after AS status, count(*) AS new_count FROM rows GROUP BY 1)
    SELECT status, (SELECT count(*) FROM rows WHERE before = status) AS previous_count, new_count,
    new_count - (SELECT count(*) FROM rows WHERE before = status) AS diff FROM new"""
SQL["progress_counts"] = """WITH
    before AS (SELECT status, count(*) AS n FROM (SELECT max_by(event_type, event_id) AS status FROM events
        WHERE event_id % 3 < 2 GROUP BY user_id) GROUP BY 1),
    after AS (SELECT status, count(*) AS n FROM (SELECT max_by(event_type, event_id) AS status FROM events GROUP BY user_id) GROUP BY 1)
    SELECT status, coalesce(before.n, 0) AS previous_count, after.n AS new_count, after.n - coalesce(before.n, 0) AS diff
    FROM after LEFT JOIN before USING (status)"""

# -- whole jobs --------------------------------------------------------------------------------

SQL["scrape_stories_job"] = f"""WITH {MIXED} SELECT doc_id, CASE WHEN lang <> 'en' THEN {_label('Not in English')}
    WHEN kind = 3 THEN {_label('Video/ Image content only')}
    WHEN source = 'src3' THEN {_label('Article not found')}
    WHEN failure = 0 THEN {_label('requests.exceptions.ReadTimeout')} WHEN failure = 1 THEN {_label('odd failure')}
    WHEN no_body THEN {_label('Article not found')} ELSE coalesce({_FOUND}, {_TEXT}) END AS text FROM mixed"""
_GOT = "(source <> 'src3' AND doc_id % 10 <> 0)"
_HTML = f"({_GOT} AND NOT no_body)"
SQL["article_jobs"] = f"""WITH {MIXED} SELECT doc_id, CAST(1 AS BIGINT) AS batch_id,
    CASE WHEN {_GOT} THEN 'CONTENT-FETCHED' ELSE 'FAILED' END AS status,
    CAST(CASE WHEN {_HTML} THEN 2 ELSE 1 END AS INT) AS tries, CASE WHEN {_HTML} THEN true END AS text_extracted,
    CASE WHEN {_HTML} THEN substr({_TEXT}, 1, 250) END AS abstract, CASE WHEN {_HTML} THEN {_ERROR} END AS parsing_error,
    {_HTML} AS has_html, {_HTML} AND {_TEXT} <> '' AS has_text FROM mixed"""
_GOT = "(source <> 'src3' AND doc_id % 10 <> 1)"
_HTML = f"(doc_id % 2 = 1 AND {_GOT} AND NOT no_body)"
SQL["batch_table_jobs"] = f"""WITH {MIXED} SELECT doc_id, CAST(1 + doc_id % 2 AS BIGINT) AS batch_id,
    CASE WHEN doc_id % 2 = 0 THEN 'UNPROCESSED' WHEN {_GOT} THEN 'CONTENT-FETCHED' ELSE 'FAILED' END AS status,
    CAST(CASE WHEN doc_id % 2 = 0 THEN 0 WHEN {_HTML} THEN 2 ELSE 1 END AS INT) AS tries,
    CASE WHEN {_HTML} THEN true END AS text_extracted, CASE WHEN {_HTML} THEN substr({_TEXT}, 1, 250) END AS abstract,
    CASE WHEN {_HTML} THEN {_ERROR} END AS parsing_error, {_HTML} AND {_TEXT} <> '' AS has_text,
    CAST(4 AS BIGINT) AS version FROM mixed"""
