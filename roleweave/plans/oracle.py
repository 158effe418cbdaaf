"""The catalogue's queries as SQL on the same tables, written independently of the Spark code."""

from __future__ import annotations

from roleweave.functions.classify import RelevanceRules
from roleweave.plans import adapters
from roleweave.plans.catalogue import PARAGRAPH_LABELS, SEARCH_WORDS
from roleweave.vocabulary import STOP_WORDS


def _words(fragments: tuple[str, ...]) -> str:
    """Whole-word alternation; the engine's own word boundary knows ASCII only."""
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join(fragments)})(?:$|[^\p{{L}}\p{{N}}_])"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hit(expr: str, fragments: tuple[str, ...]) -> str:
    return f"regexp_matches({expr}, {_quoted(_words(tuple(fragments)))})" if fragments else "FALSE"


def _relevance(rules: RelevanceRules, title: str, description: str) -> str:
    return (
        f"CASE WHEN {_hit(f'''({title} || ' ' || {description})''', rules.exclude)} THEN FALSE "
        f"WHEN {_hit(title, rules.include)} THEN TRUE "
        f"WHEN {_hit(title, rules.off_topic_titles)} THEN FALSE "
        f"ELSE {_hit(description, rules.include)} END"
    )


_DOCS = """
d0 AS (
  SELECT doc_id AS id, 'doc://' || doc_id AS url,
    CASE WHEN source LIKE 'src1%' THEN 'jobspy:LinkedIn/' || source WHEN source LIKE 'src2%' THEN 'jobspy:indeed' ELSE source END AS source,
    source AS site, lang AS company, lang, text, n_chars,
    split_part(text, chr(10), 1) AS title,
    substr(text, length(split_part(text, chr(10), 1)) + 2) AS description,
    (DATE '2024-01-01' + CAST(n_chars % 28 AS INTEGER)) AS posted_date,
    CASE WHEN n_chars >= 200 THEN CAST(n_chars % 101 AS DOUBLE) END AS score,
    CASE n_chars % 5 WHEN 0 THEN 'applied' WHEN 1 THEN 'skip' ELSE 'new' END AS application_status,
    CASE WHEN source = 'src3' THEN 1 WHEN source = 'src4' THEN 0 WHEN lang = 'en' THEN 1 WHEN lang IN ('fr', 'de') THEN 0 END AS is_remote
  FROM documents)
"""


def _docs(rules: RelevanceRules = adapters.PROSE_RULES) -> str:
    return f"{_DOCS}, d AS (SELECT *, {_relevance(rules, 'title', 'description')} AS is_relevant FROM d0)"


_SUMMARY = "id, title, company, score, posted_date, url, application_status"
_EMPTY = "trim(description, ' ' || chr(9) || chr(10) || chr(13)) = ''"
_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"


def _board_type(host: str) -> str:
    return (
        f"CASE WHEN {host} LIKE '%.com' THEN 'greenhouse' WHEN {host} LIKE '%.net' THEN 'lever' "
        f"WHEN {host} LIKE '%.org' THEN 'ashby' ELSE 'kula' END"
    )


def _html(expr: str) -> str:
    """Visible text by a chain of replacements; covers the markup and references the pages use."""
    cut = "chr(1)"
    out = f"regexp_replace({expr}, '(?s)<!--.*?-->', {cut}, 'g')"
    for hidden in ("script", "style", "template"):
        out = f"regexp_replace({out}, '(?is)<{hidden}[^>]*>.*?</{hidden}\\s*>', {cut}, 'g')"
    out = f"regexp_replace({out}, '(?s)<[a-zA-Z/!?][^>]*>', {cut}, 'g')"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        # A reference cut short by the next tag has no semicolon.
        out = f"regexp_replace(replace({out}, '&{name};', '{char}'), '&{name}([^-.a-zA-Z0-9;]|$)', '{char}\\1', 'g')"
    space = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"
    runs = f"list_transform(string_split({out}, {cut}), lambda r: trim(r, {space}))"
    return f"array_to_string(list_filter({runs}, lambda r: r <> ''), ' ')"


# ---------------------------------------------------------------- upsert


def _event_rows() -> str:
    return f"""
e AS (
  SELECT 'events' AS source, event_type AS company, event_type AS title, props AS description, props AS extra_json,
    CASE event_type WHEN 'click' THEN 'Remote' WHEN 'purchase' THEN 'Hybrid' END AS location,
    CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 0 END AS is_remote,
    'user://' || user_id AS url, CAST(ts AS DATE) AS posted_date, CAST(event_id AS VARCHAR) AS raw_id, ts, event_id,
    {_relevance(adapters.EVENT_RULES, 'event_type', 'props')} AS is_relevant,
    CASE WHEN ts >= TIMESTAMP '{adapters.SECOND_BATCH}' THEN 2 ELSE 1 END AS batch
  FROM events)"""


def _snapshot(single_batch: bool = False) -> str:
    """State after the batches: first sighting sets the fixed columns, the last one the others."""
    batch = "1" if single_batch else "batch"
    day = "DATE '2024-02-01'" if single_batch else "CASE WHEN {b} = 1 THEN DATE '2024-01-16' ELSE DATE '2024-02-01' END"
    first_day = day.format(b="f.batch")
    last_day = day.format(b="l.batch")
    return f"""{_event_rows()},
r AS (SELECT e.* REPLACE ({batch} AS batch),
    row_number() OVER (PARTITION BY url ORDER BY ts, event_id) AS up,
    row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS down FROM e),
f AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS id FROM r WHERE up = 1),
l AS (SELECT * FROM r WHERE down = 1),
s AS (SELECT f.id, f.url, f.raw_id, f.source, f.company, l.title, l.location, l.description, f.posted_date,
    {first_day} AS first_seen, {last_day} AS last_seen, CAST(l.is_relevant AS INTEGER) AS is_relevant, f.extra_json,
    CAST(NULL AS DOUBLE) AS score, 'new' AS application_status, l.is_remote FROM f JOIN l USING (url))"""


_STATUS = """
c AS (SELECT 'user://' || user_id AS url, ts, event_id,
  CASE event_type WHEN 'click' THEN 'applied' WHEN 'purchase' THEN 'skip' WHEN 'signup' THEN 'new' ELSE event_type END AS status
  FROM events),
last_status AS (SELECT url, status, ts FROM c WHERE status IN ('new', 'applied', 'skip')
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC) = 1)"""


# ---------------------------------------------------------------- vectors and ranks

_FIT = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
m AS (SELECT label, list(v ORDER BY i) AS raw FROM (SELECT label, i, avg(v) AS v FROM x GROUP BY ALL) GROUP BY label),
sec AS (SELECT CAST(label AS BIGINT) AS section, list_transform(raw, lambda z: z / sqrt(list_inner_product(raw, raw))) AS vec FROM m),
m1 AS (SELECT list(v ORDER BY i) AS raw FROM (SELECT i, avg(v) AS v FROM x GROUP BY i)),
res AS (SELECT list_transform(raw, lambda z: z / sqrt(list_inner_product(raw, raw))) AS vec FROM m1),
p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
sims AS (SELECT vec_id, section, list_inner_product(p.vec, sec.vec) AS sim,
  row_number() OVER (PARTITION BY vec_id ORDER BY list_inner_product(p.vec, sec.vec) DESC, section) AS place FROM p, sec),
fit AS (SELECT p.vec_id, p.label, max(sim) AS fit_max, avg(sim) FILTER (place <= 3) AS fit_top3,
  any_value(list_inner_product(p.vec, res.vec)) AS resume_cos FROM p JOIN sims USING (vec_id), res GROUP BY p.vec_id, p.label)"""


def _spearman(source: str, keys: str, actual: str, predicted: str) -> str:
    """Average ranks within each group, then their correlation; flat sides give 0."""
    part = f"PARTITION BY {keys}"
    return f"""
ranks AS (SELECT {keys}, {actual} AS a, {predicted} AS b,
  rank() OVER ({part} ORDER BY {actual}) + (count(*) OVER ({part}, {actual}) - 1) / 2.0 AS ra,
  rank() OVER ({part} ORDER BY {predicted}) + (count(*) OVER ({part}, {predicted}) - 1) / 2.0 AS rb FROM {source}),
rho AS (SELECT {keys}, CASE WHEN min(a) = max(a) OR min(b) = max(b) THEN 0.0 ELSE round(corr(ra, rb), 6) END AS spearman
  FROM ranks GROUP BY {keys})"""


# ---------------------------------------------------------------- tokens


_ABBREVIATED = (
    "approx assoc ave bldg co corp dept dr ed eq est etc fig gen gov inc jr ltd "
    "max min mr mrs ms no nos pp prof ref rep resp sr st univ viz vol vs"
).split()


def _tokens() -> str:
    """Tokens by the Treebank rules, blank by blank: each line below sets one kind of mark apart."""
    steps = (
        ("(^|[\\s(\\[{<])\"", "\\1 `` "),
        ("([:,])([^0-9])", " \\1 \\2"),
        ("([:,])$", " \\1 "),
        ("[.][.][.]", " ... "),
        ("([;@#$%&?!])", " \\1 "),
        # Blanks are doubled, as a match takes those around it; the stop of an abbreviation is hidden from the next line.
        ("(\\s)", "\\1\\1"),
        (f"(^|\\s)([(\\[{{<]*(?:{'|'.join(_ABBREVIATED)}))[.]", "\\1\\2\x01"),
        ("(^|\\s)([^\\s.\x01][^\\s.\x01]+)[.]([\\])}>\"'']*)(\\s|$)", "\\1\\2 . \\3\\4"),
        ("\x01", "."),
        ("([][(){}<>])", " \\1 "),
        ("--", " -- "),
        ("''''|\"", " '''' "),
        ("([^'' ])(''s|''m|''d|'') ", "\\1 \\2 "),
        ("([^'' ])(''ll|''re|''ve|n''t) ", "\\1 \\2 "),
        ("\\bcannot\\b", " can not "),
        ("\\b(gim|lem)me\\b", " \\1 me "),
        ("\\b(gon|wan)na\\b", " \\1 na "),
        ("\\bgotta\\b", " got ta "),
        (" ''t(is|was)\\b", " ''t \\1 "),
    )
    apart = "lower(text) || ' '"
    for pattern, replacement in steps:
        apart = f"regexp_replace({apart}, '{pattern}', '{replacement}', 'g')"
    stop = ", ".join(_quoted(w) for w in STOP_WORDS)
    punctuation = _quoted("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return f"""
t AS (SELECT doc_id, list_filter(regexp_split_to_array({apart}, '\\s+'),
  lambda w: w <> '' AND NOT contains({punctuation}, w) AND w NOT IN ({stop})) AS tokens FROM documents)"""


_PARAGRAPH_HEAD = rf"(?i)^\s*(?:[#*]+\s*)?(?:{PARAGRAPH_LABELS})(?:$|[^\p{{L}}\p{{N}}_])"
_PARAGRAPH_LONE = rf"(?i)^\s*(?:[#*]+\s*)?(?:{PARAGRAPH_LABELS})[\s:*]*$"


def oracle_sql() -> dict[str, str]:
    docs = _docs()
    page = f"pg AS (SELECT *, {_HOST} AS host FROM pages)"
    title = _html("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
    log = f"""{page}, lg AS (SELECT page_id, host, {_board_type('host')} AS ats_type,
      CASE WHEN contains(url, '#') THEN 404 ELSE 200 END AS http_status,
      CASE WHEN contains(url, '?') THEN 0 ELSE len(string_split(html, '<li>')) - 1 END AS n_jobs,
      CASE WHEN url LIKE '%/' THEN 'timed out' END AS error FROM pg),
    chk AS (SELECT *, CASE WHEN ats_type = 'kula' THEN 'SKIP' WHEN error IS NOT NULL THEN 'ERROR'
      WHEN http_status = 200 AND n_jobs > 0 THEN 'OK' WHEN http_status = 200 THEN 'WARN' ELSE 'FAIL' END AS status FROM lg)"""
    day = "CAST(ts AS DATE)"
    # Doubled blanks let two legal words in a row match, since each match takes its neighbours.
    slug = """sl AS (SELECT page_id, title, trim(regexp_replace(replace(regexp_replace(name, '[.,]', '', 'g'), ' ', '  '),
        '(?i)(^|[^\\p{L}\\p{N}_])(?:inc|incorporated|llc|corp|corporation|co|ltd|plc|group|holdings)($|[^\\p{L}\\p{N}_])', '\\1\\2', 'g')) AS base,
        lower(regexp_replace(name, '\\s+', '', 'g')) AS raw FROM nm),
      w AS (SELECT page_id, title, raw, list_filter(string_split(regexp_replace(replace(base, '&', 'and'), '[^A-Za-z0-9 -]', '', 'g'), ' '), lambda z: z <> '') AS words FROM sl),
      cand AS (SELECT page_id, title, list_sort(list_distinct(list_filter([lower(array_to_string(words, '')), lower(array_to_string(words, '-')), raw], lambda z: z <> ''))) AS slugs FROM w)"""
    payload_day = "CAST('2024-02-' || lpad(CAST(length(html) % 28 + 1 AS VARCHAR), 2, '0') AS DATE)"
    language = "regexp_extract(html, 'lang=\"(\\w+)\"', 1)"

    return {
        "triage_default": f"WITH {docs} SELECT {_SUMMARY} FROM d WHERE is_relevant AND application_status <> 'skip'",
        "triage_filtered": f"""WITH {docs} SELECT {_SUMMARY} FROM d WHERE is_relevant AND application_status <> 'skip'
            AND company IN ('en', 'fr') AND source IN ('jobspy:indeed', 'src0', 'src3', 'src4', 'jobspy:LinkedIn/src11') AND is_remote = 1""",
        "triage_score_range": f"""WITH {docs} SELECT {_SUMMARY} FROM d WHERE is_relevant AND application_status <> 'skip'
            AND score BETWEEN 0 AND 50""",
        "triage_keyword": f"""WITH {docs} SELECT {_SUMMARY} FROM d WHERE application_status = 'new'
            AND regexp_matches(title, '[tT][hH][oO][nN]')""",
        "triage_status_all": f"WITH {docs} SELECT {_SUMMARY} FROM d WHERE is_remote = 0",
        "triage_next": f"""WITH {docs} SELECT id, score, lead(id) OVER (ORDER BY score DESC NULLS LAST, id) AS next_id
            FROM d WHERE is_relevant""",
        "triage_display": f"""WITH {docs} SELECT id, coalesce(printf('%.1f', score), '—') AS score_text,
            CAST(posted_date AS VARCHAR) AS posted_text FROM d""",
        "filter_options": f"""WITH {docs} SELECT DISTINCT 'company' AS kind, company AS value FROM d
            UNION ALL SELECT DISTINCT 'source', source FROM d""",
        "posting_detail": f"""WITH {docs} SELECT id, title, company, source, description, score, posted_date, url,
            application_status FROM d WHERE id = 42""",
        "new_since": f"""WITH {docs} SELECT company, title, url FROM d WHERE is_relevant AND posted_date >= DATE '2024-01-14'""",
        "pending_score": f"WITH {docs} SELECT url, description FROM d WHERE is_relevant AND score IS NULL AND NOT ({_EMPTY})",
        "missing_description": f"""WITH {docs} SELECT url FROM d WHERE is_relevant AND lower(source) LIKE 'jobspy:linkedin%' AND {_EMPTY}""",
        "backlog_count": f"""WITH {docs} SELECT count(*) AS n FROM d WHERE is_relevant AND score IS NULL AND lower(source) LIKE 'jobspy:linkedin%'""",
        "aggregator_companies": f"WITH {docs} SELECT DISTINCT company FROM d WHERE lower(source) LIKE 'jobspy%'",
        "failed_runs": "SELECT event_id, props AS error FROM events WHERE event_type = 'error'",
        "relevance_flag": f"WITH {docs} SELECT id, CAST(is_relevant AS INTEGER) AS is_relevant FROM d",
        "relevance_default_rules": f"WITH {_docs(RelevanceRules())} SELECT id, CAST(is_relevant AS INTEGER) AS is_relevant FROM d",
        "relevance_counts": f"""WITH {docs} SELECT source, count(*) AS postings, count(*) FILTER (is_relevant) AS relevant FROM d GROUP BY source""",
        "remote_flag": f"WITH {docs} SELECT id, is_remote FROM d",
        "html_text": f"SELECT page_id, {_html('html')} AS text FROM pages",
        "date_from_iso": f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {day} END AS posted_date FROM events",
        "date_from_millis": f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {day} END AS posted_date FROM events",
        "url_last_segment": """SELECT page_id, regexp_extract(rtrim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*', ''), '/'),
            '([^/]*)$', 1) AS segment FROM pages""",
        "slug_candidates": f"""WITH nm AS (SELECT page_id, {title} AS title, {title} || ' & Co., Inc.' AS name FROM pages), {slug}
            SELECT page_id, array_to_string(slugs, '|') AS slugs FROM cand""",
        "section_split": """WITH pt AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda z, i:
              trim(CASE WHEN i = 1 THEN z ELSE '## ' || z END)), lambda z: length(z) > 40) AS parts FROM documents)
            SELECT doc_id, CAST(len(parts) AS INTEGER) AS sections, CAST(coalesce(list_sum(list_transform(parts, lambda z: length(z))), 0) AS INTEGER) AS chars FROM pt""",
        "front_matter": "SELECT doc_id, text FROM documents",
        "requirement_paragraphs": f"""WITH pt AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
            SELECT doc_id, array_to_string(list_filter(parts, lambda z, i: regexp_matches(z, {_quoted(_PARAGRAPH_HEAD)})
              OR (i > 1 AND regexp_matches(parts[i - 1], {_quoted(_PARAGRAPH_LONE)}))), chr(10) || chr(10)) AS text FROM pt""",
        "feed_greenhouse": f"""WITH {page} SELECT 'greenhouse' AS source, host AS company, host AS title, {language} AS location,
            {_html('html')} AS description, url, {payload_day} AS posted_date, CAST(page_id AS VARCHAR) AS raw_id,
            '{{"departments":["' || {language} || '"],"offices":["' || host || '"]}}' AS extra_json
            FROM pg WHERE host LIKE '%.com' AND NOT contains(url, '#')""",
        "feed_lever": f"""SELECT 'lever' AS source, event_type AS company, event_type AS title, event_type AS location, '' AS description,
            'user://' || user_id AS url, {day} AS posted_date, CAST(event_id AS VARCHAR) AS raw_id,
            '{{"categories":{{"location":"' || event_type || '","team":null}}}}' AS extra_json FROM events WHERE event_type <> 'error'""",
        "feed_ashby": """SELECT 'ashby' AS source, source AS company, split_part(text, chr(10), 1) AS title, lang AS location, text AS description,
            'doc://' || doc_id AS url, DATE '2024-03-01' AS posted_date, CAST(doc_id AS VARCHAR) AS raw_id,
            '{"department":"' || source || '","team":null,"employmentType":"full"}' AS extra_json FROM documents""",
        "feed_workday": f"""WITH {page}, listed AS (
              SELECT *, 'a' AS run FROM pg UNION ALL SELECT *, 'b' FROM pg WHERE page_id % 2 = 0),
            lost AS (SELECT DISTINCT page_id // 50 AS tenant FROM pg WHERE page_id % 200 = 120)
            SELECT 'workday' AS source, 'company t' || page_id // 50 AS company, host AS title, 'US - Remote' AS location,
            {_html('html')} AS description, 'https://t' || page_id // 50 || '.wd1.myworkdayjobs.com/careers/job/' || page_id AS url,
            CAST(DATE '2024-02-01' + CAST(page_id % 28 AS INTEGER) AS DATE) AS posted_date, CAST(page_id AS VARCHAR) AS raw_id,
            '{{"bulletFields":["t' || page_id // 50 || '"]}}' AS extra_json
            FROM listed WHERE run = 'a' OR page_id // 50 NOT IN (SELECT tenant FROM lost)""",
        "feed_aggregator": f"""WITH {_DOCS} SELECT 'jobspy:' || CASE WHEN site = 'src7' THEN 'unknown' ELSE site END AS source, lang AS company, title,
            CASE lang WHEN 'en' THEN 'en, US' WHEN 'de' THEN NULL ELSE lang END AS location, description, url,
            CASE WHEN lang <> 'fr' THEN posted_date END AS posted_date, CAST(NULL AS VARCHAR) AS raw_id,
            CASE WHEN lang = 'es' THEN '{{"is_remote":true}}' ELSE '{{"job_type":"' || site || '"}}' END AS extra_json
            FROM d0 WHERE site <> 'src9'""",
        "feed_rejects": f"""WITH {page} SELECT host AS company_name, page_id AS landed FROM pg WHERE host LIKE '%.com' AND contains(url, '#')
            UNION ALL SELECT event_type, event_id FROM events WHERE event_type = 'error'""",
        "listing_pages": """WITH pgs AS (SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS INTEGER) AS jobs FROM conversations)
            SELECT conv_id, turn, jobs FROM pgs p WHERE NOT EXISTS
            (SELECT 1 FROM pgs q WHERE q.conv_id = p.conv_id AND q.turn < p.turn AND q.jobs < 20)""",
        "search_plan_capped": f"""WITH {_DOCS}, landed AS (SELECT id AS doc_id, term AS search_term, lang AS search_location, site, posted_date
              FROM d0, (SELECT unnest([{', '.join(_quoted(w) for w in SEARCH_WORDS)}]) AS term) WHERE contains(lower(text), term)
              AND lang IN ('en', 'fr', 'de') AND posted_date >= DATE '2024-01-10')
            SELECT search_term, search_location, site, doc_id, CAST(result_rank AS INTEGER) AS result_rank FROM (SELECT *, row_number() OVER
              (PARTITION BY search_term, search_location, site ORDER BY posted_date DESC, doc_id) AS result_rank FROM landed) WHERE result_rank <= 5""",
        "upsert_snapshot": f"WITH {_snapshot()} SELECT * FROM s",
        "upsert_run_stats": f"""WITH {_event_rows()} SELECT CAST(count(*) AS BIGINT) AS fetched_count,
            count(DISTINCT url) FILTER (url NOT IN (SELECT url FROM e WHERE batch = 1)) AS new_count,
            count(*) - count(DISTINCT url) FILTER (url NOT IN (SELECT url FROM e WHERE batch = 1)) AS updated_count FROM e WHERE batch = 2""",
        "store_round_trip": f"WITH {_snapshot()} SELECT * FROM s",
        "stream_ingest": f"WITH {_snapshot(single_batch=True)} SELECT * FROM s",
        "stream_board_postings": f"""WITH {page}, bad AS (SELECT DISTINCT host, page_id % 3 AS wave FROM pg WHERE contains(url, '#')),
            j AS (SELECT *, {language} AS language FROM pg WHERE host LIKE '%.com' AND (host, page_id % 3) NOT IN (SELECT host, wave FROM bad)),
            r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id % 3, page_id) AS up,
              row_number() OVER (PARTITION BY url ORDER BY page_id % 3 DESC, page_id DESC) AS down FROM j),
            s AS (SELECT f.url, CAST(f.page_id AS VARCHAR) AS raw_id, 'greenhouse' AS source, f.host AS company, l.host AS title, l.language AS location,
              {_html('l.html')} AS description, {payload_day.replace('html', 'f.html')} AS posted_date,
              '{{"departments":["' || f.language || '"],"offices":["' || f.host || '"]}}' AS extra_json
              FROM r f JOIN r l USING (url) WHERE f.up = 1 AND l.down = 1)
            SELECT *, CAST({_relevance(adapters.PROSE_RULES, 'title', 'description')} AS INTEGER) AS is_relevant FROM s""",
        "stream_board_rejects": f"""WITH {page} SELECT 'greenhouse' AS source, host AS company_name, count(DISTINCT page_id % 3) AS files
            FROM pg WHERE host LIKE '%.com' AND contains(url, '#') GROUP BY host""",
        "stream_scored": f"""WITH {_event_rows()},
            l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY url, batch ORDER BY ts DESC, event_id DESC) = 1),
            p AS (SELECT * FROM l WHERE is_relevant AND description <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch) = 1)
            SELECT b AS batch, count(p.url) AS scored, (SELECT count(*) FROM p) AS stored, (SELECT CAST(sum(length(description)) AS BIGINT) FROM p) AS total
            FROM (SELECT unnest(range(1, 3))::INTEGER AS b) LEFT JOIN p ON batch = b GROUP BY b""",
        "score_writeback": f"""WITH {_DOCS} SELECT id, coalesce(quality * 100.0::DOUBLE, score) AS score FROM d0 LEFT JOIN labels ON doc_id = id""",
        "score_writeback_count": "SELECT count(*) AS updated_count FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
        "description_writeback": f"""WITH {docs} SELECT id, CASE WHEN is_relevant AND lower(source) LIKE 'jobspy:linkedin%' AND {_EMPTY}
            AND lang = 'en' AND text <> '' THEN text ELSE description END AS description FROM d""",
        "status_latest": f"WITH {_STATUS} SELECT url, status, {day} AS changed_on FROM last_status",
        "status_applied": f"""WITH {_STATUS} SELECT u.url, coalesce(status, 'new') AS application_status, {day} AS changed_on
            FROM (SELECT DISTINCT 'user://' || user_id AS url FROM events WHERE ts < TIMESTAMP '{adapters.SECOND_BATCH}') u LEFT JOIN last_status USING (url)""",
        "status_validation": f"""WITH {_STATUS} SELECT CAST(status IN ('new', 'applied', 'skip') AS INTEGER) AS valid, status, count(*) AS events
            FROM c GROUP BY ALL""",
        "conform_older": f"""SELECT page_id AS id, url, {title} AS title, CAST(NULL AS DOUBLE) AS score, 'new' AS application_status,
            CAST(NULL AS INTEGER) AS is_remote FROM pages""",
        "known_company_anti": """SELECT c_custkey, '  COMPANY ' || substr(c_name, 10) AS name FROM customer
            WHERE substr(c_name, 10) NOT IN (SELECT substr(s_name, 10) FROM supplier)""",
        "name_first_dedup": """WITH n AS (SELECT doc_id AS line_no, trim(array_to_string(string_split(text, ' ')[1:2], ' '), ' ' || chr(9) || chr(10) || chr(13)) AS name FROM documents)
            SELECT name, line_no FROM n WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY line_no) = 1""",
        "board_health": f"""WITH {log} SELECT page_id, status, rpad(status, 8, ' ') || CASE status
            WHEN 'OK' THEN host || ' (' || host || '): ' || n_jobs || ' jobs' WHEN 'WARN' THEN host || ' (' || host || '): 200 but no jobs returned'
            WHEN 'FAIL' THEN host || ' (' || host || '): HTTP ' || http_status WHEN 'ERROR' THEN host || ' (' || host || '): ' || error
            ELSE host || ' (ats_type=' || ats_type || ', not yet supported)' END AS line FROM chk""",
        "board_health_summary": f"WITH {log} SELECT status, count(*) AS boards, CAST(sum(n_jobs) AS BIGINT) AS jobs FROM chk GROUP BY status",
        "all_boards_healthy": f"WITH {log} SELECT CAST(bool_and(status IN ('OK', 'SKIP')) AS INTEGER) AS all_ok FROM chk",
        "first_board_hit": f"""WITH {log} SELECT host AS company, ats_type, CAST(page_id AS VARCHAR) AS slug, CAST(n_jobs AS INTEGER) AS n_jobs,
            host || ',' || ats_type || ',' || page_id || ',,' || CASE ats_type WHEN 'greenhouse' THEN 'https://job-boards.greenhouse.io/'
            WHEN 'lever' THEN 'https://jobs.lever.co/' ELSE 'https://jobs.ashbyhq.com/' END || page_id || ',verified 2024-02-01 - ' || n_jobs || ' jobs' AS line
            FROM lg WHERE n_jobs > 0 AND ats_type <> 'kula'
            QUALIFY row_number() OVER (PARTITION BY host ORDER BY CAST(page_id AS VARCHAR)) = 1""",
        "detect_boards": f"""WITH {log}, nm AS (SELECT page_id, {title} AS title, {title} AS name FROM pages), {slug},
            landed AS (SELECT ats_type, lower(regexp_replace(title, '[^A-Za-z0-9]', '', 'g')) AS slug, max(n_jobs) AS n_jobs FROM nm JOIN lg USING (page_id) GROUP BY 1, 2),
            names AS (SELECT DISTINCT title, unnest(slugs) AS slug FROM cand)
            SELECT title AS company, ats_type, slug, CAST(n_jobs AS INTEGER) AS n_jobs FROM names JOIN landed USING (slug) WHERE n_jobs > 0 AND ats_type <> 'kula'
            QUALIFY row_number() OVER (PARTITION BY title ORDER BY slug, list_position(['greenhouse', 'lever', 'ashby'], ats_type)) = 1""",
        "relevant_titles": f"""WITH {_DOCS}, d AS (SELECT *, {_relevance(adapters.PROSE_RULES, 'title', "''")} AS ok FROM d0)
            SELECT source, company, count(*) AS n_jobs, count(*) FILTER (ok) AS n_relevant FROM d GROUP BY source, company HAVING count(*) FILTER (ok) > 0""",
        "cross_source_duplicates": r"""WITH RECURSIVE p AS (
              SELECT doc_id AS id, CASE WHEN source LIKE 'src1%' THEN 'jobspy:linkedin' ELSE source END AS source, lang AS company,
                trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\p{L}\p{N}]+', ' ', 'g')) AS title,
                ['', 'boston ma', 'boston ma', 'remote'][n_chars % 4 + 1] AS place FROM documents),
            k AS (SELECT DISTINCT company, title FROM p WHERE title <> ''),
            near AS (SELECT a.company, a.title AS t, b.title AS u FROM k a JOIN k b ON a.company = b.company
              AND abs(length(a.title) - length(b.title)) <= 2 WHERE levenshtein(a.title, b.title) <= 2),
            links AS (SELECT a.id AS a, b.id AS b FROM near n JOIN p a ON a.company = n.company AND a.title = n.t
              JOIN p b ON b.company = n.company AND b.title = n.u
              WHERE a.source <> b.source AND (a.place = b.place OR a.place = '' OR b.place = '')),
            reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
            g AS (SELECT p.id, p.source, least(p.id, coalesce(min(b), p.id)) AS group_id FROM p LEFT JOIN reach ON a = p.id GROUP BY p.id, p.source)
            SELECT id, group_id, CAST(row_number() OVER (PARTITION BY group_id ORDER BY source LIKE 'jobspy%', id) = 1 AS INTEGER) AS survives FROM g""",
        "section_similarity": f"WITH {_FIT} SELECT vec_id, CAST(place - 1 AS INTEGER) AS place, section, round(sim, 6) AS sim FROM sims WHERE place <= 3",
        "fit_features": f"""WITH {_FIT} SELECT vec_id, round(fit_max, 6) AS fit_max, round(fit_top3, 6) AS fit_top3,
            round(resume_cos, 6) AS resume_cos FROM fit""",
        "spearman_zero_shot": f"""WITH {_FIT}, long AS (SELECT 'fit_max' AS feature, label, round(fit_max, 9) AS value FROM fit
            UNION ALL SELECT 'fit_top3', label, round(fit_top3, 9) FROM fit UNION ALL SELECT 'resume_cos', label, round(resume_cos, 9) FROM fit),
            {_spearman('long', 'feature', 'label', 'value')} SELECT feature, spearman FROM rho""",
        "model_comparison": f"""WITH {_DOCS}, g AS (SELECT lang AS model, 'quality_' || quality AS family, length(description) AS chars, length(title) AS title_chars
            FROM d0 JOIN labels ON doc_id = id), {_spearman('g', 'model, family', 'chars', 'title_chars')}
            SELECT model, max(spearman) FILTER (family = 'quality_0') AS quality_0, max(spearman) FILTER (family = 'quality_1') AS quality_1 FROM rho GROUP BY model""",
        "residual_table": f"""WITH {_DOCS} SELECT id, score, CAST(length(title) AS DOUBLE) AS prediction, length(title) - score AS pred_vs_score
            FROM d0 WHERE score IS NOT NULL""",
        "population_scaler": """WITH x AS (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS dim FROM embeddings)
            SELECT CAST(dim AS INTEGER) AS dim, round(avg(v), 6) AS mean, round(CASE WHEN min(v) = max(v) THEN 1.0 ELSE stddev_pop(v) END, 6) AS scale FROM x GROUP BY dim""",
        "training_join": f"""WITH {_DOCS} SELECT CAST(id AS VARCHAR) AS name, quality * 100.0::DOUBLE AS score, description
            FROM d0 JOIN labels ON doc_id = id""",
        "training_skipped": f"""WITH {_DOCS} SELECT CAST(l.doc_id AS VARCHAR) AS name, quality * 100.0::DOUBLE AS score FROM labels l
            WHERE NOT EXISTS (SELECT 1 FROM d0 WHERE id = l.doc_id)""",
        "corpus_abbreviations": r"""WITH p AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS part FROM documents),
            w AS (SELECT regexp_replace(regexp_replace(part, '^[("''\[{<]+', ''), '[)"''\]}>,;:!?]+$', '') AS b FROM p),
            c AS (SELECT regexp_replace(b, '[.]$', '') AS word, count(*) FILTER (b LIKE '%.') AS k, count(*) FILTER (b NOT LIKE '%.') AS r FROM w WHERE b <> '' GROUP BY 1),
            t AS (SELECT sum(k) / sum(k + r) AS p FROM c),
            s AS (SELECT word, k, r, length(word) - length(replace(word, '.', '')) + 1 AS dots, length(replace(word, '.', '')) AS letters,
              -2 * ((k * ln(p) + r * ln(1 - p)) - (k * ln(0.99) + r * ln(0.01))) AS l FROM c, t WHERE k > 0 AND regexp_matches(word, '\p{L}')),
            z AS (SELECT word, k AS with_stop, r AS without_stop, l * exp(-letters) * dots * exp(-r * ln(letters)) AS score FROM s)
            SELECT word, with_stop, without_stop, round(score, 6) AS score FROM z WHERE score >= 0.3""",
        "document_frequency": f"WITH {_tokens()} SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(tokens)) AS term FROM t) GROUP BY term",
        "bow_top_terms": f"""WITH {_tokens()},
            g AS (SELECT doc_id, list_concat(tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS terms FROM t),
            c AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(terms)) AS term FROM g) GROUP BY term),
            n AS (SELECT count(*) AS n FROM documents)
            SELECT term, df, round(ln((1.0 + n) / (1.0 + df)) + 1.0, 6) AS idf FROM c, n WHERE df >= 2 AND df <= 0.8 * n ORDER BY df DESC, term LIMIT 1000""",
    }
