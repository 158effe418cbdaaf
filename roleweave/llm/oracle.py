"""DuckDB twins of the corpus queries that SQL can express, written from the contract and not from the operators."""

from __future__ import annotations

from roleweave.llm.oracle_manifest import CONVERSATION, MERKLE

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALPHANUMERIC}') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all({LOWER}, '{ALPHANUMERIC}') AS w FROM benchmark),
     item_windows AS (
       SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     lengths AS (SELECT DISTINCT n FROM item_windows),
     doc_windows AS (
       SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
     hits AS (SELECT doc_id, item_id, i, n FROM doc_windows JOIN item_windows USING (n, s)),
     places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
     items AS (
       SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{NOT_SPACE}') AS w FROM documents),
     s AS (
       SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
     links AS (
       SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
     reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON a = d.doc_id GROUP BY d.doc_id
"""

_BIN = "(({x} >> greatest(length(bin({x})) - 6, 0)) << greatest(length(bin({x})) - 6, 0))"
# Measure, its expression, and the least spread of its fence.
_MEASURES = (
    ("symbols", "1000 * n_symbols // greatest(word_chars, 1)", 50),
    ("dup_lines", "1000 * n_dup_lines // greatest(n_lines, 1)", 75),
    ("repeats", "1000 * n_repeat_words // greatest(n_words, 1)", 50),
    ("word_length", "100 * word_chars // greatest(n_words, 1)", 25),
)
QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}') AS w FROM documents),
     grams AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
     twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
     repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
     line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
     lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
     m AS (
       SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
              CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
              coalesce(lines.n, 0) AS n_lines, coalesce(repeats.n, 0) AS n_repeat_words
       FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
     j AS (
       SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
              {", ".join(f"{expression} AS {name}" for name, expression, _ in _MEASURES)}
       FROM m),
     long AS (UNPIVOT (SELECT lang, source, base_failed, {", ".join(f"CAST({name} AS BIGINT) AS {name}" for name, _, _ in _MEASURES)} FROM j) ON {", ".join(x[0] for x in _MEASURES)} INTO NAME measure VALUE x),
     bins AS (SELECT lang, source, measure, {_BIN.format(x="x")} AS f, count(*) AS n FROM long WHERE NOT base_failed GROUP BY ALL),
     run AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY f) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM bins),
     q AS (
       SELECT lang, source, measure, min(f) FILTER (WHERE upto * 4 >= total) AS q1, min(f) FILTER (WHERE upto * 4 >= total * 3) AS q3
       FROM run GROUP BY ALL),
     fence AS (
       SELECT lang, source, {", ".join(f"max(q3 + 4 * greatest(q3 - q1, {spread})) FILTER (WHERE measure = '{name}') AS high_{name}" for name, _, spread in _MEASURES)},
              max(q1 - 4 * greatest(q3 - q1, 25)) FILTER (WHERE measure = 'word_length') AS low_word_length
       FROM q GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce({" OR ".join(f"{name} > high_{name}" for name, _, _ in _MEASURES)} OR word_length < low_word_length, FALSE) AS kept
FROM j LEFT JOIN fence ON j.lang IS NOT DISTINCT FROM fence.lang AND j.source IS NOT DISTINCT FROM fence.source
"""

# Bytes as pairs of hexadecimal digits.
SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     win AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 AS BIGINT) - 99)) AS s FROM d WHERE length(h) >= 200)),
     judged AS (SELECT doc_id, s, min((doc_id, s)) OVER (PARTITION BY x) AS first FROM win),
     gone AS (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 1 ELSE 0 END AS new FROM judged WHERE (doc_id, s) <> first),
     numbered AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM gone),
     runs AS (SELECT doc_id, k, min(s) AS low, max(s) + 100 AS high FROM numbered GROUP BY ALL),
     gaps AS (
       SELECT doc_id, low, high, coalesce(lag(high) OVER o, 0) AS before, row_number() OVER o = count(*) OVER (PARTITION BY doc_id) AS last
       FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY low)),
     cut AS (
       SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans,
              string_agg(substr(h, 2 * before + 1, 2 * (low - before)) || CASE WHEN last THEN substr(h, 2 * high + 1) ELSE '' END, '' ORDER BY low) AS kept
       FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLE_SQL = {
    "op5_benchmark_decontamination": DECONTAMINATION,
    "op6_ngram_jaccard_join": JACCARD,
    "op7_quality_rules": QUALITY,
    "op10_suffix_array_dedup": SUFFIXES,
    "op11_conversation_repair": CONVERSATION,
    "op13_merkle_manifest": MERKLE,
}
