"""DuckDB twins of the Merkle manifest and of conversation repair, written from the contract."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: bytes are xored in, and eight shifts follow each."""
    bits = f"flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split({text}, '')])"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]), lambda a, x: {step}))"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


MERKLE = f"""
WITH RECURSIVE rows_ AS (
       SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
              CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS changed
       FROM documents),
     leaves AS (
       SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
       FROM rows_),
     tree AS (
       SELECT 0 AS lvl, lang, i, n, leaf AS d FROM leaves
       UNION ALL
       SELECT lvl + 1, lang, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lvl, lang, n, i // 2),
     subs AS (
       SELECT lang, d, row_number() OVER (ORDER BY lang COLLATE "binary" NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
     upper_ AS (
       SELECT 0 AS lvl, i, n, d FROM subs
       UNION ALL
       SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM upper_ WHERE n > 1 GROUP BY lvl, n, i // 2),
     root AS (SELECT d AS root FROM upper_ WHERE n = 1),
     named AS (
       SELECT leaves.*, subs.d AS subroot, subs.i AS s, row_number() OVER () AS r
       FROM leaves JOIN subs ON leaves.lang IS NOT DISTINCT FROM subs.lang),
     -- Every level of a row's path, whether it has a sibling there or not.
     steps AS (
       SELECT r, own.lvl AS place, own.i % 2 AS side, sib.d AS d
       FROM named JOIN tree own ON own.lang IS NOT DISTINCT FROM named.lang AND own.i = named.i >> own.lvl AND own.n > 1
       LEFT JOIN tree sib ON sib.lang IS NOT DISTINCT FROM named.lang AND sib.lvl = own.lvl AND sib.i = xor(own.i, 1)
       UNION ALL
       SELECT r, 1000 + own.lvl, own.i % 2, sib.d
       FROM named JOIN upper_ own ON own.i = named.s >> own.lvl AND own.n > 1
       LEFT JOIN upper_ sib ON sib.lvl = own.lvl AND sib.i = xor(own.i, 1)),
     placed AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY place) AS k FROM steps),
     proof AS (SELECT r, sha256(coalesce(string_agg(d, '' ORDER BY place), '')) AS proof_sha256, max(k) AS k FROM placed GROUP BY r),
     folded AS (
       SELECT r, 0 AS k, coalesce(changed, leaf) AS f FROM named
       UNION ALL
       SELECT folded.r, placed.k, sha256(CASE WHEN d IS NULL THEN f WHEN side = 1 THEN d || f ELSE f || d END)
       FROM folded JOIN placed ON placed.r = folded.r AND placed.k = folded.k + 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f AS folded_root, f = root AS verified
FROM named CROSS JOIN root LEFT JOIN proof USING (r) JOIN folded ON folded.r = named.r AND folded.k = coalesce(proof.k, 0)
"""

# A conversation's state is one string for each state of the roles (none yet, s, u, a): cost, padded, then the audit.
_TEXT = r"'[^\x20\x09-\x0D]'"


def _plus(state: str, cost: str, mark: str) -> str:
    return f"(lpad(CAST(CAST(left({state}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({state}, 13) || '{mark}')"


def _kept(role: str, *states: str) -> str:
    """The least way to place the row as `role` behind any of the states."""
    mark = f"CASE WHEN starts_with(x.role, '{role}') THEN {{k}} ELSE {{r}} END"
    ways = []
    for s in states:
        k = _plus(s, "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END", "K")
        r = _plus(s, "CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END", "R") if role != "s" else "NULL"
        ways.append(mark.format(k=k, r=r))
    return f"CASE WHEN fault IN ('blank', 'duplicate') THEN NULL ELSE least({', '.join(ways)}) END" if len(ways) > 1 else f"CASE WHEN fault IN ('blank', 'duplicate') THEN NULL ELSE {ways[0]} END"


def _inserted(n: str, s: str, u: str, a: str) -> tuple[str, str, str, str]:
    """Insertions behind a row. Two in a row lead back to a state, so longer chains never win."""
    return n, s, f"least({u}, {_plus(n, '5', 'I')}, {_plus(s, '5', 'I')}, {_plus(a, '5', 'I')})", f"least({a}, {_plus(u, '5', 'I')}, {_plus(n, '10', 'II')}, {_plus(s, '10', 'II')})"


_STEP = dict(
    n=_plus("n", "2", "D"),
    s=f"least({_plus('s', '2', 'D')}, {_kept('s', 'n')})",
    u=f"least({_plus('u', '2', 'D')}, {_kept('u', 'n', 's', 'a')})",
    a=f"least({_plus('a', '2', 'D')}, {_kept('a', 'u')})",
)
_N, _S, _U, _A = _inserted("n", "s", "u", "a")

CONVERSATION = rf"""
WITH RECURSIVE kinds AS (
       SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
       FROM conversations),
     damaged AS (
       SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
              CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
       FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM kinds)),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
     faults AS (
       SELECT *, CASE WHEN NOT regexp_matches(text, {_TEXT}) THEN 'blank'
                      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                      WHEN NOT contains('.!?', right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1)) THEN 'truncated' ELSE '' END AS fault,
              left(role, 1) AS own, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
       FROM placed),
     sums AS (
       SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
              count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
              count(*) FILTER (before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last
       FROM faults GROUP BY conv_id),
     ways AS (
       SELECT conv_id, 0 AS i, lpad('', 12, '0') AS n, CAST(NULL AS VARCHAR) AS s, lpad('5', 12, '0') || 'I' AS u, lpad('10', 12, '0') || 'II' AS a
       FROM (SELECT DISTINCT conv_id FROM faults)
       UNION ALL
       SELECT conv_id, i, {_N}, {_S}, {_U}, {_A}
       FROM (SELECT y.conv_id, x.i, {_STEP["n"]} AS n, {_STEP["s"]} AS s, {_STEP["u"]} AS u, {_STEP["a"]} AS a
             FROM ways y JOIN faults x ON x.conv_id IS NOT DISTINCT FROM y.conv_id AND x.i = y.i + 1)),
     best AS (
       SELECT conv_id, CAST(left(w, 12) AS BIGINT) AS cost, substr(w, 13) AS audit
       FROM (SELECT sums.conv_id, least(n, a) AS w FROM ways JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ways.conv_id AND i = last)),
     marks AS (
       SELECT conv_id, k, substr(audit, k, 1) AS m, length(replace(left(audit, k), 'I', '')) AS i, length(replace(left(audit, k), 'D', '')) AS p
       FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
     made AS (
       SELECT marks.*, x.role, x.text,
              max(CASE WHEN p = 1 AND m = 'K' AND starts_with(x.role, 's') THEN 1 ELSE 0 END) OVER (PARTITION BY marks.conv_id) AS system
       FROM marks LEFT JOIN faults x ON x.conv_id IS NOT DISTINCT FROM marks.conv_id AND x.i = marks.i AND m IN ('K', 'R') WHERE m <> 'D'),
     repaired AS (
       SELECT conv_id, string_agg(CASE WHEN m = 'K' THEN role WHEN (p + system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS t
       FROM made GROUP BY conv_id)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM every.conv_id
"""
