"""DuckDB SQL for the rows of the corpus queries that SQL can express."""

from __future__ import annotations

from kerbline.llm.spotsigs import ANCHORS

ORACLES: dict[str, str] = {}

ORACLES["op7_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '#' || text, '#')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM sources),
reached AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, max(reach) OVER () * weight) AS target FROM reached),
ended AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ended
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - (ended - size)))
          + greatest(0, least(size, floor(target) - source_size - (ended - size))) AS BIGINT) AS taken
FROM ended
"""

ORACLES["op8_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM words WHERE len(w) > 0)),
sizes AS (
  SELECT w.doc_id, count(s.shingle) AS n_shingles FROM words w LEFT JOIN shingles s USING (doc_id) GROUP BY w.doc_id),
common_counts AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common_counts JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 75 * (p.n_shingles + q.n_shingles - shared)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT doc_id, CAST(any_value(n_shingles) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM sizes JOIN reached USING (doc_id) GROUP BY doc_id
"""

_FINGERPRINT = r"""(
  SELECT array_to_string(list_sort(list_distinct(list_filter(list_transform(u, lambda x, i:
    CASE WHEN contains(x, ' ') THEN split_part(x, ' ', -2) WHEN i <= 8 THEN '^' END || ' ' ||
    split_part(x, ' ', -1) || ' ' || coalesce(split_part(u[i + 1], ' ', -1), '') || ' ' || coalesce(split_part(u[i + 2], ' ', -1), '')),
    lambda x: x IS NOT NULL).list_transform(lambda x: md5(x)[:8]))), ' ')
  FROM (SELECT string_split(array_to_string(list_transform(
    list_filter(string_split_regex(lower(TEXT), '[^\p{L}\p{N}]+'), lambda w: w <> ''),
    lambda w: w || CASE WHEN list_contains(ANCHORS, w) THEN ' ' ELSE chr(10) END), ''), chr(10))[:-2] AS u))"""


def _fingerprint(text: str) -> str:
    anchors = "[" + ", ".join(f"'{w}'" for w in ANCHORS) + "]"
    return _FINGERPRINT.replace("TEXT", text).replace("ANCHORS", anchors)




def _likeness(a: str, b: str) -> str:
    return f"""CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE
  len(list_intersect(string_split({a}, ' '), string_split({b}, ' ')))::DOUBLE
  / len(list_distinct(string_split({a}, ' ') || string_split({b}, ' '))) END"""


ORACLES["op1_spot_signatures"] = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
followed AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST, text),
                     first(text) OVER (ORDER BY doc_id NULLS FIRST, text)) AS following
  FROM texts),
edits AS (
  SELECT doc_id, text, length(text) AS n_chars, following,
         substr(text, 1, length(text) - length(text) // 4) || substr(following, 1, length(text) // 4) AS edited
  FROM followed),
marked AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_fingerprint("text")} AS fingerprint,
         {_fingerprint("edited")} AS edited_fingerprint, {_fingerprint("following")} AS next_fingerprint
  FROM edits)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_likeness("fingerprint", "edited_fingerprint")} AS near_edited,
       {_likeness("fingerprint", "next_fingerprint")} AS near_next
FROM marked
"""

ORACLES["op5_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, k, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(k, r)),
guarded AS (
  SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS role_out, replace(replace(text, '\', '\\'), '<|', '<\|') AS text_out
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(role_out, chr(10), '\n')) + length(text_out)) AS BIGINT) AS formatted_chars
FROM guarded GROUP BY conv_id
"""

ORACLES["op2_capture_index"] = r"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex,
         max(page_id) OVER (PARTITION BY payload) AS original
  FROM payloads)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM digests
"""


def _path(path: str, cost: str, edits: str) -> str:
    """A path is its cost in nine digits and its edits, so the least text is the cheapest path, ties ASCII-least."""
    return f"lpad(CAST(CAST(left({path}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({path}, 10) || {edits}"


def _asked(path: str, letter: str, inserts: bool) -> str:
    """Keep or rerole a row where ``letter`` is due, behind an inserted row or not."""
    keeps = f"(own = '{letter}')"
    edits = f"'{'I' if inserts else ''}' || CASE WHEN {keeps} THEN 'K' ELSE 'R' END"
    return _path(path, f"{5 if inserts else 0} + 5 * CAST(cut AS INT) + 1 - CAST({keeps} AS INT)", f"({edits})")


def _stepped(state: int, ways: list[str]) -> str:
    deleted = _path(f"s{state}", "2", "'D'")
    return f"CASE WHEN gone THEN {deleted} ELSE least({', '.join([deleted, *ways])}) END"


# Paths by the last row: s0 none, s1 system, s2 user, s3 assistant.
_STEPS = ", ".join(
    [
        _stepped(0, []),
        _stepped(1, [f"CASE WHEN own = 's' THEN {_path('s0', '5 * CAST(cut AS INT)', chr(39) + 'K' + chr(39))} END"]),
        _stepped(2, [*(_asked(f"s{k}", "u", False) for k in (0, 1, 3)), _asked("s2", "u", True)]),
        _stepped(3, [_asked("s2", "a", False), *(_asked(f"s{k}", "a", True) for k in (0, 1, 3))]),
    ]
)

ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc),
told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
drawn AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295, list_reduce(list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)),
           lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) % 20 AS fault
  FROM told, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
  FROM drawn),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS own,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
marked AS (
  SELECT conv_id, turn, role, text, own, i, bare = '' AS blank, bare <> '' AND again AS duplicate,
         bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, bare = '' OR again AS gone,
         i > 1 AND lag(own) OVER (PARTITION BY conv_id ORDER BY i) || own NOT IN ('su', 'ua', 'au') AS illegal
  FROM seen),
names AS (SELECT DISTINCT conv_id FROM conversations),
paths(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM names
  UNION ALL
  SELECT p.conv_id, m.i, {_STEPS}
  FROM paths p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1),
ended AS (
  SELECT conv_id, least(s0, s3, {_path("s2", "5", "'I'")}, {_path("s1", "10", "'II'")}) AS path
  FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
letters AS (
  SELECT conv_id, k, path[k + 9] AS edit
  FROM (SELECT conv_id, path, unnest(range(1, length(path) - 8)) AS k FROM ended)),
edits AS (
  SELECT conv_id, k, edit, count(*) FILTER (edit <> 'I') OVER before AS i, count(*) FILTER (edit <> 'D') OVER before AS place
  FROM letters WINDOW before AS (PARTITION BY conv_id ORDER BY k)),
remaining AS (
  SELECT e.conv_id, place, edit, m.role, CASE edit WHEN 'I' THEN '' ELSE m.text END AS text,
         max(CASE WHEN place = 1 AND edit = 'K' AND own = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i
  WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY place) AS told
  FROM remaining GROUP BY conv_id),
counted AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM marked GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(path, 9) AS BIGINT) AS cost,
       substr(path, 10) AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
             LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

# The sets of op8 at another bound, and which documents stay.
ORACLES["op13_bbit_minhash"] = f"""
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM ({ORACLES["op8_ngram_join"].replace("100 * shared >= 75 *", "100 * shared >= 85 *")})
"""
