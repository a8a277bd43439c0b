"""DuckDB SQL with the rows of those operators' queries that SQL can express.

Languages, page texts, fingerprints, tokens, removed strings and packings need models, hashes
or tokenizers that SQL lacks; their queries are tested against brute force instead.
"""

from __future__ import annotations

from tidemart.llm import covers, decontaminate, quality, secrets, turns, urls, vantage

_WORD = r"[^\x20\x09-\x0D]+"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ROWS = "SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _failed(place: int) -> str:
    return f"CASE WHEN {quality.RULES[place][1]} THEN {1 << place} ELSE 0 END"


_QUALITY = f"""
WITH d AS ({_ROWS}),
w AS (
  SELECT r, doc_id, regexp_extract_all(t, '{_WORD}') AS ws,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '!')) AS n_bangs
  FROM d
),
g AS (SELECT r, i, ws[i:i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines, n_bangs
  FROM w LEFT JOIN covered USING (r)
),
f AS (SELECT *, {" + ".join(map(_failed, range(len(quality.RULES))))} AS failed FROM m)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & {quality.BASE.mask}) <> 0 AS base_failed,
  (failed & {quality.BASE.mask | quality.V1.mask}) = 0 AS kept, failed
FROM f
"""

_ok = {"assign": "length(v) >= 6", "access": "length(m) >= 20", "ident": "length(v) >= 3",
       "opaque": "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')"}


def _matches(place: int) -> str:
    kind, pattern, _ = secrets.KINDS[place]
    p = _quoted(pattern)
    values = f"regexp_extract_all(t, {p}, 2)" if kind in ("assign", "ident") else "[]::VARCHAR[]"
    return (
        f"SELECT r, {place} AS place, '{kind}' AS kind, e - length(m) AS s, e FROM ("
        f"SELECT r, m, v, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY k) AS e FROM ("
        f"SELECT r, unnest(ms) AS m, unnest(list_resize(vs, len(ms))) AS v, unnest(gs[1:len(ms)]) AS g, "
        f"generate_subscripts(ms, 1) AS k FROM (SELECT r, regexp_extract_all(t, {p}) AS ms, {values} AS vs, "
        f"regexp_split_to_array(t, {p}) AS gs FROM d))) WHERE {_ok.get(kind, 'true')}"
    )


def _role(role: str) -> str:
    listed = ", ".join(f"'{k}'" for k, r in secrets.ROLES.items() if r == role)
    return (f"EXISTS (SELECT 1 FROM a AS o WHERE o.r = a.r AND o.kind IN ({listed}) "
            f"AND abs(o.s - a.s) <= {secrets.REACH})")


_strong = ", ".join(f"'{k}'" for k in secrets.STRONG)
_needs = " OR ".join(
    f"(kind = '{kind}' AND " + " AND ".join(_role(role) for role in roles) + ")"
    for kind, roles in secrets.NEEDS.items()
)
_SECRETS = f"""
WITH d AS ({_ROWS}),
p AS ({" UNION ALL ".join(map(_matches, range(len(secrets.KINDS))))}),
a AS (
  SELECT * FROM p WHERE kind IN ({_strong}) OR NOT EXISTS (
    SELECT 1 FROM p AS o WHERE o.r = p.r AND o.kind IN ({_strong}) AND o.s < p.e AND o.e > p.s)
),
shown AS (SELECT r, place, kind, s, e FROM a WHERE kind IN ({_strong}) OR {_needs}),
x AS (
  SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (kind IN ({_strong})) AS base,
    {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.STRONG)}
  FROM shown GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.STRONG)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN x USING (r)
"""

_URLS = f"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages
),
q AS (
  SELECT r, page_id, translate(regexp_extract(u, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') AS host,
    regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM p
),
rules(action, h, p) AS (VALUES {", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in urls.RULES)}),
fit AS (
  SELECT r, h || p AS rule, action FROM q JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h) + length(p) DESC, h || p DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN list_has_any(string_split(host, '.'),
  [{", ".join(f"'{h}'" for h in urls.SPAM_HOSTS)}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN fit USING (r)
"""

_words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{decontaminate.WORD}')"
_WINNOWING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words} AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (
    SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
    FROM b WHERE len(ws) > 0)
),
dw AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM (
    SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))
),
hits AS (SELECT dw.r, dw.n, dw.i, dw.w FROM dw SEMI JOIN bw ON dw.n = bw.n AND dw.w = bw.w),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (
    SELECT DISTINCT r, item_id FROM (SELECT DISTINCT r, n, w FROM hits) JOIN bw USING (n, w) WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

def _nearest(step: int) -> str:
    """Each vector's nearest centroid, and where the means of the vectors move the centroids."""
    old, apart = f"c{step}", "list_sum(list_transform(range(1, len(k.v) + 1), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
    return f"""
a{step} AS (
  SELECT r, c, d FROM (SELECT k.r, c.c, CAST({apart} AS HUGEINT) AS d FROM k, {old} AS c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
),
m{step} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (
      SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{step} JOIN k USING (r)) GROUP BY c, i)
  GROUP BY c
),
c{step + 1} AS (SELECT {old}.c, coalesce(m{step}.v, {old}.v) AS v FROM {old} LEFT JOIN m{step} USING (c))"""


_last = vantage.ROUNDS
_CENTROIDS = f"""
WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, embedding,
    list_transform(embedding, lambda x: CAST(floor({vantage.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {vantage.SIZE}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {vantage.SIZE}
),
c0 AS (
  SELECT n - 1 AS c, v FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{vantage.SEED}:' || vec_id), embedding) AS n
    FROM k WHERE vec_id IS NOT NULL) WHERE n <= {vantage.K}
),
{",".join(map(_nearest, range(_last + 1)))},
s AS (SELECT c, sum(d) AS own FROM a{_last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(own AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(own) FROM s) AS BIGINT) AS inertia, sha256(array_to_string(c{_last}.v, ',')) AS centroid_sha256
FROM a{_last} JOIN k USING (r) JOIN s USING (c) JOIN c{_last} USING (c)
"""


def _crc_table() -> list[int]:
    found = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        found.append(value)
    return found


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    step = f"lambda a, b: xor(a >> 8, CAST({_crc_table()} AS BIGINT[])[xor(a & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


def _done(cost: str, letter: str, line: str | None, behind: str) -> str:
    """What is left to pay, to do and to say, as a struct, with one edit ahead of ``behind``."""
    lines = f"{behind}.t" if line is None else f"list_prepend({line}, {behind}.t)"
    return f"{{'c': {cost} + {behind}.c, 'a': '{letter}' || {behind}.a, 't': {lines}}}"


def _row_options(state: int) -> str:
    free = "fault NOT IN ('blank', 'duplicate')"
    extra = f"CASE WHEN fault = 'truncated' THEN {turns.TRUNCATED} ELSE 0 END"
    own = [_done(str(turns.DELETE), "D", None, f"g{state}")]
    for role, to in turns._LEGAL[state].items():
        own.append(f"CASE WHEN {free} AND init = '{role}' THEN {_done(extra, 'K', "role || ':' || text", f'g{to}')} END")
    given = "assistant" if state == 2 else "user"
    reroled = _done(f"{turns.REROLE} + {extra}", "R", f"'{given}:' || text", f"g{turns._TURN[state]}")
    own.append(f"CASE WHEN {free} THEN {reroled} END")
    return f"list_min([{', '.join(own)}]) AS b{state}"


def _with_insertion(state: int, behind: str) -> str:
    given = "assistant" if state == 2 else "user"
    return f"list_min([b{state}, {_done(str(turns.INSERT), 'I', f"'{given}:'", behind)}])"


_TURNS = f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS draw
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE draw WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM src
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    coalesce(CAST(conv_id AS VARCHAR), '') AS k, left(role, 1) AS init FROM damaged
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_WORD}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '{_ENDED}') THEN 'truncated' ELSE '' END AS fault,
    lag(init) OVER (PARTITION BY k ORDER BY i) || init NOT IN ('su', 'ua', 'au') AS illegal FROM placed
),
counted AS (
  SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulty GROUP BY k
),
g AS (
  SELECT k, n + 1 AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS g0, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}} AS g1,
    {{'c': 3, 'a': 'I', 't': ['assistant:']}} AS g2, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS g3 FROM counted
  UNION ALL
  SELECT k, i, {_with_insertion(0, "h2")}, {_with_insertion(1, "h2")}, h2, h3 FROM (
    SELECT k, i, b0, b1, {_with_insertion(2, "b3")} AS h2, {_with_insertion(3, "b2")} AS h3 FROM (
      SELECT k, f.i, {", ".join(map(_row_options, range(turns.STATES)))} FROM g JOIN faulty AS f USING (k) WHERE f.i = g.i - 1))
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(g0.c, 0) AS BIGINT) AS cost,
  coalesce(g0.a, '') AS audit, sha256(coalesce(array_to_string(g0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS k FROM conversations) AS o
LEFT JOIN counted USING (k) LEFT JOIN (SELECT k, g0 FROM g WHERE i = 1) AS e USING (k)
"""

_PASSAGES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {covers._NO_ID}) AS id,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
),
w AS (
  SELECT r, id, i, array_to_string(ws[i:i + {covers.SIZE - 1}], ' ') AS g
  FROM (SELECT r, id, ws, unnest(range(1, len(ws) - {covers.SIZE - 2})) AS i FROM d)
),
hits AS (SELECT r, i FROM w QUALIFY min(id) OVER (PARTITION BY g) < id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {covers.SIZE})) AS p FROM hits),
left_over AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS kept FROM (
    SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM d) ANTI JOIN gone USING (r, p)
  GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r)
"""

SQL: dict[str, str] = {
    "op2_quality_ledger": _QUALITY, "op3_secret_links": _SECRETS, "op7_url_cascade": _URLS,
    "op10_benchmark_winnowing": _WINNOWING, "op11_vantage_centroids": _CENTROIDS, "op12_turn_repair": _TURNS,
    "op13_cover_passages": _PASSAGES,
}
