"""SQL for the query catalogue, over the same tables, for engines without look-around in patterns."""

from __future__ import annotations

import re

from jobloom.functions import policy as P
from jobloom.plans.fixtures import RAW_SQL
from jobloom.sources import messages as M

_WORD = r"[\pL\pN_]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bounded(pattern: str) -> str:
    """Look-around at the ends as groups, word classes by letters; for tests, not replacements."""
    pattern = re.sub(r"\(\?<!\[([^\]]*)\]\)", r"(?:^|[^\1])", pattern)
    pattern = re.sub(r"\(\?!\[([^\]]*)\]\)", r"(?:$|[^\1])", pattern)
    if pattern.startswith(r"\b(?:") and pattern.endswith(r")\b") and r"\b" not in pattern[2:-2]:
        pattern = rf"(?:^|[^\pL\pN_]){pattern[2:-2]}(?:$|[^\pL\pN_])"
    return pattern.replace(r"україн\w*|украин\w*", rf"україн{_WORD}*|украин{_WORD}*")


def has(c: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({c}, {q(bounded(pattern))}, 'i'), false)"


def sub(c: str, pattern: str, by: str) -> str:
    """Replace, keeping the neighbours that stand in for look-around; twice, for words side by side."""
    pattern = re.sub(r"\(\?<!\[([^\]]*)\]\)", r"(^|[^\1])", pattern)
    pattern = re.sub(r"\(\?!\[([^\]]*)\]\)", r"($|[^\1])", pattern)
    if pattern.startswith(r"\b(?:") and pattern.endswith(r")\b"):
        pattern = rf"(^|[^\pL\pN_]){pattern[2:-2]}($|[^\pL\pN_])"
    once = f"regexp_replace({c}, {q(pattern)}, {q(chr(92) + '1' + by + chr(92) + '2')}, 'gi')"
    return f"regexp_replace({once}, {q(pattern)}, {q(chr(92) + '1' + by + chr(92) + '2')}, 'gi')"


def strip(c: str) -> str:
    return rf"regexp_replace(coalesce({c}, ''), '^\s+|\s+$', '', 'g')"


def token(c: str) -> str:
    return rf"regexp_replace(lower({strip(c)}), '\s+', ' ', 'g')"


def title_norm(c: str) -> str:
    return rf"lower(regexp_replace(regexp_replace({strip(c)}, '\s*\(#\d+\)\s*$', ''), '\s+', ' ', 'g'))"


def company(c: str) -> str:
    alias = lambda x: "CASE " + x + " " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.COMPANY_ALIASES.items()) + " END"
    return f"coalesce({alias(token(c))}, {alias(f'replace({token(c)}, {q(chr(45))}, {q(chr(32))})')}, {token(c)})"


def family(c: str) -> str:
    base = f"regexp_replace({title_norm(c)}, {q(P.TITLE_QUALIFIER)}, ' ', 'g')"
    short = sub(sub(base, P.TITLE_SENIORITY, " "), P.TITLE_DEVELOPER, "engineer")
    short = strip(rf"regexp_replace({short}, '[\s,/|–-]+', ' ', 'g')")
    return f"CASE WHEN {has(base, P.PLATFORM_ANCHOR)} THEN {short} ELSE {title_norm(c)} END"


def canonical(u: str) -> str:
    """For http(s) links whose query needs no decoding."""
    u = strip(u)
    parts = f"string_split(regexp_extract({u}, '^[^?#]*[?]([^#]*)', 1), '&')"
    keys = ", ".join(q(k) for k in P.TRACKING_QUERY_KEYS)
    key = "lower(string_split(x, '=')[1])"
    kept = f"list_sort(list_filter({parts}, lambda x: x <> '' AND NOT starts_with({key}, 'utm_') AND {key} NOT IN ({keys})))"
    path = f"regexp_extract({u}, '^[^:]*://[^/?#]*([^?#]*)', 1)"
    return f"lower(regexp_extract({u}, '^([^:]*://[^/?#:]*)', 1)) || CASE WHEN {path} IN ('', '/') THEN '/' ELSE regexp_replace({path}, '/+$', '') END || CASE WHEN len({kept}) = 0 THEN '' ELSE '?' || array_to_string({kept}, '&') END"


def platform(t: str, d: str | None = None) -> str:
    body = f" OR ({has(d, P.CORE_TERMS)} AND {has(t, P.BODY_ROLE)})" if d else ""
    return f"(NOT {has(t, P.EXCLUDED_ROLE)} AND ({has(t, P.PLATFORM_ANCHOR)}{body}))"


def adjacent(t: str) -> str:
    return f"CASE WHEN {has(t, P.EXCLUDED_ROLE)} THEN NULL WHEN {has(t, P.KMP_TITLE)} THEN 'kmp' WHEN {has(t, P.MOBILE_TITLE)} AND NOT {has(t, P.OTHER_MOBILE_PLATFORM)} THEN 'mobile' END"


def target(t: str, d: str) -> str:
    return f"({platform(t, d)} OR ({adjacent(t)}) IS NOT NULL)"


def primary(t: str) -> str:
    return f"({has(t, P.NATIVE_TITLE)} AND {platform(t)} AND NOT {has(t, P.CROSS_PLATFORM_TITLE)})"


def topic(t: str, d: str) -> str:
    return f"CASE WHEN {primary(t)} THEN 'native_ios' WHEN ({adjacent(t)}) = 'kmp' THEN 'kmp' WHEN NOT {platform(t, d)} THEN {adjacent(t)} WHEN {has(t, P.CROSS_PLATFORM_TITLE)} THEN 'cross_platform' WHEN {platform(t)} THEN 'apple_platform' ELSE 'ios_in_description' END"


def inbox(track: str, t: str) -> str:
    return f"({track} = 'ios' AND {primary(t)})"


def level(t: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(t, p)} THEN {q(n)}" for n, p in P.LEVELS) + f" WHEN {has(t, P.JUNIOR_TITLE)} THEN 'junior' ELSE 'unknown' END"


def target_level(t: str) -> str:
    return f"NOT ({has(t, P.JUNIOR_TITLE)} AND NOT {has(t, P.SENIORISH_TITLE)})"


def mode_ok(loc: str, rem: str) -> str:
    v, m = strip(loc), f"lower({strip(rem)})"
    return f"CASE WHEN {v} = '' THEN true WHEN {has(v, P.KYIV)} THEN true WHEN {m} IN ('onsite', 'on-site', 'office', 'hybrid') OR {has(v, P.OFFICE_LOCATION)} THEN false ELSE {m} = 'remote' OR {has(v, P.REMOTE_LOCATION)} END"


def location_ok(loc: str, rem: str) -> str:
    v = strip(loc)
    left = f"translate({sub(sub(v, P.REMOTE_LOCATION, ''), P.SCOPE_WORDS, '')}, {q(P.SCOPE_PUNCTUATION)}, '')"
    return f"(({mode_ok(loc, rem)}) AND ({v} = '' OR {has(v, P.KYIV)} OR {has(v, P.UKRAINE)} OR {left} = ''))"


def attention(loc: str, rem: str) -> str:
    return f"(({mode_ok(loc, rem)}) AND ({strip(loc)} = '' OR NOT {location_ok(loc, rem)}))"


def workable(loc: str, rem: str) -> str:
    return f"CASE WHEN {strip(loc)} = '' AND lower({strip(rem)}) <> 'remote' THEN NULL ELSE ({mode_ok(loc, rem)}) END"


def infer(t: str, loc: str, d: str) -> str:
    x = f"lower(coalesce({t}, '') || ' ' || coalesce({loc}, '') || ' ' || coalesce({d}, ''))"
    return f"CASE WHEN {has(x, P.NEGATED_REMOTE)} THEN 'onsite' WHEN {has(x, r'\bhybrid\b')} THEN 'hybrid' WHEN {has(x, r'\bon[- ]?site\b')} THEN 'onsite' WHEN {has(x, P.REMOTE_LOCATION)} THEN 'remote' WHEN {has(x, r'\boffice\b')} THEN 'onsite' ELSE 'unknown' END"


def language(x: str) -> str:
    n = lambda p, c=x: f"len(regexp_extract_all({c}, {q(p)}))"
    return rf"CASE WHEN {n(r'\pL')} = 0 THEN 'unknown' WHEN {n('[Ѐ-ӿ]')} < {n(r'\pL')} * 0.3 THEN 'en' WHEN {n('[іїєґ]', f'lower({x})')} >= {n('[ыэъё]', f'lower({x})')} THEN 'uk' ELSE 'ru' END"


def html_text(d: str) -> str:
    x = rf"regexp_replace(coalesce({d}, ''), '(?:</(?:p|li|div|h[1-4])\s*>|<br\s*/?>)', chr(10), 'gi')"
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


#: Distinct descriptions with their requirement lines and blockers, by an exploded and windowed form.
REQUIRED = rf"""
dd AS (SELECT DISTINCT coalesce(description, '') AS d FROM raw),
lines AS (SELECT d, i, {strip('x')} AS line FROM (SELECT d, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (SELECT d, regexp_split_to_array(regexp_replace({html_text('d')}, '([.!?])\s+', '\1' || chr(10), 'g'), '[\n;]') AS l FROM dd))),
kinds AS (SELECT *, CASE WHEN {has('line', P.OPTIONAL_SECTION)} THEN 'o' WHEN {has('line', P.NEUTRAL_SECTION)} THEN 'n' WHEN {has('line', P.REQUIRED_SECTION)} THEN 'r' END AS k FROM lines),
state AS (SELECT *, coalesce(last_value(k IGNORE NULLS) OVER w, 'n') AS s, coalesce(last_value(CASE WHEN k IN ('r', 'n') THEN k END IGNORE NULLS) OVER w, 'n') AS r FROM kinds WINDOW w AS (PARTITION BY d ORDER BY i ROWS UNBOUNDED PRECEDING)),
clauses AS (SELECT d, i, generate_subscripts(l, 1) AS j, unnest(l) AS c, r FROM (SELECT d, i, r, regexp_split_to_array(line, ',|\b[bB][uU][tT]\b') AS l FROM state WHERE s <> 'o')),
required AS (SELECT dd.d, coalesce(string_agg(CASE WHEN r = 'r' THEN 'required: ' ELSE '' END || {strip('c')}, chr(10) ORDER BY i, j) FILTER (WHERE NOT {has('c', P.OPTIONAL_CLAUSE)}), '') AS required FROM dd LEFT JOIN clauses ON dd.d = clauses.d GROUP BY dd.d),
sentences AS (SELECT d, generate_subscripts(l, 1) AS i, unnest(l) AS s FROM (SELECT d, regexp_split_to_array(regexp_replace(required, '([.!?])\s+', '\1' || chr(10), 'g'), '[\n;]') AS l FROM required)),
named AS (SELECT d, min(i) AS i, CASE WHEN {has('s', P.BLOCKERS[0][0])} THEN {q(P.BLOCKERS[0][1])} WHEN {has('s', P.BLOCKERS[1][0])} THEN {q(P.BLOCKERS[1][1])} ELSE {q(P.BLOCKERS[2][1])} END AS b
  FROM sentences WHERE {has('s', P.AUTHORIZATION_REQUIRED)} AND NOT {has('s', P.AUTHORIZATION_SUPPORT)} AND NOT {has('s', P.UKRAINE)} GROUP BY d, b),
blockers AS (SELECT dd.d, coalesce(string_agg(b, ' | ' ORDER BY i), '') AS blockers FROM dd LEFT JOIN named ON dd.d = named.d GROUP BY dd.d)"""

NORMAL = f"""
norm0 AS (
  SELECT seq, {strip('company')} AS company, {strip('title')} AS title, {strip('url')} AS url, source, CASE WHEN coalesce(location, '') = '' THEN NULL ELSE {strip('location')} END AS location,
    CASE WHEN lower({strip('remote')}) NOT IN ('', 'unknown') THEN remote ELSE {infer('title', f"CASE WHEN coalesce(location, '') = '' THEN NULL ELSE {strip('location')} END", f"nullif({strip('description')}, '')")} END AS remote,
    published_at, nullif({strip('description')}, '') AS description, source_job_id, track, russian_company
  FROM raw WHERE track <> 'ios' OR {target('title', f"nullif({strip('description')}, '')")}),
norm1 AS (SELECT *, {canonical('url')} AS canonical_url, {company('company')} AS cc FROM norm0),
norm AS (SELECT *, sha256(CASE WHEN coalesce(source_job_id, '') <> '' THEN 'provider|' || cc || '|' || {token('source')} || '|' || source_job_id ELSE 'url|' || cc || '|' || canonical_url END) AS identity_key,
  CASE WHEN coalesce(source_job_id, '') <> '' THEN 'source_job_id' ELSE 'canonical_url' END AS strategy FROM norm1)"""

BASE = f"WITH {RAW_SQL},{NORMAL}"

DEDUP = f"""
ranked AS (SELECT *, {inbox('track', 'title')} AS r1, coalesce(location, '') <> '' AND {location_ok('location', 'remote')} AS r2,
  coalesce(length(description), 0) + CASE WHEN coalesce(location, '') <> '' THEN 10 ELSE 0 END + CASE WHEN published_at IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN contains(url, '?') THEN 0 ELSE 1 END AS r3,
  nullif({strip('location')}, '') AS place FROM base_rows),
one AS (SELECT *, row_number() OVER (PARTITION BY identity_key ORDER BY r1 DESC, r2 DESC, r3 DESC, canonical_url, seq) AS rn, min(seq) OVER k AS pos, count(*) OVER k AS n, list(place) OVER k AS places, bool_or(russian_company) OVER k AS flag FROM ranked WINDOW k AS (PARTITION BY identity_key)),
ids AS (SELECT *, CASE WHEN {strip('company')} = '' THEN 'id|' || identity_key ELSE 'role|' || cc || '|' || {title_norm('title')} END AS grp FROM one WHERE rn = 1),
two AS (SELECT * REPLACE (row_number() OVER (PARTITION BY grp ORDER BY r1 DESC, r2 DESC, r3 DESC, canonical_url, pos) AS rn), max(pos) OVER g AS out_pos, sum(n) OVER g AS merged, flatten(list(places) OVER g) AS all_places, bool_or(flag) OVER g AS any_flag FROM ids WINDOW g AS (PARTITION BY grp)),
roles AS (SELECT * REPLACE (any_flag AS russian_company) FROM two WHERE rn = 1)"""

SEEN = """
seen AS (SELECT canonical_url AS key, arg_min(title, seq) AS title, arg_min(company, seq) AS company, '2024-01-01' AS first_seen FROM norm WHERE seq % 3 = 0 GROUP BY canonical_url),
fresh AS (SELECT *, canonical_url AS key FROM norm WHERE seq % 3 <> 0 AND canonical_url NOT IN (SELECT key FROM seen) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY seq) = 1)"""

RUNS = """
days AS (SELECT user_id AS u, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE value > 60) AS items_scanned FROM events GROUP BY ALL),
runs AS (SELECT CASE WHEN u % 5 = 0 THEN 'telegram:ch' || u ELSE 'company:c' || u || '@host' END AS source_id, CASE WHEN u % 5 = 0 THEN 'Telegram @ch' || u ELSE 'C' || u END AS source_name,
  CASE WHEN u % 17 = 3 THEN 'failed' WHEN u % 19 = 4 THEN 'degraded' ELSE 'healthy' END AS status, CASE WHEN u % 34 = 3 THEN '403 Client Error: Forbidden' WHEN u % 17 = 3 THEN 'timeout' WHEN u % 25 = 0 THEN 'session not set' END AS error,
  u % 23 = 1 AS empty_is_healthy, items_scanned, u * 10 + day(day) AS checkpoint, day, u FROM days),
baseline AS (SELECT source_id, max(source_name) AS name, CASE WHEN max(u) % 7 = 0 THEN 'ios+ai' ELSE 'ios' END AS search_policy, max(items_scanned) * 4 AS best_scanned, arg_max(items_scanned, day) AS last_scanned, '2024-01-14' AS last_success_at, max(u) % 4 AS empty_runs, '2024-01-10' AS last_nonzero FROM runs WHERE day < DATE '2024-01-15' GROUP BY source_id),
today AS (SELECT * FROM runs WHERE day = DATE '2024-01-15'),
joined AS (SELECT t.*, CASE WHEN b.search_policy = 'ios' THEN b.best_scanned ELSE 0 END AS best, coalesce(b.empty_runs, 0) AS empty FROM today t LEFT JOIN baseline b USING (source_id))"""

SUPPLIERS = "companies AS (SELECT 's' || s_suppkey AS slug, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'https://own/' || s_suppkey END AS career_url, s_nationkey AS nation FROM supplier), cust AS (SELECT c_custkey AS k, 's' || c_custkey AS slug, c_name AS name, 'https://c/' || c_custkey AS career_url, c_nationkey AS nation FROM customer)"

KYIV = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Kyiv')"
CLOCK = f"clock AS (SELECT event_id, {KYIV} AS s, hour({KYIV}) * 60 + minute({KYIV}) AS m FROM events)"
_LABELS = f"track, coalesce({topic('title', 'description')}, 'off_topic') AS topic, NOT ({target_level('title')}) AS junior, {level('title')} AS level, coalesce(nullif(lower({strip('remote')}), ''), 'unknown') AS work_mode, {workable('location', 'remote')} AS workable, {attention('location', 'remote')} AS location_needs_check"
_WITH_BLOCKERS = f"WITH {RAW_SQL},{NORMAL},{REQUIRED}, lab AS (SELECT norm.*, blockers FROM norm JOIN blockers ON coalesce(norm.description, '') = {strip('blockers.d')})"


def _nodup(rows: str) -> str:
    return f"{BASE}, base_rows AS ({rows}),{DEDUP}"


_GONE = "NOT coalesce(error ILIKE '%not set%', false)"
_CHANNEL = "(source_id LIKE 'telegram:%' OR source_name LIKE 'Telegram @%')"
_OUTCOME = f"CASE WHEN {_CHANNEL} THEN CASE WHEN status = 'failed' THEN 'channel_failed' WHEN error ILIKE '%not set%' THEN 'channel_skipped' WHEN status = 'degraded' THEN 'channel_degraded' ELSE 'channel_ok' END ELSE CASE WHEN status = 'failed' AND regexp_matches(error, '\\bHTTP 403\\b|\\b403 Client Error\\b|anti-bot challenge', 'i') THEN 'site_manual' WHEN status = 'failed' THEN 'site_failed' WHEN status = 'degraded' THEN 'site_degraded' ELSE 'site_ok' END END"
_names = lambda c, *o: f"coalesce(string_agg({c}, ' | ' ORDER BY source_id) FILTER (WHERE o IN ({', '.join(map(q, o))})), '')"

_MARKED = f"""(CASE WHEN russian_company THEN {q(P.MARK_FLAG + ' ')} ELSE '' END || CASE WHEN blockers <> '' THEN {q(P.MARK_PERMIT + ' ')} ELSE '' END || CASE WHEN NOT ({mode_ok('location', 'remote')}) THEN {q(P.MARK_OFFICE + ' ')} ELSE '' END
  || CASE WHEN {attention('location', 'remote')} THEN {q(P.MARK_CHECK + ' ')} ELSE '' END || CASE WHEN NOT ({target_level('title')}) THEN {q(P.MARK_JUNIOR + ' ')} ELSE '' END || {strip('title')})"""
_DESC = f"{strip('description')}"

def _list(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


from jobloom.plans.catalogue import LINK_HOSTS, LINK_LABELS, LINK_PATHS  # noqa: E402

#: The catalogue after its stored rows, the first reading and the second, one step after the other.
CATALOG = """s0 AS (SELECT lower(trim(' S' || s_suppkey)) AS slug, CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE 's' || s_suppkey END AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'https://own/' || s_suppkey END AS site_url, CASE WHEN s_suppkey % 4 = 0 THEN 'https://v/' || s_suppkey ELSE 'https://jobs.dou.ua/companies/s' || s_suppkey || '/vacancies/' END AS vacancies_url, CASE WHEN s_suppkey % 6 <> 0 THEN s_nationkey END AS vacancy_count FROM supplier),
f1 AS (SELECT 's' || c_custkey AS slug, CASE WHEN c_custkey % 2 = 0 THEN 'Supplier#' || lpad(c_custkey::VARCHAR, 9, '0') WHEN c_custkey % 11 = 0 THEN 's' || c_custkey ELSE c_name END AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'https://c/' || c_custkey END AS site_url, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS n FROM customer),
s1 AS (
  SELECT coalesce(s.slug, f.slug) AS slug, coalesce(f.name, s.name) AS name, coalesce(s.site_url, f.site_url) AS site_url, coalesce(s.vacancies_url, 'https://jobs.dou.ua/companies/' || f.slug || '/vacancies/') AS vacancies_url, CASE WHEN s.slug IS NULL THEN coalesce(f.n, 0) ELSE coalesce(f.n, s.vacancy_count) END AS vacancy_count,
    (s.slug IS NULL)::INT AS added, coalesce((s.slug IS NOT NULL AND f.slug IS NOT NULL AND (f.name <> s.name OR (f.n IS NOT NULL AND f.n IS DISTINCT FROM s.vacancy_count) OR (f.site_url IS NOT NULL AND s.site_url IS NULL)))::INT, 0) AS updated, (f.slug IS NOT NULL)::INT AS fresh
  FROM s0 s FULL OUTER JOIN f1 f ON s.slug = f.slug),
f2 AS (SELECT 's' || c_custkey AS slug, c_name AS name, 'https://c/' || c_custkey || '/2' AS site_url, CASE WHEN c_nationkey % 5 <> 0 THEN 0 END AS n FROM customer WHERE c_custkey % 7 = 0),
s2 AS (
  SELECT s.slug, coalesce(f.name, s.name) AS name, coalesce(s.site_url, f.site_url) AS site_url, s.vacancies_url, coalesce(f.n, s.vacancy_count) AS vacancy_count, s.added, s.updated, s.fresh,
    coalesce((f.slug IS NOT NULL AND (f.name <> s.name OR (f.n IS NOT NULL AND f.n IS DISTINCT FROM s.vacancy_count) OR s.site_url IS NULL))::INT, 0) AS updated2, (f.slug IS NOT NULL)::INT AS fresh2
  FROM s1 s LEFT JOIN f2 f ON s.slug = f.slug),
done AS (SELECT slug, name, site_url, vacancies_url, vacancy_count, added, updated + updated2 AS updated, fresh + fresh2 - added - updated - updated2 AS unchanged FROM s2)"""

SQL = {
    "q_canonical_url": f"WITH {RAW_SQL} SELECT DISTINCT url, {canonical('url')} AS canonical_url FROM (SELECT url FROM pages UNION ALL SELECT url FROM raw)",
    "q_strip_tracking": "SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN len(k) = 0 THEN '' ELSE '?' || array_to_string(k, '&') END AS url FROM (SELECT page_id, url, list_filter(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')) AS k FROM pages)",
    "q_source_id": r"SELECT page_id, 'company:c' || (page_id % 9) || '@' || regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)), '^www\.', '') AS source_id FROM pages",
    "q_slug_title": f"SELECT page_id, {strip("regexp_replace(regexp_extract(regexp_replace(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), '[-_]', ' ', 'g')")} AS title FROM pages",
    "q_identity": f"WITH {RAW_SQL}, a AS (SELECT *, {canonical('url')} AS canonical_url, {company('company')} AS cc FROM raw) SELECT seq, canonical_url, sha256(CASE WHEN coalesce(source_job_id, '') <> '' THEN 'provider|' || cc || '|' || {token('source')} || '|' || source_job_id ELSE 'url|' || cc || '|' || canonical_url END) AS identity_key, CASE WHEN coalesce(source_job_id, '') <> '' THEN 'source_job_id' ELSE 'canonical_url' END AS identity_strategy FROM a",
    "q_content_hash": f"WITH {RAW_SQL} SELECT seq, sha256({company('company')} || '|' || {title_norm('title')} || '|' || {token('location')}) AS hash FROM raw",
    "q_company_alias": f"WITH {RAW_SQL} SELECT DISTINCT company, {company('company')} AS canonical FROM raw",
    "q_title_norm": f"WITH {RAW_SQL} SELECT DISTINCT title, {title_norm('title')} AS normal FROM raw",
    "q_role_family": f"WITH {RAW_SQL} SELECT seq, {company('company')} AS company, {family('title')} AS family FROM raw",
    "q_topic": f"WITH {RAW_SQL} SELECT seq, {topic('title', 'description')} AS topic FROM raw",
    "q_adjacent": f"WITH {RAW_SQL} SELECT seq, {adjacent('title')} AS adjacent FROM raw",
    "q_inbox": f"WITH {RAW_SQL} SELECT seq, {inbox('track', 'title')} AS inbox, track = 'ai' OR ({topic('title', 'description')}) IS NOT NULL AS handover, {target('title', 'description')} AS target FROM raw",
    "q_level": f"WITH {RAW_SQL} SELECT seq, {level('title')} AS level, {target_level('title')} AS target_level FROM raw",
    "q_location": f"WITH {RAW_SQL} SELECT seq, {mode_ok('location', 'remote')} AS mode_ok, {location_ok('location', 'remote')} AS location_ok, {attention('location', 'remote')} AS attention, {workable('location', 'remote')} AS workable FROM raw",
    "q_infer_remote": f"WITH {RAW_SQL} SELECT seq, {infer('title', 'location', 'description')} AS mode FROM raw",
    "q_language": f"WITH {RAW_SQL} SELECT seq AS id, {language("concat_ws(' ', location, description)")} AS language, 'posting' AS kind FROM raw UNION ALL SELECT doc_id, {language("coalesce(text, '')")}, 'document' FROM documents",
    "q_work_auth": f"WITH {RAW_SQL},{REQUIRED} SELECT seq, blockers FROM raw JOIN blockers ON coalesce(description, '') = d",
    "q_required_lines": f"WITH {RAW_SQL},{REQUIRED} SELECT seq, required FROM raw JOIN required ON coalesce(description, '') = d",
    "q_labels": f"{_WITH_BLOCKERS} SELECT seq, {_LABELS}, blockers AS work_authorization FROM lab",
    "q_digest_pack": f"{_WITH_BLOCKERS.replace('WITH', 'WITH RECURSIVE', 1)}, m AS (SELECT *, {_MARKED} AS marked FROM lab), n AS (SELECT strftime(published_at, '%Y-%m') AS digest, row_number() OVER (PARTITION BY strftime(published_at, '%Y-%m') ORDER BY seq) AS n, CASE WHEN company <> '' THEN company || ' — ' || marked ELSE marked END || chr(10) || '   ' || url AS line FROM m), t AS (SELECT digest, n, n || '. ' || line AS text, length(n || '. ' || line) + 1 AS size FROM n WHERE digest IS NOT NULL), walk AS (SELECT digest, n, 1 AS part, 160 + size AS used FROM t WHERE n = 1 UNION ALL SELECT t.digest, t.n, CASE WHEN w.used + t.size > {P.MESSAGE_LIMIT} THEN w.part + 1 ELSE w.part END, CASE WHEN w.used + t.size > {P.MESSAGE_LIMIT} THEN 160 + t.size ELSE w.used + t.size END FROM walk w JOIN t ON t.digest = w.digest AND t.n = w.n + 1), packed AS (SELECT w.digest, w.part, count(*) AS items, sha256(string_agg(t.text, chr(10) ORDER BY t.n)) AS digest_hash FROM walk w JOIN t ON t.digest = w.digest AND t.n = w.n GROUP BY 1, 2) SELECT digest, CAST(part AS BIGINT) AS part, CAST(max(part) OVER (PARTITION BY digest) AS BIGINT) AS parts, items, digest_hash FROM packed",
    "q_title_marks": f"{_WITH_BLOCKERS}, m AS (SELECT *, {_MARKED} AS marked FROM lab) SELECT seq, marked, CASE WHEN company <> '' THEN company || ' — ' || marked ELSE marked END AS label FROM m",
    "q_normalize": f"{BASE} SELECT seq, company, title, location, remote, description, source_job_id, track, identity_key FROM norm",
    "q_feed_entry": f"{BASE}, b AS (SELECT *, {strip(rf"regexp_replace({html_text('description')}, '[ \t]*\n\s*', chr(10), 'g')")} AS body FROM norm) SELECT canonical_url AS feed_key, title, CASE WHEN {strip('company')} <> '' THEN cc || ' | ' || {family('title')} END AS role_key, seq % 2 = 0 AS repeat_of_seen_role, coalesce({topic('title', 'description')}, 'off_topic') AS topic, {language("concat_ws(' ', title, body)")} AS language, substr(body, 1, 6000) AS description, length(body) > 6000 AS description_truncated FROM b",
    "q_dedup_roles": _nodup("SELECT * FROM norm") + " SELECT seq, canonical_url, title, russian_company, CASE WHEN merged > 1 THEN array_to_string(list_sort(list_distinct(list_filter(all_places, lambda x: x IS NOT NULL))), ' | ') ELSE '' END AS locations, out_pos, CAST(merged AS BIGINT) AS merged FROM roles",
    "q_dedup_identity": _nodup("SELECT * FROM norm") + " SELECT seq, identity_key, pos, n FROM ids",
    "q_dup_groups": f"{BASE} SELECT identity_key, count(*) AS count, arg_min(strategy, seq) AS strategy, string_agg(url, ' | ' ORDER BY seq) AS urls FROM norm GROUP BY identity_key HAVING count(*) > 1",
    "q_dup_roles": _nodup("SELECT * FROM norm") + f" SELECT cc AS company, {title_norm('title')} AS title, count(*) AS count FROM ids WHERE {strip('company')} <> '' GROUP BY ALL HAVING count(*) > 1",
    "q_strategy_counts": f"{BASE} SELECT strategy, count(*) AS groups FROM (SELECT identity_key, arg_min(strategy, seq) AS strategy FROM norm GROUP BY identity_key) GROUP BY strategy",
    "q_doc_exact_dups": "SELECT sha256(coalesce(text, '')) AS digest, min(doc_id) AS keeper, count(*) AS copies FROM documents GROUP BY 1",
    "q_fresh": f"{BASE},{SEEN} SELECT seq, key FROM fresh",
    "q_repeats": f"{BASE},{SEEN}, s2 AS (SELECT * FROM seen WHERE company <> 'Acme  Apps'), f2 AS (SELECT *, canonical_url AS key, {family('title')} AS fam FROM norm WHERE seq % 3 <> 0 AND canonical_url NOT IN (SELECT key FROM s2) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY seq) = 1), known AS (SELECT DISTINCT {company('company')} AS c, {family('title')} AS fam FROM s2 WHERE company <> '' AND title <> '') SELECT seq, company <> '' AND (k.c IS NOT NULL OR row_number() OVER (PARTITION BY cc, f2.fam, CASE WHEN company <> '' THEN '' ELSE CAST(seq AS VARCHAR) END ORDER BY seq) > 1) AS repeat FROM f2 LEFT JOIN known k ON k.c = cc AND k.fam = f2.fam",
    "q_new_roles": _nodup("SELECT * FROM norm WHERE seq % 3 <> 0") + f",{SEEN.split('fresh AS')[0].rstrip().rstrip(',')}, nf AS (SELECT * FROM roles WHERE canonical_url NOT IN (SELECT key FROM seen) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY out_pos) = 1) SELECT seq, canonical_url AS key, company, title, coalesce({topic('title', 'description')}, 'off_topic') AS topic, {level('title')} AS level, {workable('location', 'remote')} AS workable, {attention('location', 'remote')} AS location_needs_check FROM nf",
    "q_mark_seen": f"{BASE},{SEEN} SELECT key, title, company, first_seen FROM seen UNION ALL SELECT key, title, company, '2024-02-01' FROM fresh",
    "q_purge": f"{BASE},{SEEN} SELECT key, company FROM seen WHERE NOT (key NOT LIKE '%/3?%' AND NOT (key LIKE '%/1?%' OR key LIKE '%/2?%') AND {token('company')} IN ('softserve', 'eleks'))",
    "q_feed_append": f"{BASE}, f AS (SELECT * FROM norm WHERE seq % 3 = 0 QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY seq) = 1), n AS (SELECT * FROM norm QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY seq) = 1) SELECT canonical_url AS feed_key, title, '2024-01-01' AS first_seen, false AS repeat_of_seen_role FROM f UNION ALL SELECT canonical_url, title, '2024-02-01', true FROM n WHERE canonical_url NOT IN (SELECT canonical_url FROM f)",
    "q_hand_over": _nodup("SELECT * FROM norm WHERE seq % 3 <> 0") + f",{SEEN.split('fresh AS')[0].rstrip().rstrip(',')}, nf AS (SELECT *, {family('title')} AS fam FROM roles WHERE canonical_url NOT IN (SELECT key FROM seen) AND (track = 'ai' OR ({topic('title', 'description')}) IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY out_pos) = 1), known AS (SELECT DISTINCT {company('company')} AS c, {family('title')} AS fam FROM seen WHERE company <> '' AND title <> ''), o AS (SELECT nf.*, company <> '' AND (known.c IS NOT NULL OR row_number() OVER (PARTITION BY cc, nf.fam, CASE WHEN company <> '' THEN '' ELSE CAST(seq AS VARCHAR) END ORDER BY out_pos) > 1) AS repeat FROM nf LEFT JOIN known ON known.c = cc AND known.fam = nf.fam) SELECT seq, repeat, NOT repeat AND {inbox('track', 'title')} AS in_digest FROM o",
    "q_collect": f"WITH {RUNS}, {RAW_SQL.replace('raw AS (', 'raw0 AS (', 1)}, raw AS (SELECT * FROM raw0 WHERE 'company:c' || (seq % 150) || '@host' IN (SELECT source_id FROM today WHERE status <> 'failed')),{NORMAL}, base_rows AS (SELECT * FROM norm),{DEDUP} SELECT reason, count(*) AS n FROM (SELECT 'outside_primary_ios' AS reason FROM roles WHERE NOT {primary('title')} UNION ALL SELECT 'off_topic' FROM roles WHERE ({topic('title', 'description')}) IS NULL) GROUP BY reason",
    "q_evaluate": f"{BASE}, x AS (SELECT coalesce({inbox('norm.track', 'norm.title')}, false) AS p, raw.seq % 2 = 0 AS e FROM raw LEFT JOIN norm ON norm.seq = raw.seq), n AS (SELECT count(*) FILTER (WHERE p AND e) AS tp, count(*) FILTER (WHERE p AND NOT e) AS fp, count(*) FILTER (WHERE NOT p AND e) AS fn, count(*) FILTER (WHERE NOT p AND NOT e) AS tn FROM x) SELECT *, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall FROM n",
    "q_export_feed": "SELECT CAST(o_orderkey AS VARCHAR) AS feed_key, '{\"title\":\"' || o_orderpriority || '\",\"first_seen\":\"' || strftime(o_orderdate, '%Y-%m-%d') || '\"}' AS entry FROM orders",
    "q_feed_prune": "SELECT CAST(event_id AS VARCHAR) AS feed_key, CASE WHEN event_id % 50 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS first_seen FROM events WHERE event_id % 50 = 0 OR date_trunc('second', ts) >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY",
    "q_cursors": "WITH a AS (SELECT conv_id % 50 AS channel, max(turn) AS cursor FROM conversations GROUP BY 1), b AS (SELECT user_id % 60 AS channel, max(event_id) % 7 AS cursor FROM events GROUP BY 1) SELECT channel, max(cursor) AS cursor FROM (SELECT * FROM a WHERE channel % 9 <> 0 UNION ALL SELECT * FROM b) WHERE cursor > 0 GROUP BY channel",
    "q_checkpoint": "SELECT user_id AS channel, greatest(max(event_id), CASE WHEN user_id % 2 = 0 THEN user_id * 60 ELSE 0 END) AS checkpoint, count(*) AS scanned FROM events GROUP BY user_id",
    "q_message_batch": "SELECT user_id AS channel, event_id AS message_id FROM events WHERE user_id % 2 <> 0 OR event_id > user_id * 60 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN user_id % 2 <> 0 THEN -event_id ELSE event_id END) <= CASE WHEN user_id % 2 <> 0 THEN 100 ELSE 3000 END",
    "q_degraded": f"WITH {RUNS}, w AS (SELECT *, CASE WHEN status = 'healthy' AND NOT empty_is_healthy THEN CASE WHEN items_scanned = 0 AND best > 0 THEN 'parsed 0 items but previously parsed items' WHEN items_scanned = 0 AND empty >= 2 THEN 'parsed 0 items for ' || (empty + 1) || ' runs' WHEN best >= 8 AND items_scanned < best * 0.4 THEN 'parsed ' || items_scanned || ' items but previously parsed ' || best END END AS why FROM joined) SELECT source_id, CASE WHEN why IS NOT NULL THEN 'degraded' ELSE status END AS status, CASE WHEN why IS NOT NULL THEN coalesce(error, why) ELSE error END AS error FROM w",
    "q_baseline": f"WITH {RUNS}, n AS (SELECT * FROM today WHERE status <> 'failed') SELECT coalesce(b.source_id, n.source_id) AS source_id, coalesce(n.source_name, b.name) AS name, CASE WHEN n.source_id IS NOT NULL THEN 'ios' ELSE b.search_policy END AS search_policy, CASE WHEN n.source_id IS NOT NULL THEN greatest(CASE WHEN b.search_policy = 'ios' THEN b.best_scanned ELSE 0 END, n.items_scanned) ELSE b.best_scanned END AS best_scanned, coalesce(n.items_scanned, b.last_scanned) AS last_scanned, CASE WHEN n.source_id IS NOT NULL THEN '2024-01-15' ELSE b.last_success_at END AS last_success_at, CASE WHEN n.source_id IS NULL THEN b.empty_runs WHEN n.items_scanned = 0 THEN coalesce(b.empty_runs, 0) + 1 ELSE 0 END AS empty_runs, CASE WHEN n.items_scanned > 0 THEN '2024-01-15' ELSE b.last_nonzero END AS last_nonzero FROM baseline b FULL OUTER JOIN n USING (source_id)",
    "q_empty_runs": f"WITH {RUNS}, b AS (SELECT source_id, day, items_scanned, sum(CASE WHEN items_scanned > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY day) AS blk FROM runs) SELECT source_id, day, items_scanned, CAST(sum(CASE WHEN items_scanned > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY source_id, blk ORDER BY day) AS BIGINT) AS empty_runs FROM b",
    "q_high_water": f"WITH {RUNS} SELECT source_id, day, items_scanned, max(items_scanned) OVER (PARTITION BY source_id ORDER BY day) AS best_scanned FROM runs",
    "q_source_summary": f"WITH {RUNS}, x AS (SELECT *, {_OUTCOME} AS o, {_CHANNEL} AS ch, CASE WHEN source_id LIKE 'telegram:%' THEN substr(source_id, 10) ELSE source_name END AS label FROM today) SELECT count(*) FILTER (WHERE o = 'site_ok') AS sites_ok, count(*) FILTER (WHERE NOT ch) AS sites_total, count(*) FILTER (WHERE o = 'channel_ok') AS channels_ok, count(*) FILTER (WHERE ch) AS channels_total, count(*) FILTER (WHERE o = 'channel_skipped') AS channels_skipped, {_names('source_name', 'site_failed', 'channel_failed')} AS failed_names, {_names('source_name', 'site_degraded', 'channel_degraded')} AS degraded_names, {_names('label', 'channel_skipped')} AS skipped_names, {_names('source_name', 'site_manual')} AS manual_names FROM x",
    "q_cursor_updates": f"WITH {RUNS} SELECT substr(source_id, 10) AS channel, checkpoint AS cursor FROM today WHERE {_CHANNEL} AND status = 'healthy' AND {_GONE}",
    "q_outage": f"WITH {RUNS} SELECT NOT coalesce(bool_or(status <> 'failed' AND (status <> 'degraded' OR items_scanned > 0)), false) AS company_outage FROM today WHERE NOT {_CHANNEL}",
    "q_purgeable": f"WITH {RUNS} SELECT DISTINCT source_name AS company FROM today WHERE NOT {_CHANNEL} AND status NOT IN ('failed', 'degraded') AND items_scanned > 0 AND source_id LIKE 'company:%'",
    "q_rejections": f"{BASE} SELECT reason, count(*) AS n FROM (SELECT 'outside_primary_ios' AS reason FROM norm WHERE NOT {primary('title')} UNION ALL SELECT 'off_topic' FROM norm WHERE ({topic('title', 'description')}) IS NULL) GROUP BY reason",
    "q_label_counts": f"{_WITH_BLOCKERS}, l AS (SELECT {_LABELS}, blockers FROM lab WHERE track = 'ai' OR ({topic('title', 'description')}) IS NOT NULL) SELECT label, count(*) AS n FROM (SELECT 'topic_' || topic AS label FROM l UNION ALL SELECT 'junior' FROM l WHERE junior UNION ALL SELECT 'not_workable_from_kyiv' FROM l WHERE NOT workable UNION ALL SELECT 'workable_from_kyiv_unknown' FROM l WHERE workable IS NULL UNION ALL SELECT 'location_needs_check' FROM l WHERE location_needs_check UNION ALL SELECT 'work_authorization' FROM l WHERE blockers <> '') GROUP BY label",
    "q_run_counts": _nodup("SELECT * FROM norm") + f" SELECT 'raw' AS name, count(*) AS n FROM raw UNION ALL SELECT 'normalized', count(*) FROM norm UNION ALL SELECT 'unique_roles', count(*) FROM roles UNION ALL SELECT 'inbox_eligible', count(*) FROM roles WHERE {inbox('track', 'title')} UNION ALL SELECT 'handover_eligible', count(*) FROM roles WHERE track = 'ai' OR ({topic('title', 'description')}) IS NOT NULL",
    "q_source_diag": f"{BASE} SELECT r.source, r.n AS raw, coalesce(m.n, 0) AS normalized, coalesce(m.i, 0) AS inbox_eligible, r.n - coalesce(m.n, 0) AS rejected FROM (SELECT source, count(*) AS n FROM raw GROUP BY 1) r LEFT JOIN (SELECT source, count(*) AS n, count(*) FILTER (WHERE {inbox('track', 'title')}) AS i FROM norm GROUP BY 1) m USING (source)",
    "q_quality_eval": "WITH x AS (SELECT n_chars > 1000 AS p, quality = 1 AS e FROM labels JOIN documents USING (doc_id)), n AS (SELECT count(*) FILTER (WHERE p AND e) AS tp, count(*) FILTER (WHERE p AND NOT e) AS fp, count(*) FILTER (WHERE NOT p AND e) AS fn, count(*) FILTER (WHERE NOT p AND NOT e) AS tn FROM x) SELECT *, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall FROM n",
    "q_number_form": "SELECT p_partkey, CASE WHEN n % 10 = 1 AND n <> 11 THEN 'one' WHEN n % 10 BETWEEN 2 AND 4 AND NOT n BETWEEN 12 AND 14 THEN 'few' ELSE 'many' END AS form FROM (SELECT p_partkey, (p_size + p_partkey) % 100 AS n FROM part)",
    "q_safe_error": "SELECT page_id, 'GET [url] token [redacted] failed' AS error FROM pages",
    "q_slots_due": f"WITH {CLOCK}, x AS (SELECT *, CASE WHEN m >= 840 THEN 14 WHEN m >= 480 THEN 8 END AS due, CASE WHEN m < 480 THEN date_trunc('day', s) + INTERVAL 8 HOUR WHEN m < 840 THEN date_trunc('day', s) + INTERVAL 14 HOUR ELSE date_trunc('day', s) + INTERVAL 32 HOUR END AS nxt FROM clock) SELECT event_id, due, CASE WHEN m >= due * 60 + 15 THEN due END AS kick, strftime(nxt, '%Y-%m-%d %H:%M') AS next, '⏭ ' || CASE WHEN CAST(nxt AS DATE) = CAST(s AS DATE) THEN '' ELSE 'завтра ' END || strftime(nxt, '%H:%M') AS text FROM x",
    "q_slots_late": f"WITH {CLOCK}, done AS (SELECT DISTINCT CAST(s AS DATE) AS day, CASE WHEN event_id % 80 = 0 THEN 8 ELSE 14 END AS slot FROM clock WHERE event_id % 40 = 0), x AS (SELECT event_id, CAST(s AS DATE) AS day, slot, m - slot * 60 AS lag_minutes FROM clock, (VALUES (8), (14)) t(slot)) SELECT event_id, slot, lag_minutes FROM x WHERE lag_minutes >= 60 AND NOT EXISTS (SELECT 1 FROM done WHERE done.day = x.day AND done.slot = x.slot)",
    "q_registry": f"WITH {SUPPLIERS}, b AS (SELECT slug FROM companies WHERE slug LIKE '%1'), w AS (SELECT slug, coalesce(CASE WHEN nation % 6 = 0 THEN false WHEN nation % 6 = 2 THEN true END, true) AS enabled FROM companies WHERE nation % 2 = 0) SELECT slug, 'bespoke' AS kind FROM b LEFT JOIN w USING (slug) WHERE coalesce(enabled, true) UNION ALL SELECT slug, 'watchlist' FROM w WHERE enabled AND slug NOT IN (SELECT slug FROM b) UNION ALL SELECT slug, 'board' FROM companies WHERE nation % 3 = 0 AND slug NOT IN (SELECT slug FROM b) AND slug NOT IN (SELECT slug FROM w)",
    "q_route": f"WITH {SUPPLIERS} SELECT slug, CASE WHEN nation BETWEEN 1 AND 3 THEN 'greenhouse' WHEN nation IN (4, 6, 7) THEN 'lever' WHEN career_url IS NULL THEN 'failed' ELSE 'page' END AS route, CASE WHEN nation BETWEEN 1 AND 7 AND nation <> 5 THEN name END AS token FROM companies",
    "q_overrides": f"WITH {SUPPLIERS} SELECT c.slug, coalesce(o.career_url, d.career_url, c.career_url) AS career_url, CASE WHEN o.slug IS NOT NULL THEN 'override' WHEN d.slug IS NOT NULL THEN 'discovered' WHEN c.career_url IS NOT NULL THEN 'own' END AS career_url_source FROM companies c LEFT JOIN (SELECT * FROM cust WHERE k % 5 = 0) o USING (slug) LEFT JOIN (SELECT * FROM cust WHERE k % 4 = 0) d ON d.slug = c.slug",
    "q_watchlist_merge": f"WITH {SUPPLIERS}, b AS (SELECT * FROM companies) SELECT slug, name, career_url, nation FROM b UNION ALL SELECT slug, name, career_url, nation FROM cust WHERE slug NOT IN (SELECT slug FROM b)",
    "q_preserve": f"WITH {SUPPLIERS} SELECT c.slug, c.name, coalesce(c.career_url, o.career_url) AS career_url, c.nation FROM companies c LEFT JOIN (SELECT * FROM cust WHERE k % 2 = 0) o USING (slug)",
    "q_catalog_merge": f"WITH {CATALOG} SELECT slug, name, site_url, vacancies_url, CAST(vacancy_count AS BIGINT) AS vacancy_count, CAST(added AS BIGINT) AS added, CAST(updated AS BIGINT) AS updated, CAST(unchanged AS BIGINT) AS unchanged FROM done",
    "q_catalog_stats": f"WITH {CATALOG} SELECT CAST(sum(added) AS BIGINT) AS added, CAST(sum(updated) AS BIGINT) AS updated, CAST(sum(unchanged) AS BIGINT) AS unchanged, count(*) AS total FROM done",
    "q_collect_list": f"WITH {SUPPLIERS}, k AS (SELECT 's' || o_custkey AS slug, count(*) AS n FROM orders GROUP BY 1) SELECT slug, name, vacancy_count FROM (SELECT slug, name, 0 AS r, CAST(NULL AS BIGINT) AS vacancy_count FROM companies UNION ALL SELECT slug, slug, 1, n FROM k WHERE n >= 2 AND slug NOT IN (SELECT slug FROM companies)) ORDER BY r, vacancy_count DESC NULLS LAST, lower(name), slug LIMIT 300",
    "q_recheck_topn": f"WITH {SUPPLIERS}, s AS (SELECT 's' || o_custkey AS slug, strftime(max(o_orderdate), '%Y-%m-%d') AS checked_at FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), x AS (SELECT slug, checked_at FROM cust LEFT JOIN s USING (slug) WHERE slug NOT IN (SELECT slug FROM companies)) SELECT slug, 'new' AS why, checked_at FROM x WHERE checked_at IS NULL UNION ALL (SELECT slug, 'stale', checked_at FROM x WHERE checked_at < '1998-01-01' ORDER BY checked_at, slug LIMIT 300)",
    "q_section_join": "SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
    "q_three_way_merge": "WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders), b AS (SELECT k, [v] AS v FROM o WHERE k % 5 <> 4), l AS (SELECT k, [CASE WHEN k % 11 = 0 THEN 'L' ELSE v END] AS v FROM o WHERE k % 7 <> 3), r AS (SELECT k, [CASE WHEN k % 13 = 0 THEN 'R' ELSE v END] AS v FROM o WHERE k % 9 <> 2), x AS (SELECT coalesce(b.k, l.k, r.k) AS key, b.v AS b, l.v AS l, r.v AS r FROM b FULL OUTER JOIN l ON b.k = l.k FULL OUTER JOIN r ON coalesce(b.k, l.k) = r.k), y AS (SELECT *, l IS DISTINCT FROM b AND r IS DISTINCT FROM b AND l IS DISTINCT FROM r AS conflict, CASE WHEN l IS NOT DISTINCT FROM b THEN r ELSE l END AS m FROM x) SELECT key, CASE WHEN NOT conflict THEN m[1] END AS value, CASE WHEN conflict THEN 'conflict' WHEN m IS NULL THEN 'deleted' ELSE 'kept' END AS status FROM y",
    "q_carry_forward": "SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS carried FROM orders",
    "q_latest_period": "SELECT o_orderkey, strftime(o_orderdate, '%m-%Y') AS period FROM orders WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)",
    "q_top_links": rf"""WITH l AS (SELECT page_id // 20 AS grp, 'https://' || {_list(LINK_HOSTS)}[((page_id * 7 + length(url)) % {len(LINK_HOSTS)} + 1)::INT] || {_list(LINK_PATHS)}[((page_id * 3 + length(html)) % {len(LINK_PATHS)} + 1)::INT] || page_id AS url, {_list(LINK_LABELS)}[(length(html) % {len(LINK_LABELS)} + 1)::INT] AS label FROM pages),
h AS (SELECT *, lower(regexp_extract(url, '^https://(?:[^/@]*@)?([^/:?#]*)', 1)) AS host, lower(url) AS low, lower(label) AS said FROM l),
s AS (SELECT grp, url, CASE WHEN len(list_filter(['ashbyhq.com', 'bamboohr.com', 'comeet.co', 'greenhouse.io', 'jobs.lever.co', 'oraclecloud.com', 'recruitee.com', 'smartrecruiters.com', 'teamtailor.com', 'workable.com'], lambda a: host = a OR suffix(host, '.' || a))) > 0 THEN 100 ELSE 0 END
  + CASE WHEN contains(low, 'career') OR contains(low, 'job') OR contains(low, 'vacanc') OR contains(low, 'open-position') OR contains(low, 'open_position') THEN 50 ELSE 0 END
  + CASE WHEN contains(said, 'career') OR contains(said, 'job') OR contains(said, 'vacanc') OR contains(said, 'open-position') OR contains(said, 'open_position') THEN 30 ELSE 0 END
  - CASE WHEN contains(low, 'blog') OR contains(low, 'news') OR contains(low, 'article') THEN 80 ELSE 0 END AS score FROM h)
SELECT grp, url, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY grp ORDER BY score DESC, length(url), url) = 1""",
    "q_ats_parse": "SELECT 'greenhouse' AS ats, p_name AS title, 'https://x/' || p_partkey AS url, p_brand AS location, 'a & b' AS description, CAST(p_partkey AS VARCHAR) AS job_id, CAST(NULL AS VARCHAR) AS remote FROM part WHERE p_size % 10 <> 0 UNION ALL SELECT 'lever', p_name, 'https://x/' || p_partkey, NULL, p_type, CAST(p_partkey AS VARCHAR), CASE WHEN p_size > 25 THEN 'remote' END FROM part WHERE p_size % 10 <> 0",
    "q_rss_parse": "SELECT p_name AS title, p_brand AS company, 'Київ' AS location, 'remote' AS remote, 'https://x/vacancies/' || p_partkey || '/?q=1' AS url, '2024-01-01 08:00' AS published_at, '<b>x</b>' AS description, CAST(p_partkey AS VARCHAR) AS source_job_id FROM part",
    "q_sitemap": "SELECT DISTINCT page_id // 100 AS source_id, url FROM pages WHERE regexp_matches(regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1), '[0-9]')",
    "q_page_titles": rf"SELECT page_id, regexp_replace({strip("regexp_extract(html, '<title[^>]*>((?s:.*?))</title>', 1, 'i')")}, '\s+', ' ', 'g') AS title FROM pages",
    "q_count_gaps": "SELECT o_orderkey, before FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS shown, lag(CAST(floor(o_totalprice / 1000) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE before IS NOT NULL AND shown <= before",
    "q_html_links": f"SELECT page_id AS source_id, CASE WHEN regexp_matches(u, '^https?://') THEN u ELSE 'https://x' || regexp_replace(u, '^/*', '/') END AS url, arg_min(t, i) AS title FROM (SELECT page_id, generate_subscripts(us, 1) AS i, unnest(us) AS u, unnest(ts) AS t FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1) AS us, regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2) AS ts FROM pages)) WHERE t <> '' GROUP BY 1, 2",
    "q_message_filters": "SELECT conv_id, turn, regexp_matches(lower(text), '" + "|".join(re.escape(x).replace("'", "''") for x in M.CANDIDATE_PHRASES) + "') AS candidate, regexp_matches(lower(text), '" + "|".join(re.escape(x).replace("'", "''") for x in M.VACANCY_PHRASES) + "') AS vacancy, CAST(NULL AS VARCHAR) AS apply_url FROM conversations",
    "q_page_signals": "SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(' ' || regexp_replace(" + html_text("regexp_replace(html, '<(script|style)\\b(?s:.*?)</(script|style)\\s*>', ' ', 'gi')") + ", '[^A-Za-z0-9]', '  ', 'g') || ' ', '[^a-zA-Z0-9](the|que|der|los)[^a-zA-Z0-9]', 1, 'i'), lambda x: lower(x)))), ' | ') AS signals FROM pages",
    "q_html_dom_links": r"SELECT page_id, CAST(unnest(range(len(h))) AS INTEGER) AS pos, unnest(h) AS href, trim(regexp_replace(regexp_replace(unnest(t), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS text FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\">((?s:.*?))</a>', 1) AS h, regexp_extract_all(html, '<a href=\"([^\"]*)\">((?s:.*?))</a>', 2) AS t FROM pages)",
    "q_chunk": r"""WITH RECURSIVE r AS (
  SELECT doc_id AS id, 0 AS part, CAST(NULL AS VARCHAR) AS chunk, coalesce(text, '') AS rest, false AS done FROM documents
  UNION ALL
  SELECT id, part + 1, CASE WHEN last THEN rest ELSE coalesce(nullif(piece, ''), left(rest, 4096)) END, CASE WHEN last THEN '' ELSE ltrim(substr(rest, CASE WHEN cut > 0 AND piece <> '' THEN cut ELSE 4096 END + 1), chr(10)) END, last
  FROM (SELECT *, rtrim(CASE WHEN cut > 0 THEN left(rest, cut) ELSE left(rest, 4096) END, chr(10)) AS piece FROM (SELECT *, length(rest) <= 4096 AS last, length(regexp_extract(left(rest, 4096), '(?s)^(.*)\n', 1)) AS cut FROM r WHERE NOT done)))
SELECT id, CAST(part - 1 AS INTEGER) AS part, chunk FROM r WHERE part > 0 AND (chunk <> '' OR part = 1)""",
    "q_stream_seen": "SELECT user_id || '/' || event_type AS key, min(event_id) AS event_id FROM events GROUP BY 1",
}
