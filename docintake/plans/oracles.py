"""The same results in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

from docintake.plans.workload import AS_OF, BODY, DEEP, DOCUMENTS, FAMILY_BODY, FAMILY_PATH, LANDING_PATH

LANDED = f"""
landed AS (
  SELECT doc_id AS seq, doc_id, source AS src, lang, {LANDING_PATH} AS path, {BODY} AS body,
         md5({BODY}) AS hash, CAST(strlen({BODY}) AS BIGINT) AS length
  FROM {DOCUMENTS})
"""

_PLACE = """CASE WHEN starts_with(path, 'ingress/remote') THEN 'remote' || substr(path, 15)
  WHEN starts_with(path, 'ingress') THEN 'local' || substr(path, 8) ELSE path END"""

CATALOG = f"""
rogue AS (SELECT doc_id, max(toxic) = 1 AS rogue_file FROM labels GROUP BY doc_id),
versions AS (
  SELECT 'c' AS kind, hash AS h, TIMESTAMP '2024-03-01' AS created, landed.* FROM landed WHERE doc_id % 3 = 0
  UNION ALL SELECT 'a', md5(body || 'old'), TIMESTAMP '2024-01-01', landed.* FROM landed WHERE doc_id % 5 = 0
  UNION ALL SELECT 'e', md5(body || 'new'), TIMESTAMP '2024-05-01', landed.* FROM landed WHERE doc_id % 7 = 0),
catalog AS (
  SELECT kind || lpad(CAST(v.doc_id AS VARCHAR), 12, '0') AS doc_id, v.doc_id AS number, {_PLACE} AS source,
         h AS hash, created, lang, rogue_file,
         CASE WHEN src = 'src1' THEN 'https://src1.example.com/' END AS origin_uri,
         CASE WHEN length(src) = 4 THEN kind || '-uuid-' || v.doc_id END AS uuid
  FROM versions v LEFT JOIN rogue r ON r.doc_id = v.doc_id)
"""

MATCHED = f"""
asked AS (SELECT *, {_PLACE} AS target FROM landed),
pairs AS (
  SELECT a.seq, c.* EXCLUDE (lang), a.hash AS own FROM asked a JOIN catalog c ON c.hash = a.hash
  UNION SELECT a.seq, c.* EXCLUDE (lang), a.hash FROM asked a JOIN catalog c ON c.source = a.path
  UNION SELECT a.seq, c.* EXCLUDE (lang), a.hash FROM asked a JOIN catalog c ON c.source = a.target),
newest AS (
  SELECT *, count(*) OVER (PARTITION BY seq) AS n,
         row_number() OVER (PARTITION BY seq ORDER BY created DESC, doc_id DESC) AS nth FROM pairs),
matched AS (
  SELECT a.*, coalesce(n.n, 0) AS n_matches, n.doc_id AS newest_doc,
         CASE WHEN n.hash = a.hash THEN n.doc_id END AS found_doc,
         coalesce(n.hash = a.hash, false) AS same,
         CASE WHEN n.hash = a.hash THEN n.source END AS found_source,
         CASE WHEN n.hash = a.hash THEN n.created END AS found_created,
         CASE WHEN n.hash = a.hash THEN n.rogue_file END AS found_rogue,
         CASE WHEN n.hash = a.hash THEN n.origin_uri END AS found_origin
  FROM asked a LEFT JOIN newest n ON n.seq = a.seq AND n.nth = 1)
"""

# Zone path of a source: landing prefix off, repeated derivatives off, base in front.
def _zone(src: str, base: str) -> str:
    bare = (
        f"regexp_replace(regexp_replace({src}, '^ingress/+', ''), "
        f"'(^|/)(?:derivatives/+)+', '\\1derivatives/', 'g')"
    )
    placed = f"CASE WHEN starts_with({bare}, '{base}/') THEN {bare} ELSE '{base}/' || {bare} END"
    return f"regexp_replace({placed}, '/+', '/', 'g')"


TARGETED = f"""
wanted AS (
  SELECT m.*, coalesce(found_source, path) AS doc_source,
    CASE WHEN doc_id % 26 IN (0, 13) THEN 'https://' || src || '.example.com/d/' || doc_id || '.html' END AS kept,
    CASE doc_id % 26 WHEN 7 THEN 'mongodb|- http|-' WHEN 9 THEN 'ftp|' || src || '/x http|-'
      WHEN 0 THEN 'mongodb|- https|https://' || src || '.example.com/d/' || doc_id || '.html'
      WHEN 13 THEN 'https|https://' || src || '.example.com/d/' || doc_id || '.html' END AS asked_origins
  FROM matched m),
first_remote AS (
  SELECT *, CASE WHEN found_origin IS NOT NULL THEN found_origin WHEN doc_id % 26 IN (0, 13) THEN kept
      WHEN doc_id % 26 = 9 THEN src || '/x' END AS first_uri,
    found_origin IS NOT NULL OR doc_id % 26 IN (0, 7, 9, 13) AS has_remote
  FROM wanted),
placed AS (
  SELECT *,
    CASE WHEN has_remote THEN
        CASE WHEN starts_with(doc_source, 'remote/') THEN doc_source
             WHEN first_uri LIKE 'https://%' THEN
               'remote/https/' || regexp_extract(first_uri, '^https://([^/]*)', 1) ||
               CASE WHEN first_uri LIKE '%/' THEN '/index.html' ELSE regexp_extract(first_uri, '^https://[^/]*(.*)$', 1) END
             WHEN first_uri IS NOT NULL THEN 'remote/' || first_uri || '.html' END
      WHEN starts_with(doc_source, 'local/') THEN doc_source
      ELSE {_zone('doc_source', 'local')} END AS target_path,
    CASE WHEN has_remote THEN starts_with(doc_source, 'remote/') ELSE starts_with(doc_source, 'local/') END AS in_place
  FROM first_remote)
"""

PLANNED = """
stored AS (
  SELECT path AS place, hash AS present FROM landed
  UNION ALL
  SELECT source, arg_max(hash, created) FROM catalog WHERE source NOT IN (SELECT path FROM landed) GROUP BY source),
planned AS (
  SELECT p.*, coalesce(s.present, p.hash) AS occupant,
    CASE WHEN length = 0 THEN 'ZERO_LENGTH' WHEN target_path IS NULL THEN 'MISSING_TARGET'
      WHEN coalesce(s.present, p.hash) <> p.hash THEN 'REPLACE' WHEN NOT in_place THEN 'MOVE'
      WHEN path = doc_source THEN 'NOOP' ELSE 'DISCARD' END AS action
  FROM placed p LEFT JOIN stored s ON s.place = p.target_path)
"""

PAGED = """
paged AS (
  SELECT page_id, url, html,
    regexp_extract(url, '^([a-z]+):', 1) AS scheme,
    regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS upath,
    regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query,
    CASE WHEN page_id % 11 = 0 THEN 'page-' || page_id || '.pdf' END AS disposition,
    CASE WHEN page_id % 11 <> 0 AND page_id % 5 = 0 THEN '/moved/' || page_id END AS location,
    CASE WHEN page_id % 11 = 0 THEN 'application/pdf'
      WHEN page_id % 5 = 0 THEN 'text/plain; charset=utf-8' ELSE 'text/html; charset=utf-8' END AS ctype
  FROM pages),
named AS (
  SELECT *, CASE WHEN upath = '' THEN 'index.html' ELSE regexp_extract(upath, '([^/]*)$', 1) END AS last,
    CASE WHEN upath = '' THEN '/' ELSE regexp_extract(upath, '^(.*/)[^/]*$', 1) END AS dir,
    CASE WHEN query <> '' THEN '.' || md5('?' || query) ELSE '' END AS mark
  FROM paged)
"""


def _mark(name: str, ext: str = "'.html'") -> str:
    return (
        f"CASE WHEN {name} = '' THEN 'index' || mark || {ext} "
        f"WHEN contains({name}, '.') THEN regexp_extract({name}, '^(.*)\\.(.*)$', 1) || mark || '.' || "
        f"regexp_extract({name}, '^(.*)\\.(.*)$', 2) ELSE {name} || mark || {ext} END"
    )


BASE = f"""dir || CASE WHEN disposition IS NOT NULL AND last IN ('', 'index.html') THEN disposition
  WHEN disposition IS NOT NULL THEN last || '/' || disposition ELSE {_mark('last')} END"""
HOSTED = "'/' || host || coalesce(location, '')"
EXTENSION = """CASE WHEN page_id % 11 = 0 THEN '.pdf' WHEN page_id % 5 = 0 THEN '.txt' ELSE '.html' END"""

_FETCHED = "TIMESTAMP '2024-05-01' + to_seconds(page_id % 1000000) AS fetched FROM pages"
_BEFORE = "TIMESTAMP '2024-01-01' FROM pages"


def _hop(uri: str, status: int, location: str, where: str = "true", time: str = _FETCHED) -> str:
    return f"UNION ALL SELECT {uri}, {status}, {location}, NULL, NULL, {time} WHERE {where}"


CAPTURES = f"""
log_all AS (
  SELECT url AS uri, CASE WHEN page_id % 17 = 3 THEN 404 ELSE 200 END AS status,
         CAST(NULL AS VARCHAR) AS location, html, page_id, {_FETCHED}
  {_hop("url", 301, "'http://before.example.com/' || page_id", "page_id % 9 = 0", _BEFORE)}
  {_hop("'http://r1.example.com/' || page_id", 302, "'http://before.example.com/' || page_id", "page_id % 10 = 0", _BEFORE)}
  {_hop("'http://r1.example.com/' || page_id", 301, "url")}
  {_hop("'http://r2.example.com/' || page_id", 302, "'http://r1.example.com/' || page_id", "page_id % 7 = 0")}
  {_hop("'http://r3.example.com/' || page_id", 307, "'http://r1.example.com/' || page_id", "page_id % 13 = 0")}
  {_hop("'http://lost.example.com/' || page_id", 301, "NULL", "page_id % 29 = 0")}
  {_hop("'http://loop.example.com/' || page_id", 302, "'http://loop.example.com/' || page_id", "page_id % 50 = 0")}
  {_hop("'http://odd.example.com/' || page_id", 302, "'gopher://h/' || page_id", "page_id % 31 = 0")}
  {_hop("'http://go.example.com/' || page_id", 302, "'http://hub.example.com/'", "page_id % 3 = 0")}
  {_hop("'http://hub.example.com/'", 301, "url", "page_id = 1")}
  UNION ALL SELECT 'http://deep.example.com/' || i, 301,
    CASE WHEN i < {DEEP} THEN 'http://deep.example.com/' || (i + 1) ELSE url END, NULL, NULL,
    TIMESTAMP '2024-05-01' + to_seconds(page_id) FROM pages, range(1, {DEEP} + 1) AS deep(i) WHERE page_id = 2),
log AS (SELECT * FROM log_all QUALIFY row_number() OVER (PARTITION BY uri ORDER BY fetched DESC) = 1),
extra AS (
  SELECT CASE WHEN page_id % 2 = 0 THEN 'ftp://bob:x@files.example.org:2121/p/' || page_id || '.txt'
    ELSE 'http://gone.example.com/' || page_id END AS uri FROM pages),
starts AS (SELECT uri FROM log_all UNION ALL SELECT uri FROM extra)
"""


def _walk(name: str, starts: str, statuses: str, most: str = "20") -> str:
    """Recursive walk: ``name`` has uri, stop, hops, chain and error at the end of each walk."""
    return f"""
{name}_steps AS (
  SELECT uri, uri AS stop, 1 AS requests, [uri] AS chain, false AS over FROM (SELECT DISTINCT uri FROM {starts})
  UNION ALL
  SELECT s.uri, l.location, requests + 1,
         CASE WHEN requests < {most} AND NOT list_contains(chain, l.location) THEN list_append(chain, l.location) ELSE chain END,
         requests >= {most} OR list_contains(chain, l.location)
  FROM {name}_steps s JOIN log l ON l.uri = s.stop AND l.status IN ({statuses}) AND l.location IS NOT NULL
  WHERE NOT over AND (s.stop LIKE 'http://%' OR s.stop LIKE 'https://%')),
{name}_last AS (SELECT * FROM {name}_steps QUALIFY row_number() OVER (PARTITION BY uri ORDER BY requests DESC) = 1),
{name} AS (
  SELECT s.uri, s.stop, s.over, s.stop LIKE 'ftp://%' AS ftp,
    CASE WHEN over THEN 'too_many_redirects' WHEN s.stop LIKE 'gopher://%' THEN 'unsupported_scheme'
      WHEN s.stop LIKE 'ftp://%' THEN NULL WHEN l.uri IS NULL THEN 'not_captured'
      WHEN l.status IN ({statuses}) THEN 'unable_to_follow' END AS error,
    CASE WHEN over THEN NULL ELSE l.status END AS status,
    CASE WHEN over THEN chain
      WHEN (l.uri IS NULL AND s.stop NOT LIKE 'ftp://%') OR s.stop LIKE 'gopher://%' THEN chain[1:len(chain) - 1]
      ELSE chain END AS chain
  FROM {name}_last s LEFT JOIN log l ON l.uri = s.stop AND NOT s.over)
"""


RESOLVED = _walk("resolved", "starts", "301, 302", "1000000")
FETCH = ", ".join(str(s) for s in range(300, 400))


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


OPS = """
ops AS (
  SELECT ts, CASE WHEN user_id % 2 = 0 THEN 'intake' ELSE 'unpack' END AS consumer,
    (['move', 'copy', 'remove', 'update_document', 'insert_document', 'update_parent_child_mappings'])[event_id % 6 + 1] AS operation,
    CASE WHEN event_id % 5 < 2 THEN 'http' ELSE 'ftp' END AS scheme,
    (['text/html', 'application/pdf', 'text/plain'])[event_id % 3 + 1] AS mimetype,
    value AS seconds, CAST(event_id * 37 % 100000 AS BIGINT) AS bytes
  FROM events)
"""


def _quantiles(labels: str, value: str, total: str, where: str = "true") -> str:
    return _with(
        OPS,
        f"""ranked AS (SELECT {labels}, {value} AS v,
          row_number() OVER (PARTITION BY {labels} ORDER BY {value}) AS r,
          count(*) OVER (PARTITION BY {labels}) AS n FROM ops WHERE {where})""",
    ) + (
        f"SELECT {labels}, max(n) AS n, {total} AS total, min(CASE WHEN r >= ceil(0.5 * n) THEN v END) AS q50, "
        f"min(CASE WHEN r >= ceil(0.9 * n) THEN v END) AS q90 FROM ranked GROUP BY {labels}"
    )


_LOCAL = _with(LANDED, CATALOG, MATCHED)
_TARGETS = _with(LANDED, CATALOG, MATCHED, TARGETED)
_PLAN = _with(LANDED, CATALOG, MATCHED, TARGETED, PLANNED)
_UUID = (
    "substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || "
    "substr({0}, 17, 4) || '-' || substr({0}, 21, 12)"
)
_SECONDS = f"epoch(TIMESTAMP '{AS_OF}')"
_NEW_ID = f"lpad(lower(to_hex(CAST({_SECONDS} AS BIGINT))), 8, '0') || lpad(lower(to_hex(seq)), 16, '0')"
_DOOMED = """
keys AS (SELECT coalesce(found_doc, 'new') AS kept, hash, path, target FROM planned WHERE action = 'REPLACE'),
doomed AS (
  SELECT c.doc_id FROM catalog c JOIN keys k ON k.hash = c.hash WHERE k.kept <> c.doc_id
  UNION SELECT c.doc_id FROM catalog c JOIN keys k ON k.path = c.source WHERE k.kept <> c.doc_id
  UNION SELECT c.doc_id FROM catalog c JOIN keys k ON k.target = c.source WHERE k.kept <> c.doc_id)
"""
_ERROR = """CASE
  WHEN coalesce(quality, 0) = 1 AND p.doc_id % 5 = 0 AND same THEN 'silent_validation'
  WHEN coalesce(found_rogue, false) THEN 'rogue_file'
  WHEN p.doc_id % 26 = 7 THEN 'missing_origin_uri' WHEN p.doc_id % 26 = 9 THEN 'invalid_origin_scheme' END"""
_QUALITY = "quality_of AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id)"
_MAPPINGS = f"""
edges AS (
  SELECT 'm' || conv_id || '-' || turn AS mapping_id, 'p' || conv_id AS parent,
    CASE WHEN turn % 3 = 0 THEN 'k' || conv_id || '-' || turn END AS child,
    'ingress/derivatives/conv' || conv_id || '/' || turn || '.txt' AS child_path,
    CASE WHEN turn = 0 THEN 'unpack' END AS consumer, conv_id, turn FROM conversations
  UNION ALL
  SELECT 'd' || doc_id, 'a' || lpad(CAST(doc_id - doc_id % 8 AS VARCHAR), 12, '0'), NULL, {LANDING_PATH},
    'unpack', NULL, NULL FROM documents WHERE doc_id % 8 IN (0, 5))
"""

SUPPRESS_STREAM = """
WITH RECURSIVE run AS (
    SELECT user_id::VARCHAR AS doc_id, event_id AS seq, ts,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events
), walk AS (
    SELECT doc_id, seq, ts, nth, ts AS started, false AS too_recent FROM run WHERE nth = 1
    UNION ALL
    SELECT run.doc_id, run.seq, run.ts, run.nth,
        CASE WHEN run.ts - walk.started < INTERVAL 6 HOUR THEN walk.started ELSE run.ts END,
        run.ts - walk.started < INTERVAL 6 HOUR
    FROM walk JOIN run ON run.doc_id = walk.doc_id AND run.nth = walk.nth + 1
)
SELECT doc_id, seq, too_recent FROM walk
"""

LAYERED_OPERATIONS = """
WITH RECURSIVE changes AS (
    SELECT 'local/p' || p_partkey AS path, CASE WHEN p_partkey % 10 = 9 THEN 'ingress/p' || p_partkey
        WHEN p_partkey % 10 > 0 THEN 'local/p' || (p_partkey + 1) END AS source FROM part
    UNION ALL SELECT 'local/c' || c_custkey, 'local/c' || (c_custkey - c_custkey % 4 + (c_custkey + 1) % 4) FROM customer
    UNION ALL SELECT 'local/s' || s_suppkey, 'local/s' || (s_suppkey - s_suppkey % 5) FROM supplier
), puts AS (SELECT * FROM changes WHERE source <> path),
follows AS (SELECT a.path, b.path AS after FROM puts a JOIN puts b ON a.source = b.path),
reach AS (
    SELECT path, after FROM follows UNION SELECT reach.path, follows.after FROM reach JOIN follows ON reach.after = follows.path
), aside AS (
    SELECT DISTINCT min(after) AS path FROM reach WHERE path IN (SELECT path FROM reach r WHERE r.path = r.after) GROUP BY reach.path
), open_follows AS (SELECT * FROM follows WHERE after NOT IN (SELECT path FROM aside)),
way AS (
    SELECT path, path AS last, 0 AS steps FROM puts WHERE path NOT IN (SELECT path FROM open_follows)
    UNION ALL SELECT f.path, way.last, way.steps + 1 FROM way JOIN open_follows f ON f.after = way.path
), placed AS (
    SELECT (max(steps) OVER (PARTITION BY last) - steps + 1)::BIGINT AS layer, path AS to_path,
        CASE WHEN source IN (SELECT path FROM aside) THEN source || '.aside' ELSE source END AS from_path
    FROM way JOIN puts USING (path)
), wanted AS (SELECT from_path, count(*) AS n, max(layer) AS last_read FROM placed GROUP BY ALL),
gone AS (
    SELECT path AS from_path FROM changes WHERE source IS NULL UNION ALL SELECT path || '.aside' FROM aside
)
SELECT layer, CASE WHEN n = 1 AND from_path NOT IN (SELECT path FROM changes WHERE source = path)
    THEN 'move' ELSE 'copy' END AS op, from_path, to_path FROM placed JOIN wanted USING (from_path)
UNION ALL SELECT 0, 'move', path, path || '.aside' FROM aside
UNION ALL SELECT coalesce(last_read + 1, 0), 'remove', from_path, NULL FROM gone LEFT JOIN wanted USING (from_path)
    WHERE n IS NULL OR n > 1
"""

ORACLES = {
    "suppress_stream": SUPPRESS_STREAM,
    "running_size_summary": _with(OPS)
    + "SELECT scheme, mimetype, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS total, "
    "true AS q50_near, true AS q90_near FROM ops GROUP BY scheme, mimetype",
    "layered_operations": LAYERED_OPERATIONS,
    "decode_messages": """
SELECT doc_id AS seq, doc_id % 19 <> 0 AND doc_id % 23 <> 0 AS good,
  CASE WHEN doc_id % 19 <> 0 AND doc_id % 23 <> 0 THEN 'ingress/' || source || '/' || doc_id || '.txt' END AS source,
  CASE WHEN doc_id % 19 = 0 THEN '' WHEN doc_id % 23 = 0 THEN 'a' ELSE lang END AS tags,
  CASE WHEN doc_id % 19 <> 0 AND doc_id % 23 <> 0 THEN doc_id % 2 = 0 END AS derivative,
  CASE WHEN doc_id % 19 <> 0 AND doc_id % 23 <> 0 THEN 'https://' || source || '.example.com/' || doc_id END AS origin_uri,
  CASE WHEN doc_id % 19 <> 0 AND doc_id % 23 <> 0 THEN 'Server' END AS header
FROM documents""",
    "message_stream": "SELECT doc_id AS seq, doc_id % 19 <> 0 AND doc_id % 23 <> 0 AS good FROM documents",
    # a text file ends with a line feed
    "scan_landing_files": """
SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length, md5(text || chr(10)) AS md5,
  CASE WHEN regexp_matches(text, '[\\x00-\\x08\\x0E-\\x1A\\x1C-\\x1F]') THEN 'binary' ELSE 'text' END AS kind
FROM documents""",
    "landing_facts": _with(LANDED)
    + """SELECT seq, path, length, hash AS md5, CASE WHEN length = 0 THEN 'empty'
  WHEN regexp_matches(body, '[\\x00-\\x08\\x0E-\\x1A\\x1C-\\x1F]') THEN 'binary' ELSE 'text' END AS kind FROM landed""",
    "load_catalog": _with(LANDED, CATALOG)
    + """SELECT doc_id, source, hash,
  CASE WHEN doc_id LIKE 'e%' OR source LIKE '%7.txt' THEN 'text/html' ELSE 'text/plain' END AS mimetype
FROM catalog WHERE source NOT LIKE '%5.txt'""",
    "write_content": """
SELECT path, seq, 'local' AS zone, md5 FROM (
  SELECT 'local/' || source || '/' || doc_id % 50 AS path, doc_id AS seq, md5(text) AS md5 FROM documents)
QUALIFY row_number() OVER (PARTITION BY path ORDER BY seq DESC) = 1""",
    "emit_notifications": _PLAN
    + """SELECT '{"seq":' || seq || ',"doc_id":"' || found_doc || '","source":"' || target_path || '","hash":"' ||
  hash || '","consumer":"intake"}' AS value FROM planned WHERE same AND action NOT IN ('ZERO_LENGTH', 'MISSING_TARGET')""",
    "emit_errors": _with(LANDED, CATALOG, MATCHED, TARGETED, _QUALITY)
    + f"""SELECT seq, source, outcome, CASE outcome WHEN 'silent_validation' THEN 'Suppressed exception for Validation'
  WHEN 'rogue_file' THEN 'cannot process rogue file' WHEN 'missing_origin_uri' THEN 'origin has no uri'
  ELSE 'contains invalid origin scheme' END || ': ' || source AS error_text
FROM (SELECT seq, path AS source, {_ERROR} AS outcome FROM placed p LEFT JOIN quality_of q ON q.doc_id = p.doc_id)
WHERE outcome IS NOT NULL""",
    "strip_root": _with(LANDED)
    + """SELECT seq, CASE WHEN doc_id % 2 = 0 THEN '/' ELSE '' END || path AS source, path AS stripped FROM landed""",
    "classify_source": _with(LANDED, CAPTURES)
    + """, every AS (SELECT uri AS src FROM starts UNION ALL SELECT path FROM landed),
flat AS (SELECT src, NOT contains(src, '%') AS ok, contains(src, '://') AS remote FROM every)
SELECT src, ok AS is_uri, CASE WHEN ok THEN CASE WHEN remote THEN split_part(src, '://', 1) ELSE 'file' END END AS scheme,
  CASE WHEN remote THEN CASE WHEN src LIKE 'ftp:%' THEN 'files.example.org' ELSE regexp_extract(src, '://([^/?#]*)', 1) END END AS host,
  CASE WHEN ok THEN CASE WHEN remote THEN regexp_extract(src, '://[^/?#]*([^?#]*)', 1) ELSE src END END AS path,
  nullif(regexp_extract(src, '\\?([^#]*)', 1), '') AS query, CASE WHEN src LIKE 'ftp:%' THEN 'bob:x' END AS userinfo,
  CASE WHEN remote THEN 'remote' ELSE 'local' END AS route FROM flat""",
    "scheme_support": _with(LANDED, CAPTURES)
    + """, every AS (SELECT location AS uri FROM log_all WHERE location IS NOT NULL UNION ALL SELECT path FROM landed)
SELECT uri, CASE WHEN uri LIKE 'gopher%' THEN 'unsupported_scheme' WHEN uri LIKE 'http%' THEN 'supported'
  ELSE 'undefined_scheme' END AS status FROM every""",
    "remote_origins": """
SELECT doc_id AS seq, CAST(CASE WHEN doc_id % 26 = 13 THEN 1 ELSE 2 END AS BIGINT) AS n_origins,
  CAST(CASE WHEN doc_id % 26 = 9 THEN 2 ELSE 1 END AS BIGINT) AS n_remote,
  CASE doc_id % 26 WHEN 7 THEN 'http' WHEN 9 THEN 'ftp' ELSE 'https' END AS first_scheme,
  CASE doc_id % 26 WHEN 7 THEN NULL WHEN 9 THEN source || '/x'
    ELSE 'https://' || source || '.example.com/d/' || doc_id || '.html' END AS first_uri
FROM """ + DOCUMENTS + """ WHERE doc_id % 26 IN (0, 7, 9, 13)""",
    "in_zone": _with(LANDED, CATALOG)
    + "SELECT doc_id, source LIKE 'local/%' AS in_local, source LIKE 'remote/%' AS in_remote FROM catalog",
    "lookup_target": _with(LANDED) + f"SELECT seq, path, {_PLACE} AS target FROM landed",
    "zone_target_path": _with(LANDED)
    + f"SELECT seq, path, {_zone('path', 'local')} AS in_local, {_zone('path', 'archive')} AS in_archive FROM landed",
    "local_target_path": _with(LANDED)
    + f"""SELECT seq, path, CASE WHEN starts_with(path, 'local/') THEN path ELSE {_zone('path', 'local')} END AS target
FROM landed""",
    "remote_target_path": _with(LANDED)
    + """SELECT seq, path, CASE WHEN starts_with(path, 'ingress/remote/') THEN substr(path, 9)
  ELSE 'remote/x/' || path END AS target FROM landed""",
    "local_to_remote_target_path": _with(PAGED)
    + f"""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'remote/old/' || page_id
  ELSE regexp_replace('remote/' || scheme || {HOSTED} || {BASE}, '/+', '/', 'g') END AS target FROM named""",
    "archive_path": _with(LANDED)
    + f""", stored AS (SELECT seq, path, hash, CASE WHEN starts_with(path, 'local/') THEN path
    ELSE {_zone('path', 'local')} END AS t FROM landed),
parts AS (SELECT *, regexp_extract(t, '^(.+)/[^/]+$', 1) AS folder, regexp_extract(t, '([^/]+)$', 1) AS file FROM stored)
SELECT seq, path, 'archive/' || folder || '/' || file || '/' || hash ||
  CASE WHEN contains(file, '.') THEN '.' || regexp_extract(file, '([^.]+)$', 1) ELSE '' END AS archived FROM parts""",
    "remote_file_path": _with(PAGED)
    + f""", given AS (SELECT *, CASE WHEN page_id % 2 = 0 THEN 'given-' || page_id END AS given FROM named)
SELECT page_id, url, 'remote/' || scheme || {HOSTED} || {BASE} AS path,
  'remote-ingress/' || scheme || '/' || host || CASE
    WHEN given IS NULL THEN dir || {_mark('last', EXTENSION)}
    ELSE dir || last || CASE WHEN last = '' THEN '' ELSE '/' END || given || mark || {EXTENSION} END AS temp_path
FROM given""",
    "basename": _with(PAGED) + f"SELECT page_id, {BASE} AS base FROM named",
    "insert_query_hash": _with(PAGED)
    + f"""SELECT page_id, {_mark('l')} AS name
FROM (SELECT *, regexp_extract(upath, '([^/]*)$', 1) AS l FROM named)""",
    "header_values": _with(PAGED)
    + f"""SELECT page_id, disposition, CASE WHEN page_id % 11 = 0 THEN 'page ' || page_id || '.pdf' END AS file_name,
  ctype AS content_type, location, {HOSTED} AS location_part FROM named""",
    "shorten_name": """
SELECT doc_id, CASE WHEN length(stem) + 7 <= 255 THEN stem || '.q1.pdf' ELSE md5(stem) || '.' ||
    replace(replace(replace(replace(stem || '.q1.pdf', stem, ''), 'pdf', ''), '.', ''), '', '') || '.pdf' END AS name
FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z]+', '-', 'g') AS stem FROM documents)""",
    "endpoint_profile": """
SELECT 'ftp' AS scheme, 'files.example.org' AS host, CAST(2121 AS BIGINT) AS port, 'bob' AS login,
  count(*) AS n, min('/p/' || page_id || '.txt') AS first_path FROM pages WHERE page_id % 2 = 0""",
    "detect_mimetype": _with(LANDED)
    + """SELECT url AS name, 'text/html' AS mimetype FROM pages
UNION ALL SELECT 'late/' || page_id, 'text/html' FROM pages
UNION ALL SELECT 'binary/' || page_id, 'application/octet-stream' FROM pages
UNION ALL SELECT path, CASE WHEN path LIKE '%.txt' THEN 'text/plain' WHEN path LIKE '%.html' THEN 'text/html'
  WHEN path LIKE '%.csv' THEN 'text/csv' WHEN length = 0 THEN 'application/octet-stream'
  WHEN regexp_matches(body, '[\\x00-\\x08\\x0E-\\x1A\\x1C-\\x1F]') THEN 'application/octet-stream'
  ELSE 'text/plain' END FROM landed""",
    "file_attrs": _with(LANDED)
    + """SELECT seq, '/data/' || regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(path, '([^/]*)$', 1) AS name,
  '2024-05-31 00:00:00' AS mtime, length AS size, length = 0 AS empty FROM landed""",
    "catalog_source": _with(LANDED)
    + "SELECT seq, path, CASE WHEN seq % 2 = 0 THEN path ELSE 'old/' || path END AS source FROM landed",
    "fill_uuid": _with(LANDED, CATALOG)
    + "SELECT doc_id, coalesce(uuid, " + _UUID.format("md5('uuid:' || doc_id)") + ") AS uuid FROM catalog",
    "match_local": _LOCAL + "SELECT seq, n_matches, newest_doc FROM matched",
    "match_remote": """
WITH rows AS (
  SELECT 'p' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS doc_id,
    CASE WHEN page_id % 4 = 0 THEN url ELSE 'remote/p/' || page_id END AS source,
    CASE WHEN page_id % 5 = 0 THEN md5(html || 'x') ELSE md5(html) END AS hash,
    TIMESTAMP '2024-01-01' + to_days(CAST(page_id % 9 AS INTEGER)) AS created,
    CASE WHEN page_id % 2 = 0 THEN url WHEN page_id % 3 = 0 THEN 'http://r1.example.com/' || page_id END AS origin_uri
  FROM pages),
asked AS (
  SELECT page_id AS seq, md5(html) AS h, url AS u FROM pages
  UNION ALL SELECT page_id + 10000000, md5(html), 'http://r1.example.com/' || page_id FROM pages WHERE page_id % 3 = 0),
pairs AS (
  SELECT a.seq, r.* FROM asked a JOIN rows r ON r.hash = a.h
  UNION SELECT a.seq, r.* FROM asked a JOIN rows r ON r.source = a.u
  UNION SELECT a.seq, r.* FROM asked a JOIN rows r ON r.origin_uri = a.u),
best AS (SELECT *, count(*) OVER (PARTITION BY seq) AS n FROM pairs
  QUALIFY row_number() OVER (PARTITION BY seq ORDER BY created DESC, doc_id DESC) = 1)
SELECT a.seq, coalesce(n, 0) AS n_matches, CASE WHEN b.hash = a.h THEN b.doc_id END AS doc_id,
  NOT coalesce(b.hash = a.h, false) AS is_new,
  coalesce(n, 0) - CASE WHEN b.hash = a.h THEN 1 ELSE 0 END AS n_archivable
FROM asked a LEFT JOIN best b ON b.seq = a.seq""",
    "latest_and_archivable": _LOCAL
    + """SELECT seq, found_doc AS doc_id, found_source AS doc_source, NOT same AS is_new,
  n_matches - CASE WHEN same THEN 1 ELSE 0 END AS n_archivable FROM matched""",
    "content_dedup": _with(LANDED)
    + """SELECT hash AS md5, arg_min(path, seq) AS path, min(seq) AS first_seq, count(*) AS n_copies,
  CAST(sum(length) - min(length) AS BIGINT) AS bytes_saved FROM landed GROUP BY hash""",
    "resolve_redirects": _with(CAPTURES, RESOLVED, recursive=True)
    + """SELECT uri, array_to_string(list_reverse(chain), ' ') AS chain, CAST(len(chain) AS BIGINT) AS n_origins,
  CAST(CASE WHEN ftp THEN NULL ELSE status END AS BIGINT) AS terminal_status, error,
  nullif(regexp_replace(regexp_extract(list_reverse(chain)[1], '://([^/?#]*)', 1), '^.*@|:[0-9]+$', '', 'g'), '') AS canonical_host
FROM resolved""",
    "follow_to_payload": _with(CAPTURES, _walk("fetched", "starts", FETCH), recursive=True)
    + """SELECT uri, stop AS payload_uri, CAST(len(chain) AS BIGINT) AS n_requests,
  CAST(CASE WHEN ftp THEN NULL ELSE status END AS BIGINT) AS status,
  coalesce(error, CASE WHEN NOT ftp AND status <> 200 THEN 'bad_status' END) AS error FROM fetched""",
    "content_type_extension": _with(PAGED) + f"""SELECT page_id, {EXTENSION} AS extension FROM paged
UNION ALL SELECT page_id + n * 1000000000::BIGINT, extension FROM paged,
  (VALUES (1, ''), (2, '.html'), (3, '.webp'), (4, '.mp4')) AS odd(n, extension)""",
    "document_targets": _TARGETS
    + """SELECT seq, target_path, in_place, path AS temp_path,
  concat_ws(' ', found_origin, CASE doc_id % 26 WHEN 7 THEN '- -' WHEN 9 THEN src || '/x -'
    WHEN 0 THEN '- ' || kept WHEN 13 THEN kept END) AS origins FROM placed""",
    "validate_messages": _with(LANDED, CATALOG, MATCHED, TARGETED, _QUALITY)
    + f"SELECT seq, {_ERROR} AS error FROM placed p LEFT JOIN quality_of q ON q.doc_id = p.doc_id",
    "verify_window": _with(OPS)
    + """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || coalesce('.' || nullif(rtrim(strftime(ts, '%f'), '0'), ''), '') AS ts,
  operation, apart, apart > 86400 AS old
FROM (SELECT *, CAST(abs(floor(epoch_us(TIMESTAMP '2024-01-15 12:00:00' - ts) / 1000000.0)) AS BIGINT) AS apart FROM (
  SELECT * FROM ops))""".replace(
        "epoch_us(TIMESTAMP '2024-01-15 12:00:00' - ts)",
        "(epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(ts))",
    ),
    "target_occupancy": _PLAN + "SELECT seq, target_path, occupant FROM planned",
    "plan_file_actions": _PLAN + "SELECT seq, target_path, action FROM planned",
    "path_actions": _PLAN
    + """SELECT seq, 'move' AS op, path AS from_path, target_path AS to_path FROM planned
  WHERE action IN ('MOVE', 'REPLACE') AND path <> target_path
UNION ALL SELECT seq, 'remove', path, NULL FROM planned WHERE action = 'DISCARD'
UNION ALL SELECT seq, 'orphan', doc_source, NULL FROM planned WHERE action IN ('MOVE', 'REPLACE')
  AND doc_source LIKE 'local/%' AND doc_source <> target_path AND doc_source <> path""",
    "new_catalog_rows": _LOCAL
    + f"""SELECT {_NEW_ID} AS doc_id, path AS source, hash, '' AS mimetype, '{AS_OF}' AS created,
  doc_id % 8 IN (0, 5) AS derivative, CAST(0 AS BIGINT) AS n_tags, """
    + _UUID.format(f"md5('uuid:' || {_NEW_ID})")
    + " AS uuid FROM matched WHERE NOT same",
    "append_new": _LOCAL
    + f"""SELECT doc_id, source, hash, strftime(created, '%Y-%m-%d %H:%M:%S') AS updated FROM catalog
UNION ALL SELECT {_NEW_ID}, path, hash, '{AS_OF}' FROM matched WHERE NOT same""",
    "consolidate_origins": _TARGETS
    + "SELECT seq, concat_ws(' ', 'https|' || found_origin, asked_origins) AS origins FROM placed",
    "merge_tags": _LOCAL
    + "SELECT seq, lang || ',s' || seq % 3 || CASE WHEN same THEN coalesce(nullif(',' || found_lang, ',' || lang), '') || ',stored' ELSE '' END AS tags "
    + "FROM (SELECT m.*, c.lang AS found_lang FROM matched m LEFT JOIN catalog c ON c.doc_id = m.found_doc)",
    "merge_metadata": _LOCAL
    + "SELECT seq, 'lang/string/' || lang || CASE WHEN same THEN ',lang/int/' || found_lang ELSE '' END AS metadata "
    + "FROM (SELECT m.*, c.lang AS found_lang FROM matched m LEFT JOIN catalog c ON c.doc_id = m.found_doc)",
    "upsert_catalog": _with(LANDED, CATALOG)
    + f"""SELECT doc_id, CASE WHEN number % 2 = 0 THEN 'moved/' || source ELSE source END AS source, hash,
  CASE WHEN number % 4 = 0 THEN 'text/html' ELSE 'text/plain' END AS mimetype, number % 2 = 0 AS derivative,
  CASE WHEN number % 2 = 0 THEN '{AS_OF}' ELSE strftime(created, '%Y-%m-%d %H:%M:%S') END AS updated,
  CASE WHEN number % 2 = 0 THEN 'fresh,stored,' || lang ELSE lang || ',stored' END AS tags,
  CASE WHEN number % 2 = 0 THEN regexp_extract(source, '([^/]*)$', 1) END AS name,
  CASE WHEN number % 2 = 0 THEN coalesce(uuid, """
    + _UUID.format("md5('uuid:' || doc_id)")
    + ") ELSE uuid END AS uuid FROM catalog",
    "delete_superseded": _with(LANDED, CATALOG, MATCHED, TARGETED, PLANNED, _DOOMED)
    + "SELECT doc_id, source, hash FROM catalog WHERE doc_id NOT IN (SELECT doc_id FROM doomed)",
    "delete_lineage": _with(LANDED, CATALOG, MATCHED, TARGETED, PLANNED, _DOOMED, _MAPPINGS)
    + "SELECT mapping_id, parent, child_path FROM edges WHERE parent NOT IN (SELECT doc_id FROM doomed)",
    "delete_zero_length": _PLAN
    + """SELECT doc_id, hash FROM catalog WHERE doc_id NOT IN (
  SELECT found_doc FROM planned WHERE length = 0 AND found_doc IS NOT NULL)""",
    "update_lineage": _with(_MAPPINGS)
    + """SELECT mapping_id, parent,
  CASE WHEN turn % 4 = 0 THEN 'z' || (conv_id * 100000 + turn) WHEN turn % 2 = 0 THEN 'n' || (conv_id * 100000 + turn) ELSE child END AS child,
  CASE WHEN turn % 2 = 0 THEN 'local' || substr(child_path, 8) ELSE child_path END AS child_path, consumer FROM edges""",
    "confirm_updates": _with(LANDED)
    + "SELECT seq, 'c' || lpad(CAST(seq AS VARCHAR), 12, '0') AS doc_id, doc_id % 3 = 0 AS confirmed FROM landed",
    "document_size_summary": _quantiles("scheme, mimetype", "bytes", "CAST(sum(v) AS BIGINT)"),
    "fetch_latency_summary": _quantiles("scheme", "seconds", "round(sum(v), 2)"),
    "file_operation_summary": _quantiles(
        "operation", "seconds", "round(sum(v), 2)", "operation IN ('move', 'copy', 'remove')"
    ),
    "catalog_operation_summary": _quantiles(
        "consumer, operation", "seconds", "round(sum(v), 2)",
        "operation NOT IN ('move', 'copy', 'remove')",
    ),
    "outcome_counts": _with(OPS)
    + """SELECT consumer, CASE WHEN bytes % 10 = 0 THEN 'no_document' ELSE 'ok' END AS result, count(*) AS n
FROM ops GROUP BY ALL""",
    "batch_sequence": _with(LANDED)
    + "SELECT seq, hash AS md5, row_number() OVER (PARTITION BY hash ORDER BY seq) AS nth FROM landed",
    "suppress_recent": _LOCAL
    + """SELECT seq, found_doc AS doc_id, CAST(substr(found_doc, 2) AS BIGINT) % 4 = 0 AS too_recent
FROM matched WHERE same""",
    "mark_run_state": _with(LANDED, CATALOG)
    + f"""SELECT doc_id, 'intake' AS consumer,
  CASE WHEN doc_id LIKE 'c%' THEN '{AS_OF}' WHEN number % 4 = 0 THEN '2024-05-31 23:59:55'
    ELSE strftime(created, '%Y-%m-%d %H:%M:%S') END AS started,
  CASE WHEN doc_id LIKE 'c%' AND length(source) % 2 = 0 THEN '{AS_OF}' END AS ended FROM catalog""",
    "retry_candidates": """SELECT doc_id AS seq, doc_id % 5 + 1 AS attempt FROM documents
WHERE (doc_id % 19 = 0 OR doc_id % 23 = 0) AND doc_id % 5 < 3""",
    "message_sources": _with(LANDED)
    + f"""SELECT seq, path AS raw, 'local' AS route, hash, length,
  CASE WHEN path = {_PLACE} THEN path ELSE path || ' ' || {_PLACE} END AS sources,
  CASE doc_id % 26 WHEN 7 THEN 'missing_origin_uri' WHEN 9 THEN 'invalid_origin_scheme' END AS origin_error,
  CAST(NULL AS VARCHAR) AS static_error FROM landed""",
    "attach_payloads": _with(CAPTURES, RESOLVED, "ends AS (SELECT stop AS uri FROM resolved WHERE error IS NULL)",
                             _walk("fetched", "ends", FETCH), PAGED, recursive=True)
    + f""", joined AS (
  SELECT r.uri, r.stop AS origin, coalesce(r.error, f.error, CASE WHEN f.ftp THEN 'not_captured'
      WHEN f.status <> 200 THEN 'bad_status' END) AS problem, l.html, p.*,
    CASE WHEN p.page_id % 11 = 0 THEN 'page ' || p.page_id || '.pdf' END AS given, r.stop = f.stop AS direct
  FROM resolved r LEFT JOIN fetched f ON r.error IS NULL AND f.uri = r.stop
  LEFT JOIN log l ON l.uri = f.stop LEFT JOIN named p ON p.url = f.stop),
pathed AS (
  SELECT *, CASE
    WHEN direct AND given IS NOT NULL THEN scheme || '/' || host || dir || last ||
      CASE WHEN last = '' THEN '' ELSE '/' END || 'page ' || page_id || mark || '.pdf'
    WHEN direct THEN scheme || {HOSTED} || dir || {_mark('last', EXTENSION)}
    WHEN given IS NOT NULL THEN replace(origin, '://', '/') || '/' || given
    ELSE replace(origin, '://', '/') || {EXTENSION} END AS place
  FROM joined)
SELECT uri, CASE WHEN problem IS NULL THEN origin END AS origin_uri,
  CASE WHEN problem IS NULL THEN 'remote-ingress/' || place END AS temp_path,
  CASE WHEN problem IS NULL THEN 'remote/' || place END AS target_path,
  CASE WHEN problem IS NULL THEN md5(html) END AS hash,
  CASE WHEN problem IS NULL THEN CAST(strlen(html) AS BIGINT) END AS length,
  CASE WHEN problem IS NULL THEN 'text/html' END AS mimetype, problem IS NULL AS good FROM pathed""",
    "ingest_families": f"""
WITH d AS (SELECT doc_id, doc_id % 6 AS family, {FAMILY_PATH} AS place FROM documents),
m AS (SELECT *, 0 AS again FROM d UNION ALL SELECT *, 1 FROM d WHERE family = 5)
SELECT doc_id * 2 + again AS seq,
  CASE family WHEN 3 THEN 'zero_length' WHEN 4 THEN 'rogue_file' ELSE 'ok' END AS outcome,
  CASE WHEN family = 0 OR family = 5 AND again = 0 THEN 'MOVE' WHEN family = 1 THEN 'REPLACE'
    WHEN family IN (2, 5) THEN 'DISCARD' WHEN family = 3 THEN 'ZERO_LENGTH' END AS action,
  CASE family WHEN 3 THEN 'ingress/' ELSE 'local/' END || place AS new_source,
  'local/' || place AS target_path  -- where it would go, also of a message that is refused
FROM m""",
    "ingest_stream_families": f"""
WITH d AS (
  SELECT doc_id, lang, doc_id % 6 AS family, {FAMILY_PATH} AS place, md5({FAMILY_BODY}) AS md5 FROM documents)
SELECT 'row' AS what, 'local/' || place AS place, md5,
  CASE family WHEN 2 THEN lang || ',stored' WHEN 4 THEN 'stored' ELSE lang END AS tags, family IN (2, 4) AS old
FROM d WHERE family <> 3
UNION ALL SELECT 'file', 'local/' || place, md5, NULL, NULL FROM d WHERE family <> 3
UNION ALL SELECT 'file', 'ingress/' || place, md5, NULL, NULL FROM d WHERE family IN (3, 4)""",
}
