"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, length(regexp_replace(replace(text, '\', '\\'),
        '([<\[])(s>|/s>|/?INST\]|OUT\]|SAYS\]|/?SYS\]|/?TURN\])', '\1\\\2', 'g')) AS n_text,
        length(regexp_replace(replace(role, '\', '\\'),
        '([<\[])(s>|/s>|/?INST\]|OUT\]|SAYS\]|/?SYS\]|/?TURN\])', '\1\\\2', 'g')) AS n_role,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
        lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(n_text + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
        ELSE n_role + 23 END))::BIGINT AS formatted_chars,
    bool_and(CASE role
        WHEN 'system' THEN before IS NULL
        WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
        WHEN 'assistant' THEN before IS NOT NULL AND before = 'user'
        ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM marked GROUP BY conv_id
"""

OP3 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), d AS (
    SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
        max(page_id) OVER (PARTITION BY payload) AS keeper FROM p
), r AS (SELECT *, payload_bytes >= 1000 AND page_id <> keeper AS again FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN keeper END AS refers_to
FROM r
"""

_HOST = "CASE WHEN strpos(u, '://') > 0 THEN regexp_extract(substr(u, strpos(u, '://') + 3), '^[^/?#]*') ELSE '' END"
_PATH = "CASE WHEN strpos(u, '://') > 0 THEN regexp_extract(substr(u, strpos(u, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_JUDGED = f"""
    SELECT *, CASE
        WHEN fits('example.com', host) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN fits('example.net', host) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN fits('org', host) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN fits('net', host) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM (SELECT *, {_LOWER.format(f"coalesce({_HOST}, '')")} AS host, coalesce({_PATH}, '') AS path FROM given)
"""
for _name in ("example.com", "example.net", "org", "net"):
    _JUDGED = _JUDGED.replace(f"fits('{_name}', host)", f"(host = '{_name}' OR ends_with(host, '.{_name}'))")

OP4 = rf"""
WITH RECURSIVE page AS (
    SELECT page_id, url AS u, CASE WHEN strpos(url, '://') > 0 THEN regexp_replace(url, '#.*$', '', 's') END AS node,
        regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
            '(?i)\bhref\s*=\s*["'']?([^"''>\s]*)', 1) AS link,
        regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
            '(?i)\burl\s*=\s*["'']?([^"''>\s]*)', 1) AS refresh
    FROM pages
), target AS (
    SELECT node AS a, u, unnest([link, refresh]) AS t FROM page
), absolute AS (
    SELECT a, CASE WHEN strpos(t, '://') > 0 THEN t
        WHEN starts_with(t, '//') THEN split_part(u, '//', 1) || t
        WHEN starts_with(t, '/') THEN regexp_extract(u, '^(.*?://[^/?#]*)', 1, 's') || t END AS b
    FROM (SELECT a, u, replace(trim(t), '&amp;', '&') AS t FROM target)
), edge AS (
    SELECT node AS a, regexp_replace(regexp_replace(node,
        '[?&](?:utm_[a-z]+|ref|gclid|fbclid)=[^&#]*', '', 'g'), '^([^?&]*)&', '\1?') AS b FROM page
    UNION SELECT a, regexp_replace(b, '#.*$', '', 's') FROM absolute WHERE strpos(b, '://') > 0
), sides AS (
    SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b
), node_rule AS (
    SELECT u, rule FROM ({_JUDGED.replace("given", "(SELECT DISTINCT a AS u FROM sides)")})
), reached AS (
    SELECT u FROM node_rule WHERE rule IN ('net/', 'example.com/de/')
    UNION SELECT sides.b FROM reached JOIN sides ON sides.a = reached.u
), judged AS ({_JUDGED.replace("given", "page")})
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NULL AND node IN (SELECT u FROM reached) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP10 = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, size, list_slice(w, pos, pos + size - 1) AS words
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos
          FROM (SELECT *, least(10, len(w)) AS size FROM item WHERE len(w) > 0))
), doc AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
dw AS (
    SELECT row, pos, size, list_slice(w, pos, pos + size - 1) AS words
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos
          FROM doc CROSS JOIN (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)
), hit AS (SELECT row, pos, size, item_id FROM dw JOIN iw USING (size, words)),
n AS (
    SELECT row, count(DISTINCT word) AS n_hit
    FROM (SELECT row, unnest(range(pos, pos + size)) AS word FROM hit) GROUP BY row
), i AS (
    SELECT row, count(DISTINCT item_id) AS n_items,
        array_to_string(list_sort(list(DISTINCT item_id::VARCHAR) FILTER (item_id IS NOT NULL)), ',') AS ids
    FROM hit GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n USING (row) LEFT JOIN i USING (row)
"""

_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

OP11 = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS row, doc_id, lang, {_CRC32.format('doc_id')} % 3 = 1 AS held_out,
        trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) AS letters
    FROM documents
), sign AS (
    SELECT row, lang, held_out, unnest(c) AS a, generate_subscripts(c, 1) AS pos
    FROM (SELECT *, string_split(' ' || letters || ' ', '') AS c FROM doc WHERE letters <> '')
), ahead AS (
    SELECT row, lang, held_out, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c
    FROM sign WINDOW w AS (PARTITION BY row ORDER BY pos)
), gram AS (
    SELECT row, lang, held_out, a AS gram FROM ahead WHERE a <> ' '
    UNION ALL SELECT row, lang, held_out, a || b FROM ahead WHERE b IS NOT NULL
    UNION ALL SELECT row, lang, held_out, a || b || c FROM ahead WHERE b <> ' ' AND c IS NOT NULL
), text_gram AS (SELECT row, lang, held_out, gram, count(*) AS n FROM gram GROUP BY ALL),
text_profile AS (
    SELECT row, gram, row_number() OVER (PARTITION BY row ORDER BY n DESC, gram) - 1 AS rank
    FROM text_gram QUALIFY rank < 400
), lang_profile AS (
    SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS rank
    FROM (SELECT lang, gram, sum(n) AS n FROM text_gram WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL)
    QUALIFY rank < 400
), away AS (
    SELECT t.row, l.lang, sum(coalesce(abs(t.rank - p.rank), 400)) AS distance, count(*) * 400 AS most
    FROM text_profile t CROSS JOIN (SELECT DISTINCT lang FROM lang_profile) l
    LEFT JOIN lang_profile p ON p.lang = l.lang AND p.gram = t.gram GROUP BY ALL
), nearest AS (
    SELECT * FROM away QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, lang) = 1
)
SELECT doc_id, held_out, coalesce(nearest.lang, 'und') AS lang_pred,
    coalesce(1 - (distance::DOUBLE / most), 0) AS score
FROM doc LEFT JOIN nearest USING (row)
"""

OP12 = f"""
WITH item AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
doc AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
corpus AS (SELECT count(*) FILTER (len(w) > 0) AS texts, sum(len(w))::BIGINT AS terms FROM doc),
occurs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM doc)
    WHERE term IN (SELECT term FROM item) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * texts + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM occurs CROSS JOIN corpus GROUP BY term, texts),
part AS (
    SELECT row, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 *
        (10 + (90 * len(w) * texts) // terms))) AS part
    FROM occurs JOIN weight USING (term) JOIN doc USING (row) CROSS JOIN corpus
), scored AS (
    SELECT item_id, row, doc_id, sum(part)::BIGINT AS score FROM part JOIN item USING (term) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scored WHERE score > 0) WHERE rank <= 10
"""

OP13 = rf"""
WITH said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32.format('conv_id')} % 4 AS h, count(*) AS n
    FROM said GROUP BY conv_id
), conv AS (
    SELECT own.*, least(own.h, coalesce(b.n, 0)) AS taken FROM own LEFT JOIN own b ON b.conv_id = own.base
), turns AS (
    SELECT conv.conv_id, i AS depth, role, text FROM conv JOIN said ON said.conv_id = base AND i <= h
    UNION ALL
    SELECT conv_id, taken + i - h, role, text FROM conv JOIN said USING (conv_id) WHERE i > h
), path AS (
    SELECT conv_id, depth, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
            OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
        len(regexp_extract_all(text, '[^ 	-
]+')) AS words
    FROM turns UNION ALL SELECT conv_id, 0, 'root', 0 FROM conv
), linked AS (
    SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
        lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends FROM path
), node AS (
    SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent,
        count(*) AS n_convs, (count(*) - 1) * any_value(words) AS cost,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM linked GROUP BY node
), child AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY ALL),
known AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (node)),
rolled AS (
    SELECT path.node, count(*) FILTER (n_children = 0) AS n_leaves, sum(cost)::BIGINT AS saved_tokens
    FROM known JOIN path ON path.conv_id = known.conv_id AND path.depth <= known.depth GROUP BY path.node
)
SELECT known.conv_id, known.depth, up.conv_id AS parent_conv_id, known.n_convs, known.n_children,
    n_leaves, saved_tokens, known.ends_sha256
FROM known JOIN rolled USING (node) LEFT JOIN node up ON up.node = known.parent
"""

ORACLES = {
    "op1_chat_format": OP1,
    "op3_warc": OP3,
    "op4_url_filter": OP4,
    "op10_decontaminate": OP10,
    "op11_language_id": OP11,
    "op12_lexical_search": OP12,
    "op13_prefix_trie": OP13,
}
