"""SQL that must give the same rows as some of the queries, for DuckDB.

Language labels, piece encoding, fingerprints and license alignment have none: SQL has
no Viterbi search, random walk or patience alignment.  Their tests use brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def _low(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(rows: str, id: str, text: str) -> str:
    """Rows (id, i, word, n): each word of each text and the number of words."""
    return f"""
      SELECT id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, len(ws) AS n
      FROM (SELECT {id} AS id, regexp_extract_all(coalesce({text}, ''), '{WORD}') AS ws FROM {rows})"""


def _runs(words: str, k: str) -> str:
    """Rows (id, s): runs of k words."""
    return f"""
      SELECT id, s FROM (
        SELECT id, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS c
        FROM {words} WINDOW f AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {k} - 1 FOLLOWING))
      WHERE c = {k}"""


def _shingles(words: str, k: int) -> str:
    """Distinct runs of k words, or all words of a shorter text."""
    return f"""
      SELECT DISTINCT id, s FROM ({_runs(words, str(k))})
      UNION SELECT id, string_agg(word, ' ' ORDER BY i) FROM {words} WHERE n < {k} GROUP BY id"""


OP4 = f"""
WITH RECURSIVE w AS ({_words("documents", "doc_id", _low("text"))}),
sh AS ({_shingles("w", 4)}),
n AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
x AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
e AS (
  SELECT a, b FROM x JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, c) AS (SELECT id, id FROM n UNION SELECT b, c FROM reach JOIN both_ways ON id = a),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id,
  coalesce(c, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n ON n.id = doc_id LEFT JOIN least ON least.id = doc_id"""

OP6 = f"""
WITH w AS ({_words("documents", "doc_id", "text")}),
e AS (
  SELECT id, i, word, CASE WHEN count(*) OVER f = 20 THEN string_agg(word, ' ') OVER f END AS edge
  FROM w WINDOW f AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (
  SELECT *, edge IS NOT NULL AND row_number() OVER (PARTITION BY edge ORDER BY id, i) > 1 AS again FROM e),
g AS (
  SELECT *, bool_or(again) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM r),
d AS (
  SELECT id, count(*) AS n, count(*) FILTER (gone) AS m, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS t
  FROM g GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(m, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents LEFT JOIN d ON d.id = doc_id"""

OP7 = """
WITH b AS (
  SELECT doc_id AS id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
p AS (SELECT id, h, n, unnest(range(0, n)) AS i FROM b),
s AS (
  SELECT id, i, substr(h, 2 * i + 1, 2) AS byte, CASE WHEN i + 50 <= n THEN substr(h, 2 * i + 1, 100) END AS s
  FROM p),
r AS (SELECT *, s IS NOT NULL AND min(id) OVER (PARTITION BY s) < id AS again FROM s),
g AS (
  SELECT *, bool_or(again) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM r),
k AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY id ORDER BY i), false) AS head FROM g),
d AS (
  SELECT id, count(*) FILTER (gone) AS m, count(*) FILTER (head) AS k,
    string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS t
  FROM k GROUP BY id)
SELECT b.id AS doc_id, n AS n_bytes, coalesce(m, 0) AS n_removed, coalesce(k, 0) AS n_spans,
  sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM b LEFT JOIN d ON d.id = b.id"""

OP8 = f"""
WITH dw AS ({_words("documents", "doc_id", _low("text"))}),
iw AS ({_words("benchmark", "item_id", _low("text"))}),
items AS (SELECT DISTINCT id AS item, least(n, 5) AS k FROM iw),
ish AS ({_shingles("iw", 5)}),
isz AS (SELECT id AS item, count(*) AS n FROM ish GROUP BY id),
dsh AS (
  SELECT DISTINCT id, s, 5 AS k FROM ({_runs("dw", "5")})
  {"".join(f"UNION SELECT id, s, {k} FROM ({_runs('dw', str(k))}) WHERE {k} IN (SELECT k FROM items) " for k in range(1, 5))})
SELECT d.id AS doc_id, item AS item_id, count(*) AS shared, any_value(n) AS item_shingles,
  count(*) / any_value(n) AS containment
FROM dsh d JOIN ish i USING (s) JOIN items ON items.item = i.id AND items.k = d.k JOIN isz USING (item)
GROUP BY d.id, item HAVING 100 * count(*) >= 80 * any_value(n)"""

_RULES = "('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')"
# Without a rule the verdict is that of the aliases; the given pages have no links to aliases.
OP9 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, {_low("regexp_extract(coalesce(rest, ''), '^[^/?#]*')")} AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (
  SELECT page_id, arg_max(r.host || r.path, (len(r.host || r.path), r.verdict = 'allow')) AS rule,
    arg_max(r.verdict, (len(r.host || r.path), r.verdict = 'allow')) AS verdict
  FROM h JOIN (VALUES {_RULES}) r(verdict, host, path)
    ON (h.host = r.host OR suffix(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
  GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)"""


def _replaced(text: str, pairs) -> str:
    for a, b in pairs:
        text = f"replace({text}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return text


def _sha1(text: str) -> str:
    return f"""'sha1:' || array_to_string(list_transform(range(0, 32), lambda x: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(sha1({text}), (x // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (x % 4))) & 31) + 1)::INT, 1)), '')"""


def _uuid(text: str) -> str:
    h = f"md5({text})"
    return f"""'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3)
      || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'"""


def warc_sql(hidden: str, line_tags: str, tags: str, entities) -> str:
    text = f"regexp_replace(regexp_replace(regexp_replace(html, '{hidden}', ' ', 'g'), '{line_tags}', chr(10), 'g'), '{tags}', '', 'g')"
    text = f"regexp_replace(regexp_replace({_replaced(text, entities)}, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    text = f"regexp_replace({text}, '\\A[ \\n]+|[ \\n]+\\z', '', 'g')"
    size = "octet_length(encode(html))::VARCHAR"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
r AS (
  SELECT page_id, url, html, {_uuid("'response' || chr(10) || coalesce(page_id::VARCHAR, '') || chr(10) || coalesce(url, '')")} AS refers_to,
    {_sha1("html")} AS source_digest,
    regexp_replace(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title', 1), '[\\r\\n]+', ' ', 'g') AS title,
    regexp_extract(html, '(?is)<html\\b[^>]*?\\slang=["'']?([A-Za-z0-9-]+)', 1) AS lang,
    regexp_extract_all(html, '(?is)<a\\b[^>]*?\\shref=["'']([^"''\\r\\n]*)["'']', 1) AS links
  FROM p),
k AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS type, concat_ws(chr(13) || chr(10),
      'source-http: HTTP/1.1 200 OK' || chr(13) || chr(10) || 'source-http: Content-Type: text/html; charset=utf-8'
        || chr(13) || chr(10) || 'source-http: Content-Length: ' || {size},
      'source-payload-digest: ' || source_digest, 'source-payload-length: ' || {size},
      CASE WHEN title != '' THEN 'title: ' || title END, CASE WHEN lang != '' THEN 'language: ' || lang END,
      CASE WHEN len(links) > 0 THEN array_to_string(list_transform(links, lambda x: 'outlink: ' || x), chr(13) || chr(10)) END
    ) AS block FROM r
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', {text} FROM r),
d AS (
  SELECT *, {_uuid("warc_type || chr(10) || refers_to || chr(10) || source_digest")} AS record_id,
    {_sha1("block")} AS block_digest, octet_length(encode(block)) AS content_length FROM k)
SELECT page_id, warc_type, record_id, refers_to, url AS target_uri, source_digest, block_digest, content_length,
  concat_ws(chr(13) || chr(10), 'WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || record_id,
    'WARC-Refers-To: ' || refers_to, 'WARC-Target-URI: ' || url, 'WARC-Date: 1970-01-01T00:00:00Z',
    'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || type,
    'Content-Length: ' || content_length::VARCHAR) AS header, block
FROM d"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; the table of steps comes from the rule of its polynomial."""
    steps = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        steps.append(n)
    of_bytes = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    step = f"xor(c >> 8, ({steps}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({of_bytes}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


def _field(value: str) -> str:
    value = f"{value}::VARCHAR"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _record(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _tree(leaves: str) -> str:
    """Rows (t, lev, idx, n, h) of all nodes over leaves of the same columns at level 0."""
    return f"""
      SELECT * FROM {leaves}
      UNION ALL
      SELECT t, lev + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx))
      FROM {{0}} WHERE n > 1 GROUP BY t, lev, idx // 8"""


OP11 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS t, {_record("text")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_record(_low("text"))} ELSE {_record("text")} END AS now
  FROM documents),
l AS (
  SELECT t, 0::BIGINT AS lev, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY t) AS n, leaf AS h, doc_id, now FROM d),
l0 AS (SELECT t, lev, idx, n, h FROM l),
nodes AS ({_tree("l0").format("nodes")}),
sub AS (SELECT t, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS place, count(*) OVER () AS groups FROM nodes WHERE n = 1),
u0 AS (SELECT '' AS t, 0::BIGINT AS lev, place AS idx, groups AS n, subroot AS h FROM sub),
upper AS ({_tree("u0").format("upper")}),
depth AS (SELECT t, max(lev) AS levels FROM nodes GROUP BY t),
steps AS (
  SELECT l.t, l.idx, l.h AS leaf, s.lev,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < l.idx // (8 ** s.lev)::BIGINT), '') AS before,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > l.idx // (8 ** s.lev)::BIGINT), '') AS after
  FROM l JOIN nodes s ON s.t = l.t AND s.n > 1 AND s.idx // 8 = l.idx // (8 ** (s.lev + 1))::BIGINT
  GROUP BY ALL
  UNION ALL
  SELECT l.t, l.idx, l.h, levels + s.lev,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < place // (8 ** s.lev)::BIGINT), ''),
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > place // (8 ** s.lev)::BIGINT), '')
  FROM l JOIN sub USING (t) JOIN depth USING (t) JOIN upper s ON s.n > 1 AND s.idx // 8 = place // (8 ** (s.lev + 1))::BIGINT
  GROUP BY ALL),
proof AS (SELECT t, idx, sha256(string_agg(before || after, '' ORDER BY lev)) AS proof, max(lev) + 1 AS levels FROM steps GROUP BY t, idx),
folded AS (
  SELECT t, idx, 0::BIGINT AS lev, now AS h FROM l
  UNION ALL
  SELECT f.t, f.idx, f.lev + 1, sha256(before || f.h || after) FROM folded f JOIN steps s ON s.t = f.t AND s.idx = f.idx AND s.lev = f.lev),
ended AS (SELECT t, idx, arg_max(h, lev) AS h FROM folded GROUP BY t, idx)
SELECT doc_id, l.h AS leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, ended.h AS folded_root, ended.h = root AS verified
FROM l JOIN sub USING (t) JOIN ended ON ended.t = l.t AND ended.idx = l.idx
  LEFT JOIN proof ON proof.t = l.t AND proof.idx = l.idx, (SELECT h AS root FROM upper WHERE n = 1)"""

_LETTERS = r"[A-Za-z\x{C0}-\x{FF}]+"
OP12 = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, {_low("unnest(regexp_extract_all(coalesce(text, ''), '" + _LETTERS + "'))")} AS run FROM documents),
o AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS own, run, count(*) AS times FROM r GROUP BY ALL),
h AS (SELECT run, times, {_crc32("own")} AS h FROM o),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run)) + 2) ELSE run END AS word, times
  FROM h),
w AS (SELECT word, sum(times)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pair AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word != b.word
  UNION SELECT c.word, w.word FROM cut c JOIN w ON w.word = c.less
  UNION SELECT w.word, c.word FROM cut c JOIN w ON w.word = c.less),
near AS (
  SELECT x AS word, count(*) AS n_near, arg_min(struct_pack(word := y, n := b.n), (-b.n, y)) AS best
  FROM pair JOIN w b ON b.word = y GROUP BY x),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * w.n THEN best.word END AS form,
    CASE WHEN best.n >= 10 * w.n THEN best.n END AS form_n
  FROM w LEFT JOIN near ON near.word = w.word),
step AS (
  SELECT word, word AS root, 0 AS k FROM f
  UNION ALL SELECT s.word, f.form, k + 1 FROM step s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, k) AS root FROM step GROUP BY word) s ON s.word = f.word"""

OP13 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
x AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT b, c FROM reach JOIN x ON id = a),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM x GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.id = vec_id"""
