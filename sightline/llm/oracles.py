"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

WARC = """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS low FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform([1, 11, 21, 31], lambda i: translate(
    to_base(('0x' || h[i : i + 9])::BIGINT, 32, 8),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest,
  CASE WHEN page_id = low OR low IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM low THEN low END AS refers_to
FROM f
"""

URLS = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
-- No page of these tables has a canonical link or a refresh, so no page takes a verdict from another.
SELECT page_id, host, path,
  (SELECT max_by(h || p, length(h || p)) FROM r
   WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
  coalesce((SELECT max_by(v, length(h || p)) FROM r
   WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM u
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(t) - 3, least(len(t), 1)) + 1),
    lambda i: array_to_string(t[i : i + 3], ' ')))) AS g FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id,
  d.doc_id = min(r.root) AS kept
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS t FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.t, c.t)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS text_chars,
    length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) AS role_chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  -- A turn is ### role: (line end) text </turn> (line end), of which 14 characters are fixed.
  sum(14 + role_chars + text_chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _licences() -> str:
    from sightline.llm import licences

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def chain(inner: str) -> str:
        inner = f"translate(translate({inner}, chr(133) || chr(8232) || chr(8233), '   '), {quoted(_UPPER)}, {quoted(_UPPER.lower())})"
        steps = [(r"\r\n?", r"\n"), (licences._COPYRIGHT, ""), (licences._NOT_WORD, " ")]
        steps += [(rf"\b{a}\b", b) for a, b in licences.SPELLINGS] + [(licences._EDGES, "")]
        for pattern, to in steps:
            inner = f"regexp_replace({inner}, {quoted(pattern)}, {'chr(10)' if to == r'\n' else quoted(to)}, 'g')"
        return inner

    whole = ", ".join(f"({quoted(t)}, {quoted(n)})" for n, t in licences.shipped())
    lines = ", ".join(f"({quoted(t)}, {quoted(n)})" for t, n in licences.NOTICES.items())
    flat = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'), ' ')"
    return f"""
WITH known AS (
  SELECT DISTINCT sha256({flat.format(chain("t"))}) AS digest, n FROM (VALUES {whole}, {lines}) AS x(t, n)
), notice AS (SELECT DISTINCT {flat.format(chain("t"))} AS line, n FROM (VALUES {lines}) AS x(t, n)),
d AS (SELECT doc_id, {chain("text")} AS lines FROM documents),
l AS (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM d),
f AS (SELECT doc_id, string_agg(DISTINCT n, ',' ORDER BY n) AS notices FROM l JOIN notice USING (line) GROUP BY doc_id),
h AS (SELECT doc_id, sha256({flat.format("lines")}) AS digest FROM d)
SELECT h.doc_id, h.digest, known.n AS license, coalesce(f.notices, '') AS notices
FROM h LEFT JOIN known USING (digest) LEFT JOIN f ON f.doc_id = h.doc_id
"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_bundles": WARC,
        "op4_licence_digests": _licences(),
        "op6_url_aliases": URLS,
        "op8_minhash_bayes": NEAR,
        "op9_topk_terms": TOPK,
        "op10_chat_events": CHAT,
    }
