"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

import string

from sensorloom.llm.secret_ledger import RULES

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
    FROM d
), e AS (SELECT rid, len(g) AS n, unnest(g) AS g FROM s),
f AS (SELECT rid, n, dense_rank() OVER (ORDER BY g) AS g FROM e),
pair AS (
    SELECT x.rid AS a, y.rid AS b FROM f x JOIN f y ON x.g = y.g AND x.rid < y.rid
    GROUP BY x.rid, y.rid, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), link AS MATERIALIZED (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(rid, other) AS (
    SELECT rid, rid FROM s UNION SELECT reach.rid, link.b FROM reach JOIN link ON link.a = reach.other
), least AS (SELECT reach.rid, min(o.doc_id) AS c FROM reach JOIN d o ON o.rid = reach.other GROUP BY reach.rid)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, least.c::BIGINT AS component_id FROM s JOIN least USING (rid)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(rank: int, rule) -> str:
    pattern = _quoted(rule.pattern)
    return f"""
    SELECT rid, {rank} AS rank, {_quoted(rule.kind)} AS kind, {rule.base} AS base, place AS start, place + length(m[i]) AS stop FROM (
        SELECT rid, m, p, i, (list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS place
        FROM (
            SELECT rid, m, p, g, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT rid, regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS p,
                    string_split_regex(t, {pattern}) AS g FROM d WHERE regexp_matches(t, {pattern})
            )
        )
    ) WHERE length(p[i]) >= {rule.at_least}"""


def _joined(condition: str) -> str:
    one = "kind || ':' || start || ':' || stop"
    return f"coalesce(string_agg({one}, ',' ORDER BY start, rank) FILTER ({condition}), '')"


SECRET_LEDGER = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_spans(i, r) for i, r in enumerate(RULES))})
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, sha256({_joined("base")}) AS base_sha256,
    {_joined("kind IS NOT NULL")} AS spans, sha256(d.t) AS blob_id
FROM d LEFT JOIN found USING (rid) GROUP BY d.rid, d.doc_id, d.t
"""

WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, url, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS least FROM k)
SELECT page_id, payload_bytes, payload_digest, url, true AS valid,
    CASE WHEN least <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN least <> page_id THEN least END AS refers_to
FROM r
"""

WORDS = rf"regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WINNOWING = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda s: array_to_string(w[s:s + m - 1], ' '))) AS g
    FROM (SELECT *, least(len(w), 10) AS m FROM i WHERE len(w) > 0)
), dw AS (
    SELECT rid, m, unnest(range(1, len(w) - m + 2)) AS s,
        unnest(list_transform(range(1, len(w) - m + 2), lambda s: array_to_string(w[s:s + m - 1], ' '))) AS g
    FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m
), hit AS (SELECT rid, m, s, item_id FROM dw JOIN iw USING (m, g)), places AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(s, s + m)) AS p FROM hit) GROUP BY rid
), items AS (
    SELECT rid, count(*) AS n, sha256(string_agg(id, ',' ORDER BY id)) AS h
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(places.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
    coalesce(items.h, sha256('')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""

def _ngrams(size: int) -> str:
    return f"""SELECT lang, array_to_string(w[i:i + {size - 1}], ' ') AS p, count(*) AS f FROM (
        SELECT lang, w, unnest(range(1, len(w) - {size - 2})) AS i FROM pieces WHERE len(w) >= {size}) GROUP BY ALL"""


COLLOCATIONS = rf"""
WITH cut AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOW}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM cut),
one AS ({_ngrams(1)}), two AS ({_ngrams(2)}), three AS ({_ngrams(3)}),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
often2 AS (SELECT *, string_split(p, ' ') AS w FROM two WHERE f >= 10),
often3 AS (SELECT *, string_split(p, ' ') AS w FROM three WHERE f >= 10),
cuts AS (
    SELECT c.lang, c.p, c.f AS a, 1 AS k, x.f AS l, y.f AS r FROM often2 c
    JOIN one x ON x.lang = c.lang AND x.p = c.w[1] JOIN one y ON y.lang = c.lang AND y.p = c.w[2]
    UNION ALL SELECT c.lang, c.p, c.f, 1, x.f, y.f FROM often3 c
    JOIN one x ON x.lang = c.lang AND x.p = c.w[1]
    JOIN often2 y ON y.lang = c.lang AND y.p = array_to_string(c.w[2:3], ' ')
    UNION ALL SELECT c.lang, c.p, c.f, 2, x.f, y.f FROM often3 c
    JOIN often2 x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:2], ' ')
    JOIN one y ON y.lang = c.lang AND y.p = c.w[3]
), scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
low AS (SELECT lang, p, a, arg_min(l, score * 2 + k - 1) AS l, arg_min(r, score * 2 + k - 1) AS r, min(score) AS score
    FROM scored GROUP BY lang, p, a),
covered AS (
    SELECT DISTINCT b.lang, b.p FROM often2 b JOIN (
        SELECT lang, f, array_to_string(w[1:2], ' ') AS p FROM often3
        UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM often3
    ) c ON c.lang = b.lang AND c.p = b.p AND 100 * c.f >= 50 * b.f
), ranked AS (
    SELECT low.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p ASC) AS rank
    FROM low ANTI JOIN covered USING (lang, p)
)
SELECT lang, rank::BIGINT AS rank, p AS phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

HISTOGRAM_TOPK = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
    SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON c.rid <> q.rid AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

LLM_ORACLE: dict[str, str] = {
    "op1_ngram_join": NGRAM_JOIN,
    "op2_secret_ledger": SECRET_LEDGER,
    "op8_warc_dictionary": WARC,
    "op9_winnowing": WINNOWING,
    "op11_collocation_tiles": COLLOCATIONS,
    "op12_histogram_topk": HISTOGRAM_TOPK,
}
