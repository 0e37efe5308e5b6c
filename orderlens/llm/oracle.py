"""DuckDB SQL twins of the operators that SQL can express."""

from __future__ import annotations

QUERIES = {
    "op3_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
            FROM documents WHERE text IS NOT NULL
        ), sized AS (
            SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM lines
        ), placed AS (
            SELECT doc_id, i, line, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS c, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
            FROM sized WHERE w > 0
        ), whole AS (
            SELECT doc_id, list(line ORDER BY p) AS content FROM placed GROUP BY doc_id
        ), runs AS (
            SELECT a.doc_id, a.i, b.i AS e, md5(array_to_string(t.content[a.p : b.p], chr(10))) AS content
            FROM placed a JOIN placed b ON b.doc_id = a.doc_id AND b.p >= a.p AND b.c - a.c + a.w >= 50
            JOIN whole t ON t.doc_id = a.doc_id
        ), ranked AS (
            SELECT doc_id, i, e, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS rank FROM runs
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, e + 1)) AS i FROM ranked WHERE rank > 1
        ), kept AS (
            SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text,
                   CAST(count(g.i) AS BIGINT) AS n_dropped
            FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
               coalesce(k.n_dropped, 0) AS n_dropped
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
    "op5_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), sized AS (
            SELECT page_id, octet_length(encode(payload)) AS n, sha256(payload) AS digest FROM payloads
        ), ranked AS (
            SELECT *, first_value(page_id) OVER same AS first_id, row_number() OVER same AS rank
            FROM sized WINDOW same AS (PARTITION BY digest ORDER BY page_id)
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND rank > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND rank > 1 THEN first_id END AS refers_to
        FROM ranked
    """,
    "op11_hard_negatives": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scores AS (
            SELECT a.k AS ak, a.vec_id AS anchor_id, y.vec_id, a.label = y.label AS same, CAST(list_dot_product(a.q, y.q) AS BIGINT) AS score
            FROM rows a JOIN rows y ON a.k <> y.k AND len(a.q) = len(y.q) WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT ak, anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, s.vec_id AS negative_id,
               p.positive_score, s.score AS negative_score
        FROM positives p JOIN scores s ON s.ak = p.ak AND NOT s.same
             AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        WINDOW best AS (PARTITION BY p.ak, p.positive_id ORDER BY s.score DESC, s.vec_id)
        QUALIFY rank <= 10
    """,
    "op12_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (SELECT lang, unnest(regexp_split_to_array(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                  FROM documents)
        ), placed AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
        ), phrases AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
            FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f) AS n FROM phrases WHERE k = 1 GROUP BY lang
        ), common AS (
            SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE f >= 10
        ), cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, len(x.w) AS cut,
                   CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS score
            FROM common c JOIN common x ON x.lang = c.lang AND x.k < c.k AND x.phrase = array_to_string(c.w[1 : x.k], ' ')
            JOIN common y ON y.lang = c.lang AND y.k = c.k - x.k AND y.phrase = array_to_string(c.w[x.k + 1 :], ' ')
        ), scored AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inner_pairs AS (
            SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM common WHERE k = 3
        ), covered AS (
            SELECT DISTINCT p.lang, p.phrase FROM inner_pairs p JOIN common c ON c.lang = p.lang AND c.phrase = p.phrase
            WHERE 100 * p.f >= 50 * c.f
        ), ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
            FROM scored s ANTI JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase
        )
        SELECT r.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
    """,
}
