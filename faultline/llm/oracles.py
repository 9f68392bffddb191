"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from faultline.llm.license_scan import KNOWN
from faultline.llm.license_texts import RULES
from faultline.llm.line_dedup import UPPER

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{UPPER.lower()}') AS key FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
    SELECT k.*, f.first_doc IS NOT NULL AND k.doc_id <> f.first_doc AS dropped FROM keyed k LEFT JOIN firsts f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), placed AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 6) AS sizes(k) WHERE len(w) >= k
), counted AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
    SELECT lang, phrase, k AS size, string_split(phrase, ' ') AS w, f AS a FROM counted WHERE k > 1
), cuts AS (
    SELECT c.*, cut FROM candidates c, range(1, 5) AS cuts(cut) WHERE cut < size
), scored AS (
    SELECT c.lang, c.phrase, c.size, c.a, cut, l.f AS l, r.f AS r, n,
           (1000::HUGEINT * c.a * n::HUGEINT) // (l.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(w[:cut], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, a, array_to_string(w[s:s + m - 1], ' ') AS phrase
    FROM candidates, range(2, 5) AS shorter(m), range(1, 5) AS starts(s) WHERE m < size AND s + m - 1 <= size
), kept AS (
    SELECT * FROM lowest x WHERE NOT EXISTS (
        SELECT 1 FROM inner_phrases i WHERE i.lang = x.lang AND i.phrase = x.phrase AND 100 * i.a >= 100 * x.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def license_scan() -> str:
    """Known sentences and rules as tables; each rule rewrites the identifiers left by the one before."""
    known = ", ".join(f"('{text}', '{name}')" for text, name in KNOWN.items())
    rules = ", ".join(f"({k}, '{name}', '|{'|'.join(parts)}|')" for k, (name, parts) in enumerate(RULES))
    return f"""
WITH RECURSIVE known(sentence, name) AS (VALUES {known}),
rules(k, license, pattern) AS (VALUES {rules}),
units AS (
    SELECT doc_id, 0 AS kind, unnest(parts) AS unit, generate_subscripts(parts, 1) AS pos FROM (
        SELECT doc_id, string_split_regex(text, '[.!?]+[' || {SPACE} || ']+|\n[' || {SPACE} || ']*\n') AS parts FROM documents)
    UNION ALL
    SELECT doc_id, 1, unnest(parts), generate_subscripts(parts, 1) FROM (
        SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
), found AS (
    SELECT doc_id, kind, name, pos FROM units
    JOIN known ON trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')) = sentence
), kept AS (
    SELECT doc_id, kind, name, pos FROM found WHERE kind = 0
    UNION ALL
    SELECT doc_id, 1, name, min(pos) FROM found f WHERE kind = 1
      AND NOT EXISTS (FROM found s WHERE s.doc_id = f.doc_id AND s.kind = 0 AND s.name = f.name) GROUP BY doc_id, name
), start AS (
    SELECT doc_id, string_agg(name, ' ' ORDER BY kind, pos) AS sentence_ids,
           '|' || string_agg(name, '|' ORDER BY kind, pos) || '|' AS rest FROM kept GROUP BY doc_id
), steps AS (
    SELECT doc_id, 0 AS k, rest, CAST(NULL AS VARCHAR) AS license FROM start
    UNION ALL
    SELECT doc_id, s.k + 1, replace(rest, pattern, '|'), CASE WHEN contains(rest, pattern) THEN r.license END
    FROM steps s JOIN rules r ON r.k = s.k
)
SELECT doc_id, coalesce(string_agg(DISTINCT license, ' ' ORDER BY license), '') AS licenses, any_value(sentence_ids) AS sentence_ids
FROM steps JOIN start USING (doc_id) GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": LINE_DEDUP, "op7_license_scan": license_scan(), "op9_top_k": TOP_K, "op11_collocations": COLLOCATIONS}
