"""SQL for the queries of this subpackage that SQL can express, for DuckDB."""

LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz')")
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, line, place, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
          FROM documents)),
repeated AS (
    SELECT key, max(doc_id) AS largest FROM lines WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
    SELECT doc_id, line, place, coalesce(largest <> doc_id, false) AS dropped
    FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), ''))
           AS kept_sha256
FROM judged GROUP BY doc_id"""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BENCHMARK = f"""
WITH items AS (
    SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size,
           array_to_string(list_slice(words, first, first + 9), ' ') AS shown
    FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS first
          FROM items WHERE len(words) > 0)),
docs AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents),
places AS (
    SELECT doc_id, size, first, array_to_string(list_slice(words, first, first + size - 1), ' ')
               AS shown
    FROM (SELECT doc_id, size, words, unnest(range(1, len(words) - size + 2)) AS first
          FROM docs, (SELECT DISTINCT size FROM windows))),
found AS (SELECT doc_id, first, size, item_id FROM places JOIN windows USING (size, shown)),
hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(first, first + size)) AS word FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, first, first + 1), ' ') AS shown
    FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 1) + 1)) AS first
          FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.shown = y.shown AND x.doc_id < y.doc_id
    GROUP BY x.doc_id, y.doc_id),
links AS (
    SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * c >= 80 * (s.n + t.n - c)),
near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION
    SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN sizes USING (doc_id)"""

#: Rows whose components are all finite numbers, as integers.
WHOLE = """
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

HARD_NEGATIVES = f"""
WITH v AS (
    SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM ({WHOLE}) WHERE label IS NOT NULL),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id
                           ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


def _nearest(books: str) -> str:
    """Index and squared distance of each part's nearest entry."""
    return f"""
    SELECT vec_id, part, e, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
        SELECT p.vec_id, p.part, p.e, b.entry, list_sum(list_transform(
                   list_zip(p.e, b.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
        FROM parts AS p JOIN {books} AS b USING (part))
    GROUP BY vec_id, part, e"""


def _moved(books: str, near: str) -> str:
    """Entries as the floored means of their parts; unused ones stay."""
    return f"""
    SELECT part, entry, coalesce(m.e, b.e) AS e FROM {books} AS b LEFT JOIN (
        SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS e FROM (
            SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM (
                SELECT part, entry, unnest(e) AS x, generate_subscripts(e, 1) AS place
                FROM {near}) GROUP BY part, entry, place)
        GROUP BY part, entry) AS m USING (part, entry)"""


VECTOR_CODES = f"""
WITH v AS ({WHOLE}),
parts AS (SELECT vec_id, part, list_slice(e, part * w + 1, part * w + w) AS e
          FROM (SELECT vec_id, e, len(e) // 16 AS w, unnest(range(16)) AS part FROM v)),
b0 AS (SELECT part, entry, e FROM parts JOIN (
           SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v
           ORDER BY vec_id LIMIT 64) USING (vec_id)),
n0 AS ({_nearest("b0")}), b1 AS ({_moved("b0", "n0")}),
n1 AS ({_nearest("b1")}), b2 AS ({_moved("b1", "n1")}),
n2 AS ({_nearest("b2")}),
coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
           sum(d)::BIGINT AS error FROM n2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b2)
           AS codebooks_sha256
FROM coded JOIN v USING (vec_id)"""

SQL = {"op3_line_dedup": LINE_DEDUP, "op4_setsketch_neardup": NEAR_DUPLICATES,
       "op7_wu_manber": BENCHMARK, "op11_certified_negatives": HARD_NEGATIVES,
       "op13_walsh_codes": VECTOR_CODES}
