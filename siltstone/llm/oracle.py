"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

ORACLE = {
    "op4_chat": r"""
WITH given AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
    SELECT *, '<|turn|>' || role || '<|text|>' || regexp_replace(regexp_replace(replace(text, '\', '\\'),
        '<(\||/?s>|/?<SYS>>|</SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') || '<|end|>' AS formatted
    FROM given)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id""",
    "op6_jaccard": rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))) END AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)""",
    "op8_nearest": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20""",
    "op10_substrings": rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
    SELECT doc_id, i, md5(list_aggregate(w[i:i + 34], 'string_agg', ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN again USING (h))),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""",
    "op11_search": r"""
WITH given AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS length FROM given WHERE len(w) > 0),
held AS (SELECT r, doc_id, len(w) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS t FROM given) GROUP BY r, doc_id, len(w), t),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
weights AS (
    SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM held, sizes GROUP BY t, n_docs),
scored AS (
    SELECT item_id, r, doc_id,
        CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // length)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (t) JOIN held USING (t), sizes GROUP BY item_id, r, doc_id),
places AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 50""",
    "op12_phrases": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, range(1, 6) AS s(k) WHERE len(w) >= k)),
often AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
scored AS (
    SELECT c.lang, c.phrase, k, a, x.f AS l, y.f AS r, n, cut,
        CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN (SELECT lang, phrase, f FROM often) x ON x.lang = c.lang AND x.phrase = array_to_string(w[:cut], ' ')
    JOIN (SELECT lang, phrase, f FROM often) y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored),
kept AS (
    SELECT * FROM lowest c WHERE place = 1 AND NOT EXISTS (
        SELECT 1 FROM often o WHERE o.lang = c.lang AND o.k > c.k AND o.f >= c.a AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
