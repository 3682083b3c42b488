"""DuckDB SQL for the queries of this subpackage that SQL can express."""

SQL: dict[str, str] = {}

_NOISE = "0123456789#$%&*+/<=>@[]^_{|}~"

SQL["op4_mixing"] = rf"""
WITH docs AS (
    SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::UBIGINT
             + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
        / (CASE WHEN length(text) > 0
            THEN length(translate(text, '{_NOISE}', ''))::DOUBLE / length(text)::DOUBLE + 0.5
            ELSE 0.5 END)::DOUBLE AS key
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
),
weighed AS (
    SELECT *, 3 * source_size AS cap,
        1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sources
),
reached AS (
    SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER before, 0) * weight
            + cap * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))
            <= sum(source_size) OVER () * weight AS capped
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight::DOUBLE, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
    SELECT source, source_size,
        CASE WHEN capped THEN cap::DOUBLE ELSE
            (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
            / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE * weight::DOUBLE
        END AS target
    FROM reached
),
epochs AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
    FROM targets
)
SELECT d.doc_id, d.size::BIGINT AS size, e.source_size, e.target,
    (d.size * (e.epochs + CASE WHEN d.size > 0 AND
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE
        <= e.target - e.epochs * e.source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source
"""

_WORDS = r"""
words AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
)"""

SQL["op9_minhash"] = rf"""
WITH RECURSIVE {_WORDS},
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2),
            lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
    FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * c >= 80 * (x.n + y.n - c)
),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION
    SELECT reach.doc_id, either.b FROM reach JOIN either ON reach.other = either.a
)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.other) AS component_id,
    s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.n
"""

SQL["op6_warc"] = """
WITH plain AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
        sha256(coalesce(html, '')) AS digest
    FROM pages
),
first AS (SELECT digest, min(page_id) AS first FROM plain WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM plain p LEFT JOIN first f ON p.digest = f.digest
"""

SQL["op10_lattice"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(d.n), 0)::BIGINT AS n_links,
    min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reach r LEFT JOIN degree d ON r.vec_id = d.a GROUP BY r.vec_id
"""

SQL["op11_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding::DOUBLE[], lambda c: floor(256 * c)) AS x,
        CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_dot_product(a.x, b.x)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id
    )::INTEGER AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

SQL["op13_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
        (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
        replace(replace(replace(coalesce(text, ''), '\', '\\'), '<turn:', '\<turn:'),
            '</turn>', '\</turn>') AS body,
        replace(replace(replace(replace(coalesce(role, ''), '\', '\\'), '<turn:', '\<turn:'),
            '</turn>', '\</turn>'), '>', '\>') AS head
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<turn:' || head || '>' || body || '</turn>') + 2)::BIGINT AS formatted_chars
FROM given GROUP BY conv_id
"""
