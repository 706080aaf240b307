"""DuckDB SQL for the operators that SQL can express."""

OP6 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# The formatted length is that of "### ", the role, ": ", the text, "</turn>" and a line feed,
# and of a backslash for each escaped string.
OP7 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
           4 + length(role) + 2 + length(text) + 8
             + len(regexp_extract_all(role, '\\|###|:|</turn>'))
             + len(regexp_extract_all(text, '\\|###|:|</turn>')) AS chars
    FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized
GROUP BY conv_id
"""

OP8 = """
WITH hashed AS (
    SELECT doc_id,
           ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h,
           octet_length(encode(coalesce(text, ''))) AS bytes
    FROM documents
), levels AS (
    SELECT doc_id, d::INTEGER AS depth, h >> (60 - d)::INTEGER AS prefix, bytes FROM hashed, range(0, 41) t(d)
), totals AS (
    SELECT depth, prefix, sum(bytes)::BIGINT AS bytes, count(*) AS n FROM levels GROUP BY ALL
), fitting AS (
    SELECT l.doc_id, min(l.depth) AS depth
    FROM levels l JOIN totals t ON t.depth = l.depth AND t.prefix = l.prefix
    WHERE t.bytes <= 16777216 OR t.n = 1
    GROUP BY l.doc_id
)
SELECT f.doc_id,
       CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(t.prefix), f.depth, '0') END AS shard,
       f.depth,
       t.bytes AS shard_bytes,
       t.n AS shard_rows
FROM fitting f
JOIN levels l ON l.doc_id = f.doc_id AND l.depth = f.depth
JOIN totals t ON t.depth = l.depth AND t.prefix = l.prefix
"""

OP10 = """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id,
       (row_number() OVER best)::INTEGER AS rank,
       vec_id,
       score
FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""

# A table of 256 steps and one fold over the bytes make a crc32.
OP12 = r"""
WITH steps AS (
    SELECT list(c ORDER BY i) AS step
    FROM (
        SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i)
    )
), words AS (
    SELECT true AS doc, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
    UNION ALL
    SELECT false, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark
), runs AS (
    SELECT doc, id, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS feature FROM words
), counted AS (
    SELECT doc, id, feature, count(*) AS n FROM runs GROUP BY ALL
), named AS (
    SELECT DISTINCT feature FROM counted
), hashed AS (
    SELECT feature,
           xor(4294967295, list_reduce(list_prepend(4294967295, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(feature)), '..')]),
                                       lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
    FROM named, steps
), placed AS (
    SELECT doc, id, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL
), totals AS (
    SELECT bucket, sum(n) FILTER (doc) AS s, sum(n) FILTER (NOT doc) AS t FROM placed GROUP BY bucket
), whole AS (
    SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM totals
), gains AS (
    SELECT bucket,
           floor(1000 * ln((coalesce(x.t, 0) + 1)::DOUBLE * (whole.s + 10000)::DOUBLE / ((coalesce(x.s, 0) + 1)::DOUBLE * (whole.t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM totals x, whole
), weights AS (
    SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE doc GROUP BY id
), scored AS (
    SELECT w.id AS doc_id, len(w.w) >= 20 AS fit, coalesce(x.n_features, 0) AS n_features, coalesce(x.weight, 0) AS weight,
           coalesce(x.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM words w LEFT JOIN weights x ON x.id = w.id WHERE w.doc
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY fit) AS among FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 25 * among // 100 THEN place END AS rank
FROM ordered
"""

OP13 = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id, score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id,
       p.vec_id AS positive_id,
       (row_number() OVER best)::INTEGER AS rank,
       n.vec_id AS negative_id,
       p.score AS positive_score,
       n.score AS negative_score
FROM positives p
JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW best AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 3
"""

ORACLES = {
    "op6_exact_dedup": OP6,
    "op7_chat_format": OP7,
    "op8_sharding": OP8,
    "op10_top_k": OP10,
    "op12_resampling": OP12,
    "op13_hard_negatives": OP13,
}
