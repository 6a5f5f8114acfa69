"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds one after the other; every part is compared with every entry in each."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
        a{turn} AS MATERIALIZED (
            SELECT vec_id, p, any_value(x) AS x, min(d * {entries} + e) AS best FROM (
                SELECT vec_id, p, x, e, list_sum(list_transform(range(1, w + 1),
                    lambda j: (x[j] - c[j]) * (x[j] - c[j])))::BIGINT AS d
                FROM parts JOIN c{turn} USING (p)) GROUP BY vec_id, p)""")
        if turn < rounds:
            steps.append(f"""
        c{turn + 1} AS MATERIALIZED (
            SELECT c.p, c.e, coalesce(m.x, c.c) AS c FROM c{turn} c LEFT JOIN (
                SELECT p, e, list(v ORDER BY j) AS x FROM (
                    SELECT p, best % {entries} AS e, j, floor(sum(v) / count(*))::BIGINT AS v FROM (
                        SELECT p, best, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM a{turn})
                    GROUP BY p, best % {entries}, j) GROUP BY p, e) m ON m.p = c.p AND m.e = c.e)""")
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v,
            len(embedding) // {parts} AS w
        FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, q.p, w, v[q.p * w + 1 : q.p * w + w] AS x FROM kept, (SELECT unnest(range({parts})) AS p) q),
    c0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
        WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})),
    {','.join(steps)},
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', (best % {entries})::INT), '' ORDER BY p) AS code,
            sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
    book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM c{rounds})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        digest AS codebooks_sha256 FROM coded JOIN kept USING (vec_id), book"""


def resampling(buckets: int = 10_000, seed: int = 2024, least: int = 20, percent: int = 10) -> str:
    """The check sum crc32 is worked out byte by byte for each distinct word."""
    return f"""
    WITH RECURSIVE crc_step(byte, c, k) AS (
        SELECT i, i, 0 FROM (SELECT unnest(range(256::BIGINT)) AS i)
        UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8),
    crc_table AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM crc_step WHERE k = 8),
    words AS MATERIALIZED (
        SELECT 's' AS side, doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
        FROM documents
        UNION ALL SELECT 't', NULL, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))
        FROM benchmark),
    spelt AS MATERIALIZED (SELECT DISTINCT w, hex(encode(w)) AS h FROM words),
    hashed AS MATERIALIZED (
        SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
            range(1, len(h), 2), lambda i: ('0x' || h[i : i + 1])::BIGINT)),
            lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) % {buckets} AS bucket
        FROM spelt, crc_table),
    counted AS MATERIALIZED (
        SELECT b.bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM (SELECT unnest(range({buckets})) AS bucket) b
        LEFT JOIN (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
                   FROM words JOIN hashed USING (w) GROUP BY bucket) c USING (bucket)),
    gains AS MATERIALIZED (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {buckets})::DOUBLE
            / ((s + 1)::DOUBLE * (sum(t) OVER () + {buckets})::DOUBLE)))::BIGINT AS gain FROM counted),
    weighed AS (
        SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
            ('0x' || sha256('{seed}:' || d.doc_id)[1:8])::BIGINT AS h
        FROM documents d LEFT JOIN (
            SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id) f USING (doc_id)),
    scored AS (
        SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, {percent} * count(*) OVER () // 100 AS wanted
        FROM scored WHERE n_features >= {least})
    SELECT doc_id, n_features, weight, score, CASE WHEN r <= wanted THEN r END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)"""
