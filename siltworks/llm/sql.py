"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Lower-casing only A to Z.
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op2_decontaminate"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id,
        regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id,
        regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), items AS (
    SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), seen AS (
    SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (
        SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n
    )
), hits AS (
    SELECT seen.k, seen.i, seen.n, item_id FROM seen JOIN windows USING (n, s)
), hit_words AS (
    SELECT k, count(DISTINCT p) AS n_hit
    FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k
), hit_items AS (
    SELECT k, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (k) LEFT JOIN hit_items USING (k)
"""

ORACLE["op3_host_rules"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS (
    SELECT k, i, hash(s) AS h, s
    FROM (
        SELECT k, i, array_to_string(w[i : i + 7], ' ') AS s
        FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
    )
), repeats AS (
    SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS c FROM windows) WHERE c > 1
), covered AS (
    SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM repeats) GROUP BY k
), lines AS (
    SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), m AS (
    SELECT k, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words
    FROM d JOIN lines USING (k) LEFT JOIN covered USING (k)
), f AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), hosts AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS bad
    FROM f WHERE source IS NOT NULL GROUP BY source
), several AS (
    SELECT n, bad / n AS rate, n / sum(n) OVER () AS w, sum(bad) OVER () / sum(n) OVER () AS mean
    FROM hosts WHERE n > 1
), moments AS (
    SELECT any_value(mean) * (1 - any_value(mean)) AS v, sum(w * power(rate - mean, 2)) AS spread,
        sum(w * (1 - w) / n) AS noise, sum(w * (1 - w)) AS whole
    FROM several
), correlation AS (
    SELECT CASE WHEN v > 0 AND spread > v * noise THEN (spread / v - noise) / (whole - noise) END AS rho
    FROM moments
), prior AS (
    SELECT CASE WHEN rho IS NULL THEN 1000 ELSE least(greatest(1 / rho - 1, 1.0), 1000.0) END AS s,
        (SELECT sum(bad) / sum(n) FROM hosts) AS mean
    FROM correlation
), bad_hosts AS (
    SELECT source FROM hosts, prior
    WHERE (bad + mean * s) / (n + s) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    bad_hosts.source IS NULL AS host_kept,
    NOT base_failed AND bad_hosts.source IS NULL AS kept
FROM f LEFT JOIN bad_hosts ON f.source = bad_hosts.source
"""

ORACLE["op7_repeats"] = """
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT k, doc_id, i, substr(h, 2 * i + 1, 200) AS s
    FROM (SELECT k, doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)
), repeated AS (
    SELECT k, i FROM (
        SELECT k, i, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, k, i) AS n FROM windows
    ) WHERE n > 1
), marked AS (
    SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM repeated
), numbered AS (
    SELECT k, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END)
        OVER (PARTITION BY k ORDER BY i) AS run
    FROM marked
), runs AS (
    SELECT k, run, min(i) AS start, max(i) + 100 AS stop FROM numbered GROUP BY k, run
), pieces AS (
    SELECT k, coalesce(lag(stop) OVER (PARTITION BY k ORDER BY start), 0) AS a, start AS b FROM runs
    UNION ALL SELECT k, max(stop), NULL FROM runs GROUP BY k
), kept AS (
    SELECT k, string_agg(substr(h, 2 * a + 1, coalesce(2 * (b - a), len(h))), '' ORDER BY a) AS h
    FROM pieces JOIN d USING (k) GROUP BY k
), sums AS (
    SELECT k, sum(stop - start) AS n_removed, count(*) AS n_spans FROM runs GROUP BY k
)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes,
    CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (k) LEFT JOIN kept USING (k)
"""

# crc32 of a number's decimal digits, bit by bit.
_CRC32 = (
    "xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), "
    "lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
    "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"
)

ORACLE["op11_prefix_trie"] = rf"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), opened AS (
    SELECT *, {_CRC32.format("conv_id")} % 4 AS h FROM own
), told AS (
    SELECT o.conv_id, coalesce(b.turns[1 : h], []) || o.turns[h + 1 :] AS turns
    FROM opened AS o LEFT JOIN own AS b ON b.conv_id = o.conv_id - o.conv_id % 20
), paths AS (
    SELECT conv_id, size, depth, turns[1 : depth] AS path
    FROM (SELECT conv_id, turns, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth FROM told)
), nodes AS (
    SELECT row_number() OVER () AS k, * FROM (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = depth AS leaf,
            CASE WHEN depth = 0 THEN 0
                ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS words,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends
        FROM paths GROUP BY depth, path
    )
), places AS (
    SELECT k, p.conv_id, p.depth FROM paths AS p JOIN nodes AS n ON p.depth = n.depth AND p.path = n.path
), subtrees AS (
    SELECT p.k, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM places AS p JOIN nodes AS n ON n.conv_id = p.conv_id AND n.depth >= p.depth GROUP BY p.k
), children AS (
    SELECT depth - 1 AS depth, path[1 : depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
    n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes AS n JOIN subtrees USING (k)
    LEFT JOIN children AS c ON c.depth = n.depth AND c.path = n.path
    LEFT JOIN nodes AS u ON u.depth = n.depth - 1 AND u.path = n.path[1 : n.depth - 1]
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (
    SELECT row_number() OVER () AS k, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.k AS anchor, a.vec_id AS anchor_id, c.k, c.vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
    FROM v AS a JOIN v AS c ON a.k <> c.k
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor, anchor_id, k AS positive, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, k) <= 5
)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id NULLS LAST, k) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives AS p JOIN scored AS s ON s.anchor = p.anchor AND NOT same
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def all_sql() -> dict[str, str]:
    return dict(ORACLE)
