"""The registered queries as SQL, written from their meaning rather than from the plans."""

from __future__ import annotations

# The nested bronze records and the tables the reported rows come from. The status
# steps follow row-level updates with IN and NOT IN on the whole record.
LAYERS = """
WITH line_tag AS (
    SELECT l_orderkey,
           list_sort(list(DISTINCT {'id': CAST(p_size AS BIGINT),
                                    'name': CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END})) AS genres
    FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY l_orderkey
),
record AS (
    SELECT o_orderkey AS "Id",
           CASE WHEN o_orderkey % 89 <> 0 THEN o_totalprice END AS "Budget",
           CASE WHEN o_orderkey % 83 <> 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS "RunTime",
           CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority END AS "OriginalLanguage",
           o_orderdate AS "CreatedDate",
           genres
    FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN line_tag ON l_orderkey = o_orderkey
),
copied AS (
    SELECT * FROM record UNION ALL SELECT * FROM record WHERE "Id" % 10 = 0
),
bronze AS (
    SELECT c AS value, c.* FROM copied c
),
tag AS (
    SELECT record_id, g.id AS id, g.name AS name
    FROM (SELECT "Id" AS record_id, unnest(genres) AS g FROM bronze)
),
language AS (
    SELECT row_number() OVER (ORDER BY language NULLS FIRST) AS languageid, language
    FROM (SELECT DISTINCT "OriginalLanguage" AS language FROM bronze)
),
bridge AS (
    SELECT row_number() OVER (ORDER BY record_id, id) AS moviegenreid,
           record_id AS movieid, id AS genreid
    FROM tag
),
clean AS (
    SELECT bronze.*, languageid FROM bronze JOIN language ON "OriginalLanguage" = language
    WHERE "Budget" >= 100000 AND "RunTime" >= 0
),
classified AS (
    SELECT *,
           CASE WHEN value IN (SELECT value FROM clean) THEN 'loaded'
                WHEN value NOT IN (SELECT value FROM clean) THEN 'quarantined'
                ELSE 'new' END AS status
    FROM bronze
),
repaired AS (
    SELECT value, "Id", "Budget", abs("RunTime") AS "RunTime", languageid AS "OriginalLanguage", "CreatedDate"
    FROM classified JOIN language ON "OriginalLanguage" = language
    WHERE status = 'quarantined' AND "Budget" >= 100000
    UNION ALL
    SELECT value, "Id", CAST(100000 AS DOUBLE), abs("RunTime"), languageid, "CreatedDate"
    FROM classified JOIN language ON "OriginalLanguage" = language
    WHERE status = 'quarantined' AND "Budget" < 100000
),
loaded AS (
    SELECT "Id", "Budget", "RunTime", languageid AS "OriginalLanguage", "CreatedDate" FROM clean
    UNION ALL
    SELECT "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate" FROM repaired
),
silver AS (
    SELECT DISTINCT * FROM loaded
),
repeated AS (
    SELECT value, count(*) AS copies FROM bronze GROUP BY value HAVING count(*) > 1
),
finished AS (
    SELECT * REPLACE (
        CASE WHEN value IN (SELECT value FROM repaired) THEN 'loaded'
             WHEN value IN (SELECT value FROM repeated) THEN 'loaded'
             ELSE status END AS status)
    FROM classified
)
"""

CUSTOMER_PEOPLE = """
SELECT lower(c_mktsegment) AS "FirstName",
       lower(c_name) AS "LastName",
       lower('C' || c_custkey || '@Example.com') AS "Email",
       replace('555-' || c_custkey || '-01', '-', '') AS "Phone",
       regexp_replace(lower('No.' || c_custkey || ' Elm St #' || c_nationkey || ' #'), 'no.|#', '', 'g') AS "Address"
FROM customer
"""

CHUNKED = """
WITH placed AS (
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS cnt
    FROM orders
),
slice AS (
    SELECT CAST(i AS INTEGER) AS chunk, cnt, (cnt * i) // 8 AS start, (cnt * (i + 1)) // 8 AS stop
    FROM range(8) r(i), (SELECT count(*) AS cnt FROM orders)
)
SELECT chunk, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM placed JOIN slice ON pos >= start AND pos < {stop}
GROUP BY chunk
"""

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"

PLAIN = {
    "q_json_scan": ORDERS,
    "q_json_infer": ORDERS,
    "q_landing_glob": ORDERS,
    "q_landing_stream": "SELECT *, 'orders' AS datasource, 'new' AS status FROM orders",
    "q_table_scan": "SELECT * FROM region",
    "q_sql_scan": "SELECT * FROM nation",
    "q_sink_exclude": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "q_sink_partitioned": "SELECT *, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month FROM orders",
    "q_register_table": ORDERS,
    "q_append_union": """
        SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT c_custkey, abs(c_acctbal) FROM customer WHERE c_acctbal < 0""",
    "q_self_overwrite": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "q_tsv_scan": "SELECT * FROM customer",
    "q_csv_roundtrip": """
        SELECT *, '  ' || event_type || ' "' || event_id || '", ' AS padded,
               CASE WHEN event_id % 2 = 0 THEN '  ' ELSE ',' END AS blank
        FROM events""",
    "q_split_refresh": ORDERS,
    "q_split_rows": """
        SELECT CAST(ceil(8 * pos / cnt) AS INTEGER) - 1 AS chunk, o_orderkey
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos, count(*) OVER () AS cnt
              FROM orders)""",
    "q_inventory_top": """
        SELECT 'txt' AS type, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents""",
    "q_publish_format": "SELECT * FROM nation",
    "q_publish_empty": """
        SELECT o_orderkey, o_orderstatus, 'filled' AS state FROM orders WHERE o_orderstatus = 'F'""",
    "q_unreadable": """
        SELECT CASE WHEN o_orderkey % 50 = 0
                    THEN left('{"orders":[{"o_orderkey":' || o_orderkey || ',', 20)
                    ELSE CAST(o_orderkey AS VARCHAR) END AS document
        FROM orders""",
    "q_json_split": CHUNKED.format(stop="stop"),
    "q_json_split_overlap": CHUNKED.format(stop="CASE WHEN chunk = 0 THEN stop ELSE slice.cnt END"),
    "q_document_split": """
        WITH placed AS (
            SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders
        ),
        within AS (
            SELECT o_orderkey, pos % 10000 AS place, count(*) OVER (PARTITION BY pos // 10000) AS cnt
            FROM placed
        )
        SELECT CAST(ceil(8 * (place + 1) / cnt) AS INTEGER) - 1 AS chunk, o_orderkey FROM within""",
    "q_inventory": """
        SELECT lang, 'txt' AS type, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes
        FROM documents GROUP BY lang""",
    "q_json_variant": """
        SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
            CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS state
        FROM orders""",
    "q_inventory_all": """
        SELECT 'by language/lang=' || lang AS folder, 0 AS hidden, CAST(0 AS BIGINT) AS n_empty,
            CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes
        FROM documents GROUP BY lang
        UNION ALL SELECT 'all/of/them', 0, 0, CAST(sum(strlen(text) + 1) AS BIGINT) FROM documents
        UNION ALL SELECT 'none', 0, 1, 0
        UNION ALL SELECT unnest(['by language', 'all/of/them', 'none']), 1, 1, 0""",
    "q_update_partitions": """
        SELECT o_orderkey, CASE WHEN quantity > 200 THEN 'big'
                                WHEN o_custkey = (SELECT min(o_custkey) FROM orders) THEN 'seen'
                                ELSE o_orderstatus END AS status,
            CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month
        FROM orders LEFT JOIN (
            SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey
        ) ON l_orderkey = o_orderkey""",
    "q_update_partitions_not_in": """
        SELECT o_orderkey, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)
                                THEN 'small' ELSE o_orderstatus END AS status,
            CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month
        FROM orders""",
    "q_publish_swap": """
        SELECT 'before' AS state, o_orderstatus, count(*) AS n, CAST(NULL AS BIGINT) AS rest
        FROM orders GROUP BY o_orderstatus
        UNION ALL
        SELECT 'now', o_orderstatus, count(*), CAST(sum(o_custkey % 3) AS BIGINT)
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus""",
    "q_dense_key_append": """
        WITH first AS (
            SELECT row_number() OVER (ORDER BY c_mktsegment, c_nationkey) AS segmentid, *
            FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_acctbal < 0)
        ), further AS (
            SELECT c_mktsegment, c_nationkey FROM customer
            EXCEPT SELECT c_mktsegment, c_nationkey FROM first
        )
        SELECT * FROM first
        UNION ALL
        SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY c_mktsegment, c_nationkey), *
        FROM further""",
    "q_duplicates_incremental": """
        SELECT text, count(*) AS copies, count(*) FILTER (doc_id % 3 <> 0) AS earlier
        FROM documents GROUP BY text
        HAVING count(*) > 1 AND count(*) FILTER (doc_id % 3 = 0) > 0""",
    "q_snapshot_changes": """
        SELECT text, lang, source, before, after, CASE WHEN before = 0 THEN 'added'
            WHEN after = 0 THEN 'removed' ELSE 'copies' END AS change
        FROM (
            SELECT text, lang, CASE WHEN doc_id % 4 > 0 THEN source END AS source,
                count(*) FILTER (doc_id % 5 <> 0) AS before, count(*) FILTER (doc_id % 7 <> 0) AS after
            FROM documents GROUP BY ALL
        ) WHERE before <> after""",
    "q_add_metadata": """
        SELECT 'orders file' AS datasource, 'new' AS status, count(*) AS n, count(*) AS n_dated
        FROM orders""",
    "q_abs_repair": "SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer",
    "q_cast_date": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_date FROM orders",
    "q_format_line": """
        SELECT p_partkey, format('{:<100}{:<10}  {:<10}', p_name, p_brand, p_size) AS line
        FROM part""",
    "q_project": "SELECT o_orderkey AS movieid, o_custkey AS genreid FROM orders",
    "q_normalize": CUSTOMER_PEOPLE,
    "q_people_dedupe": CUSTOMER_PEOPLE + """
        UNION
        SELECT 'supply', lower(s_name), lower('S' || s_suppkey || '@Example.com'),
               replace('556-' || s_suppkey, '-', ''),
               regexp_replace(lower('No. ' || s_suppkey || ' North St'), 'no.|#', '', 'g')
        FROM supplier""",
    "q_explode": """
        SELECT count(*) AS n, min(x) AS low, max(x) AS high
        FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)""",
    "q_explode_carry": """
        SELECT vec_id, label, count(*) AS n, max(x) AS high
        FROM (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
        GROUP BY vec_id, label""",
    "q_explode_inplace": """
        SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS embedding, label FROM embeddings""",
    "q_split_below": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 100000",
    "q_split_at_or_above": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000",
    "q_status_eq": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    "q_dim_replace": """
        WITH dimension AS (
            SELECT row_number() OVER (ORDER BY priority NULLS FIRST) AS priorityid, priority
            FROM (SELECT DISTINCT o_orderpriority AS priority FROM orders)
        )
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, priorityid AS o_orderpriority
        FROM orders JOIN dimension ON o_orderpriority = priority""",
    "q_using_join": """
        SELECT o_orderkey, o_totalprice, occurrences
        FROM orders JOIN (
            SELECT l_orderkey AS o_orderkey, count(l_orderkey) AS occurrences
            FROM lineitem GROUP BY l_orderkey HAVING count(l_orderkey) < 2
        ) USING (o_orderkey)""",
    "q_in_semi": "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "q_not_in_anti": "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "q_duplicates": "SELECT text, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1",
    "q_singletons": """
        SELECT l_orderkey, count(l_orderkey) AS occurrences
        FROM lineitem GROUP BY l_orderkey HAVING count(l_orderkey) < 2""",
    "q_distinct": "SELECT DISTINCT n_regionkey FROM nation",
    "q_union_distinct": """
        SELECT c_mktsegment AS name, c_nationkey AS nation FROM customer
        UNION
        SELECT s_name, s_nationkey FROM supplier""",
    "q_dense_key_lang": """
        SELECT row_number() OVER (ORDER BY lang NULLS FIRST) AS langid, lang
        FROM (SELECT DISTINCT lang FROM documents)""",
    "q_dense_key_large": """
        SELECT row_number() OVER (
                   ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST, l_partkey NULLS FIRST,
                            l_suppkey NULLS FIRST, l_linenumber NULLS FIRST, l_quantity NULLS FIRST,
                            l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                            l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS lineid,
               *
        FROM lineitem""",
    "q_sparse_key": "SELECT count(*) AS n, count(*) AS n_ids FROM lineitem",
    "q_sparse_key_rows": """
        SELECT l_orderkey, count(*) AS n, count(*) AS n_ids FROM lineitem GROUP BY l_orderkey""",
    "q_merge_status": """
        SELECT o_orderkey, coalesce(big.status, o_orderstatus) AS status
        FROM orders LEFT JOIN (
            SELECT l_orderkey, 'big' AS status FROM lineitem
            GROUP BY l_orderkey HAVING sum(l_quantity) > 150
        ) big ON l_orderkey = o_orderkey""",
    "q_single_occurrence_unfiltered": """
        SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
        WHERE l_orderkey IN (
            SELECT l_orderkey FROM lineitem WHERE l_quantity >= 25
            GROUP BY l_orderkey HAVING count(l_orderkey) = 1
        )""",
}

LAYERED = {
    "q_struct_expand": """
        SELECT value."Id" AS value_id, "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate",
               CAST(len(genres) AS INTEGER) AS n_genres
        FROM bronze""",
    "q_blank_split": """
        SELECT CASE WHEN name = '' THEN 'blank' ELSE 'named' END AS side, id, name, count(*) AS n
        FROM tag WHERE name IS NOT NULL GROUP BY ALL""",
    "q_filter_and": """
        SELECT "Id", "Budget", "RunTime" FROM bronze WHERE "RunTime" >= 0 AND "Budget" > 100000""",
    "q_distinct_records": """
        SELECT "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate" FROM (SELECT DISTINCT * FROM bronze)""",
    "q_split_with_nulls": """
        SELECT "Id", "Budget", CASE WHEN "Budget" < 100000 THEN 'below' ELSE 'rest' END AS side
        FROM bronze WHERE "Budget" IS NOT NULL""",
    "q_not_in_null_key": """
        SELECT "Id", "OriginalLanguage" AS lang, 'with null' AS keys FROM bronze
        WHERE "OriginalLanguage" NOT IN (
            SELECT "OriginalLanguage" FROM bronze
            WHERE "OriginalLanguage" <> '1-URGENT' OR "OriginalLanguage" IS NULL)
        UNION ALL
        SELECT "Id", "OriginalLanguage", 'without null' FROM bronze
        WHERE "OriginalLanguage" NOT IN (
            SELECT "OriginalLanguage" FROM bronze WHERE "OriginalLanguage" <> '1-URGENT')""",
    "q_view_sql": """
        SELECT "Id", CASE WHEN value IN (
                   SELECT value FROM bronze WHERE "Budget" >= 100000 AND "RunTime" >= 0)
               THEN 'loaded' ELSE 'new' END AS status
        FROM bronze""",
    "q_entity_silver": """
        SELECT 'genre' AS entity, id, name FROM tag WHERE name <> ''
        UNION SELECT 'movie_genre', movieid, CAST(genreid AS VARCHAR) FROM bridge
        UNION SELECT 'language', languageid, language FROM language""",
    "q_duplicate_records": """SELECT value."Id" AS "Id", copies FROM repeated""",
    "q_distinct_struct": "SELECT DISTINCT id, name FROM tag",
    "q_genre_dim": "SELECT DISTINCT id, name FROM tag WHERE name <> ''",
    "q_bridge": "SELECT moviegenreid, movieid, genreid FROM bridge",
    "q_language_dim": "SELECT languageid, language FROM language",
    "q_update_in": """
        SELECT "Id", CASE WHEN value IN (
                   SELECT value FROM bronze WHERE "Budget" >= 100000 AND "RunTime" >= 0)
               THEN 'loaded' ELSE 'new' END AS status
        FROM bronze""",
    "q_update_not_in": """
        SELECT "Id", CASE WHEN value NOT IN (
                   SELECT value FROM bronze WHERE "Budget" >= 100000 AND "RunTime" >= 0)
               THEN 'quarantined' ELSE 'new' END AS status
        FROM bronze""",
    "q_classify": """SELECT "Id", status FROM classified""",
    "q_quarantined": """
        SELECT "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate"
        FROM classified WHERE status = 'quarantined'""",
    "q_repair": """
        SELECT "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate" FROM repaired""",
    "q_load_repaired": "SELECT * FROM loaded",
    "q_silver": "SELECT * FROM silver",
    "q_bronze_status": """SELECT "Id", status FROM finished""",
    "q_checks": """
        SELECT 'silver_rows' AS "check", count(*) AS rows FROM silver
        UNION ALL SELECT 'budget_failing', count(*) FROM silver WHERE "Budget" < 100000
        UNION ALL SELECT 'runtime_failing', count(*) FROM silver WHERE "RunTime" < 0
        UNION ALL SELECT 'budget_null', count(*) FROM silver WHERE "Budget" IS NULL
        UNION ALL SELECT 'runtime_null', count(*) FROM silver WHERE "RunTime" IS NULL
        UNION ALL SELECT 'bronze_rows', count(*) FROM finished
        UNION ALL SELECT 'not_loaded', count(*) FROM finished WHERE status <> 'loaded'
        UNION ALL SELECT 'null_unclassified', count(*) FROM finished
            WHERE "Budget" IS NULL OR "RunTime" IS NULL
        UNION ALL SELECT 'missing_attribute', count(*) FROM finished WHERE "OriginalLanguage" IS NULL
        UNION ALL SELECT 'tag_rows', count(*) FROM (SELECT DISTINCT id, name FROM tag WHERE name <> '')
        UNION ALL SELECT 'blank_tag_name', count(*)
            FROM (SELECT DISTINCT id, name FROM tag WHERE name <> '') WHERE name = ''""",
    "q_single_occurrence": """
        SELECT "Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate" FROM bronze
        WHERE "RunTime" >= 0 AND "Budget" > 100000 AND "Id" IN (
            SELECT "Id" FROM bronze WHERE "RunTime" >= 0 AND "Budget" > 100000
            GROUP BY "Id" HAVING count("Id") < 2)""",
    "q_entity_bronze": """
        SELECT 'genre' AS entity, id, name,
               CASE WHEN name <> '' THEN 'loaded' WHEN name = '' THEN 'quarantined' ELSE 'new' END AS status
        FROM (SELECT DISTINCT id, name FROM tag)
        UNION ALL SELECT 'movie_genre', moviegenreid, movieid || '-' || genreid, 'loaded' FROM bridge
        UNION ALL SELECT 'language', languageid, language, 'loaded' FROM language""",
    "q_stream_silver": """
        SELECT "Id", "Budget", "RunTime", language, "CreatedDate"
        FROM silver JOIN language ON "OriginalLanguage" = languageid""",
    "q_incremental_refresh": """
        SELECT 'bronze' AS layer, "Id", status FROM finished
        UNION ALL
        SELECT 'silver', "Id", language FROM silver JOIN language ON "OriginalLanguage" = languageid
        UNION ALL
        SELECT DISTINCT 'tag', id, name FROM tag WHERE name <> ''
        UNION ALL
        SELECT 'bridge', movieid, CAST(genreid AS VARCHAR) FROM bridge""",
    "q_full_refresh": """
        SELECT 'bronze' AS layer, "Id", status FROM finished
        UNION ALL
        SELECT 'silver', "Id", CAST("OriginalLanguage" AS VARCHAR) FROM silver""",
}


# The same counts, taken in another way.
LAYERED["q_checks_observed"] = LAYERED["q_checks"]


def all_sql() -> dict[str, str]:
    return {**PLAIN, **{name: LAYERS + sql for name, sql in LAYERED.items()}}
