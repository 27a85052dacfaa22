"""For each query the SQL that gives the same rows on the same tables."""

from __future__ import annotations

# Common table expressions, put before a statement by `_sql` as it names them.
CTES = {
    "ev": """
        SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS tsm,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(round(value * 100) AS BIGINT) AS v100
        FROM events""",
    "visit": """
        SELECT event_id, event_type, k, tsm, v100,
               'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS user_id,
               CAST(user_id % 25 AS VARCHAR) AS province_id, 'ch_' || (event_id % 3) AS channel,
               CAST(event_id % 2 AS VARCHAR) AS is_new, 'model_' || (event_id % 7) AS model,
               'os_' || (event_id % 2) AS operate_system, 'v2.' || (event_id % 4) AS version_code,
               'brand_' || (event_id % 5) AS brand
        FROM ev""",
    "page_all": """
        SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand,
               event_type AS page_id, CASE WHEN event_id % 3 <> 0 THEN 'home' END AS last_page_id,
               CAST(k AS VARCHAR) AS page_item, 'sku_id' AS page_item_type, v100 AS during_time,
               'src_' || (event_id % 4) AS sourceType, tsm AS ts, event_id, k
        FROM visit WHERE event_type IN ('view', 'click', 'purchase')""",
    "page": "SELECT * EXCLUDE (event_id, k) FROM page_all",
    "display": """
        SELECT p.* EXCLUDE (event_id, k), 'promotion' AS display_type, CAST(k + i AS VARCHAR) AS display_item,
               'sku_id' AS display_item_type, CAST(i + 1 AS VARCHAR) AS display_order,
               CAST(i AS VARCHAR) AS display_pos_id
        FROM page_all p, (VALUES (0), (1), (2)) AS n(i) WHERE i < event_id % 4""",
    "action": """
        SELECT p.* EXCLUDE (event_id, k), 'act_' || i AS action_id, CAST(k AS VARCHAR) AS action_item,
               'sku_id' AS action_item_type, ts + i * 1000 AS action_ts
        FROM page_all p, (VALUES (0), (1)) AS n(i) WHERE i < event_id % 3""",
    "startup": """
        SELECT mid, brand, user_id, province_id, channel, is_new, model, operate_system, version_code,
               'entry_' || (event_id % 3) AS entry, CAST(k AS VARCHAR) AS open_ad_id,
               v100 AS loading_time_ms, k * 10 AS open_ad_ms, k * 3 AS open_ad_skip_ms, tsm AS ts
        FROM visit WHERE event_type = 'signup'""",
    "err": """
        SELECT tsm AS ts, '{"common":{"ar":"' || province_id || '","uid":"' || user_id || '","os":"' || operate_system
               || '","ch":"' || channel || '","is_new":"' || is_new || '","md":"' || model || '","mid":"' || mid
               || '","vc":"' || version_code || '","ba":"' || brand || '"},"ts":' || tsm
               || ',"err":{"error_code":' || (k + 1000) || ',"msg":"e"},"page":{"page_id":"error","item":"' || k
               || '","item_type":"sku_id","during_time":' || v100
               || CASE WHEN event_id % 3 <> 0 THEN ',"last_page_id":"home"' ELSE '' END
               || ',"source_type":"src_' || (event_id % 4) || '"},"displays":['
               || array_to_string(list_transform(range(event_id % 4), lambda i:
                    '{"display_type":"promotion","item":"' || (k + i) || '","item_type":"sku_id","pos_id":"' || i
                    || '","order":"' || (i + 1) || '"}'), ',')
               || '],"actions":['
               || array_to_string(list_transform(range(event_id % 3), lambda i:
                    '{"action_id":"act_' || i || '","item":"' || k || '","item_type":"sku_id","ts":'
                    || (tsm + i * 1000) || '}'), ',')
               || ']}' AS value
        FROM visit WHERE event_type = 'error'""",
    "message": """
        SELECT 'DWD_PAGE_LOG_TOPIC_1018' AS topic, ts FROM page
        UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC_1018', ts FROM display
        UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC_1018', ts FROM action
        UNION ALL SELECT 'DWD_START_LOG_TOPIC_1018', ts FROM startup
        UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC_1018', ts FROM err""",
    "entry_page": "SELECT * FROM page WHERE last_page_id IS NULL",
    "first_visit": """
        SELECT * FROM (SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt FROM entry_page)
        QUALIFY row_number() OVER (
            PARTITION BY dt, mid ORDER BY ts, user_id, province_id, channel, is_new, model, operate_system,
            version_code, brand, page_id, page_item, page_item_type, during_time, sourceType) = 1""",
    "user_info": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               DATE '1955-01-01' + CAST((c_custkey * 7919) % 18000 AS INTEGER) AS birthday
        FROM customer""",
    "user_aged": """
        SELECT id, gender, CAST(birthday AS DATE) AS birthday,
               CAST(2024 - year(birthday) - CASE WHEN '0630' < strftime(birthday, '%m%d') THEN 1 ELSE 0 END
                    AS INTEGER) AS age
        FROM user_info""",
    "base_province": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region_id,
               lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS area_code, 'CN-' || n_nationkey AS iso_code,
               'CN-N' || n_nationkey AS iso_3166_2
        FROM nation""",
    "dau": """
        SELECT v.mid, v.user_id, v.province_id, v.channel, v.is_new, v.model, v.operate_system,
               v.version_code, v.page_id, v.page_item, v.page_item_type, v.brand, v.sourceType,
               v.during_time, u.gender AS user_gender, CAST(u.age AS VARCHAR) AS user_age,
               p.name AS province_name, p.iso_code AS province_iso_code, p.iso_3166_2 AS province_3166_2,
               p.area_code AS province_area_code, v.dt, strftime(make_timestamp(v.ts * 1000), '%H') AS hr, v.ts
        FROM first_visit v LEFT JOIN user_aged u ON v.user_id = CAST(u.id AS VARCHAR)
        LEFT JOIN base_province p ON v.province_id = CAST(p.id AS VARCHAR)""",
    "order_info": """
        SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
               o_custkey AS user_id, o_totalprice AS total_amount, 0.0::DOUBLE AS activity_reduce_amount,
               0.0::DOUBLE AS coupon_reduce_amount, o_totalprice AS original_total_amount,
               0.0::DOUBLE AS feight_fee, 0.0::DOUBLE AS feight_fee_reduce, NULL::VARCHAR AS expire_time,
               NULL::VARCHAR AS refundable_time, strftime(created, '%Y-%m-%d %H:%M:%S') AS create_time,
               NULL::VARCHAR AS operate_time
        FROM (SELECT *, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created FROM orders)""",
    "order_enriched": """
        SELECT o.*, substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour,
               p.name AS province_name, p.area_code AS province_area_code,
               p.iso_3166_2 AS province_3166_2_code, p.iso_code AS province_iso_code,
               u.age AS user_age, u.gender AS user_gender
        FROM order_info o LEFT JOIN user_aged u ON o.user_id = u.id
        LEFT JOIN base_province p ON o.province_id = p.id""",
    "order_detail": """
        SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    CAST(l_extendedprice AS DECIMAL(18,2)), strftime(l_shipdate, '%Y-%m-%d'))), 1, 15)
                    AS BIGINT) AS id,
               l_orderkey AS order_id, l_partkey AS sku_id, p_retailprice AS order_price,
               CAST(l_quantity AS BIGINT) AS sku_num, p_name AS sku_name,
               strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400)
                        + to_seconds((l_partkey * 977) % 172800 - 43200), '%Y-%m-%d %H:%M:%S') AS create_time,
               l_extendedprice AS split_total_amount,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE)
                    AS split_activity_amount,
               0.0::DOUBLE AS split_coupon_amount
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "pair": """
        SELECT o.id AS o_id, d.id AS d_id FROM order_info o JOIN order_detail d ON o.id = d.order_id
        WHERE abs(date_diff('second', CAST(o.create_time AS TIMESTAMP), CAST(d.create_time AS TIMESTAMP))) <= 86400""",
    "wide": """
        SELECT d.id AS detail_id, d.order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
               d.split_total_amount, d.split_activity_amount, d.split_coupon_amount,
               o.* EXCLUDE (id, create_time), d.create_time
        FROM order_enriched o JOIN order_detail d ON o.id = d.order_id
        WHERE abs(date_diff('second', CAST(o.create_time AS TIMESTAMP), CAST(d.create_time AS TIMESTAMP))) <= 86400""",
    "turn": """
        SELECT * FROM (VALUES (0, 'update', 'U'), (1, 'delete', 'D'), (2, 'bootstrap-insert', 'I'),
               (4, 'insert', 'I'), (5, 'insert', 'I'), (6, 'insert', 'I'), (7, 'insert', 'I'),
               (8, 'insert', 'I'), (9, 'insert', 'I')) AS t(digit, type, op)""",
    "user_version": """
        SELECT id, 2 AS ts, gender, birthday FROM user_info
        UNION ALL SELECT id, 1, CASE WHEN gender = 'M' THEN 'F' ELSE 'M' END, birthday FROM user_info""",
    "change": """
        SELECT "table", id, CAST(ts AS BIGINT) AS ts, type, op FROM (
            SELECT 'user_info' AS "table", id, ts FROM user_version
            UNION ALL SELECT 'base_province', id, 1 FROM base_province
            UNION ALL SELECT 'order_info', id, 1 FROM order_info
            UNION ALL SELECT 'order_detail', id, 1 FROM order_detail) c JOIN turn ON c.id % 10 = digit""",
    "dim_image": """
        SELECT 'DIM:' || t || ':' || id AS dim_key, t AS "table", CAST(id AS VARCHAR) AS id, op,
               CAST(ts AS BIGINT) AS ts, data
        FROM (SELECT 'USER_INFO' AS t, id, ts, '{"id":' || id || ',"gender":"' || gender || '","birthday":"'
                     || strftime(birthday, '%Y-%m-%d') || '"}' AS data FROM user_version
              UNION ALL SELECT 'BASE_PROVINCE', id, 1, '{"id":' || id || ',"name":"' || name || '","region_id":"'
                     || region_id || '","area_code":"' || area_code || '","iso_code":"' || iso_code
                     || '","iso_3166_2":"' || iso_3166_2 || '"}' FROM base_province) d
        JOIN turn ON d.id % 10 = digit""",
    "dim_newest": """
        SELECT * FROM dim_image QUALIFY row_number() OVER (PARTITION BY "table", id ORDER BY ts DESC) = 1""",
    "fact": """
        SELECT 'DWD_ORDER_INFO_' || op || '_1018' AS topic, id, total_amount AS amount, create_time
        FROM order_info JOIN turn ON id % 10 = digit
        UNION ALL SELECT 'DWD_ORDER_DETAIL_' || op || '_1018', id, split_total_amount, create_time
        FROM order_detail JOIN turn ON id % 10 = digit""",
    "doc": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_size / 5.0::DOUBLE AS "imdbScore",
               list_concat([p_brand, p_type], string_split(p_name, ' ')) AS actors
        FROM part""",
    "doc_text": """SELECT id, name, "imdbScore", array_to_string(actors, ',') AS "actorList" FROM doc""",
    "returned": "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.09",
    "hit": """
        SELECT * FROM doc_text WHERE "imdbScore" >= 5.0
        AND list_has_any(string_split_regex(lower(name), '[^\\p{L}\\p{N}]+'), ['red', 'sea'])""",
    "offset_row": """
        SELECT 'ODS_BASE_LOG' AS topic, 'ODS_BASE_LOG_GROUP' AS group_id,
               CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset" FROM events""",
    "ledger": """
        SELECT topic, group_id, partition, max("offset") + 1 AS next_offset FROM offset_row
        GROUP BY topic, group_id, partition""",
}


def _sql(statement: str) -> str:
    """The statement after all common table expressions, in the order they build on each other."""
    ctes = ",\n".join(f"{name} AS NOT MATERIALIZED ({text})" for name, text in CTES.items())
    return f"WITH {ctes}\n{statement}"


def _order_amount(key: str, name: str) -> str:
    return _sql(f"""
        SELECT {key} AS {name}, count(*) AS details,
               CAST(sum(CAST(split_total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM wide GROUP BY 1""")


_FLOATS = ("order_price, split_total_amount, split_activity_amount, split_coupon_amount, total_amount, "
           "activity_reduce_amount, coupon_reduce_amount, original_total_amount, feight_fee, "
           "feight_fee_reduce").split(", ")
_KEYS = "detail_id, order_id, sku_id, province_id, user_id".split(", ")

ORACLE: dict[str, str] = {
    "log_error": _sql("SELECT value FROM err"),
    "log_page": _sql("SELECT * FROM page"),
    "log_display": _sql("SELECT * EXCLUDE (ts), ts FROM display"),
    "log_action": _sql("SELECT * FROM action"),
    "log_start": _sql("SELECT * FROM startup"),
    "log_split_counts": _sql("SELECT topic, count(*) AS messages FROM message GROUP BY topic"),
    "json_roundtrip": _sql("SELECT * FROM page"),
    "keyed_sink_layout": _sql("""
        SELECT CAST(CAST('0x' || substr(md5(mid), 1, 8) AS BIGINT) % 16 AS INTEGER) AS partition,
               count(*) AS messages, count(DISTINCT mid) AS keys FROM page GROUP BY 1"""),
    "cdc_op": _sql("SELECT * FROM change"),
    "cdc_fact_route": _sql("SELECT * FROM fact"),
    "cdc_dim_route": _sql("SELECT * FROM dim_image"),
    "cdc_dynamic_routing": _sql("""
        SELECT topic AS target, CAST(id AS VARCHAR) AS id FROM fact WHERE topic LIKE 'DWD_ORDER_INFO%'
        UNION ALL SELECT 'DWD_USER_INFO_' || op || '_1018', id FROM dim_image WHERE "table" = 'USER_INFO'
        UNION ALL SELECT dim_key, id FROM dim_image"""),
    "dim_latest": _sql("SELECT dim_key, op, ts, data FROM dim_newest"),
    "dau_entry_pages": _sql("SELECT * FROM entry_page"),
    "dau_dedup": _sql("SELECT * FROM first_visit"),
    "dau_funnel_counts": _sql("""
        SELECT (SELECT count(*) FROM page) AS pages, (SELECT count(*) FROM entry_page) AS entry_pages,
               (SELECT count(*) FROM first_visit) AS first_visits"""),
    "user_age": _sql("SELECT id, gender, CAST(birthday AS VARCHAR) AS birthday, age FROM user_aged"),
    "dau_wide": _sql("SELECT * FROM dau"),
    "project_by_name": _sql("""
        SELECT * EXCLUDE (last_page_id), NULL::VARCHAR AS user_gender, NULL::VARCHAR AS user_age,
               NULL::VARCHAR AS province_name, NULL::VARCHAR AS province_iso_code,
               NULL::VARCHAR AS province_3166_2, NULL::VARCHAR AS province_area_code, NULL::VARCHAR AS dt,
               NULL::VARCHAR AS hr FROM page"""),
    "dau_mapping_cast": _sql("""
        SELECT * REPLACE (CAST(user_age AS INTEGER) AS user_age,
                          strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts) FROM dau"""),
    "dau_daily_partitions": _sql("SELECT * FROM dau"),
    "alias_all_days": _sql("""
        SELECT dt, count(*) AS docs, min(ts) AS first_ts, max(ts) AS last_ts FROM dau GROUP BY dt"""),
    "search_field": _sql("SELECT mid FROM dau"),
    "dau_state_restore": _sql("SELECT * FROM first_visit WHERE dt >= '2024-01-16'"),
    "dau_by_day": _sql("SELECT dt, count(*) AS dau FROM first_visit GROUP BY dt"),
    "dau_by_hour": _sql("SELECT dt, hr, count(*) AS dau FROM dau GROUP BY dt, hr"),
    "order_enriched": _sql("SELECT * FROM order_enriched"),
    "order_full_outer": _sql("""
        SELECT o.id AS order_id, d.id AS detail_id, o.total_amount, d.split_total_amount AS d_split_total_amount
        FROM order_info o FULL JOIN order_detail d ON o.id = d.order_id"""),
    "order_wide": _sql("SELECT * FROM wide"),
    "order_unmatched": _sql("SELECT * FROM order_info WHERE id NOT IN (SELECT o_id FROM pair)"),
    "detail_unmatched": _sql("SELECT * FROM order_detail WHERE id NOT IN (SELECT d_id FROM pair)"),
    "order_mapping_cast": _sql("SELECT * REPLACE ("
                               + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in _FLOATS) + ", "
                               + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _KEYS)
                               + ", CAST(user_age AS BIGINT) AS user_age) FROM wide"),
    "order_amount_by_gender": _order_amount("user_gender", "user_gender"),
    "order_amount_by_age_band": _order_amount(
        "(user_age // 10 * 10) || '-' || (user_age // 10 * 10 + 9)", "age_band"),
    "order_amount_by_province": _order_amount("province_name", "province_name"),
    "order_item_search": _sql("""
        SELECT detail_id, order_id, sku_name, split_total_amount, (SELECT count(*) FROM found) AS total_hits
        FROM found ORDER BY split_total_amount DESC, detail_id LIMIT 20 OFFSET 20""".replace(
            "FROM found", """FROM (SELECT * FROM wide WHERE list_has_any(
            string_split_regex(lower(sku_name), '[^\\p{L}\\p{N}]+'), ['red', 'ring']))""")),
    "category_view": _sql("""
        SELECT s_suppkey AS id, r_regionkey AS category1_id, r_name AS category1_name,
               n_nationkey AS category2_id, n_name AS category2_name, s_suppkey AS category3_id,
               s_name AS category3_name
        FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON n_nationkey = s_nationkey"""),
    "bulk_upsert": _sql("""
        , newest AS (
            SELECT CAST(l_partkey AS VARCHAR) AS id, 'returned to ' || l_suppkey AS name,
                   l_quantity / 5.0::DOUBLE AS "imdbScore", 'supplier ' || l_suppkey AS "actorList"
            FROM returned QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY
                 strftime(l_shipdate, '%Y-%m-%d') DESC, l_orderkey DESC, 'returned to ' || l_suppkey DESC,
                 l_quantity DESC) = 1
            UNION ALL SELECT 'S' || s_suppkey, s_name, 1.0, s_name FROM supplier)
        SELECT * FROM newest UNION ALL SELECT * FROM doc_text WHERE id NOT IN (SELECT id FROM newest)"""),
    "append_generated_id": _sql("""
        SELECT name, "imdbScore", "actorList", false AS generated FROM doc_text
        UNION ALL SELECT name, "imdbScore", "actorList", true FROM doc_text"""),
    "update_by_id": _sql("""
        SELECT id, name, coalesce(score, "imdbScore") AS "imdbScore", "actorList" FROM doc_text
        LEFT JOIN (SELECT CAST(l_partkey AS VARCHAR) AS part, max(l_quantity) / 5.0::DOUBLE AS score
                   FROM returned GROUP BY 1) ON id = part"""),
    "delete_by_id": _sql("""
        SELECT * FROM doc_text WHERE id NOT IN (SELECT CAST(l_partkey AS VARCHAR) FROM returned)"""),
    "update_by_query": _sql("""
        SELECT * REPLACE (CASE WHEN name = 'red ring' THEN 'red ring 2' ELSE name END AS name) FROM doc_text"""),
    "get_by_id": _sql("SELECT * FROM doc_text WHERE id = '100'"),
    "search_filter": _sql("SELECT * FROM hit"),
    "search_highlight": _sql("""
        SELECT id, name, "imdbScore",
               regexp_replace(name, '(?i)\\b(red|sea)\\b', '<em>\\1</em>', 'g') AS highlight FROM hit"""),
    "search_paging": _sql("""SELECT * FROM hit ORDER BY "imdbScore" DESC, id LIMIT 10 OFFSET 10"""),
    "search_total_hits": _sql("""
        SELECT *, (SELECT count(*) FROM hit) AS total_hits FROM hit ORDER BY "imdbScore" DESC, id LIMIT 2"""),
    "terms_avg_topk": _sql("""
        SELECT term, count(*) AS doc_count, round(avg("imdbScore"), 6) AS avg_score
        FROM (SELECT unnest(list_distinct(actors)) AS term, "imdbScore" FROM doc)
        GROUP BY term ORDER BY avg_score DESC, term LIMIT 10"""),
    "offset_ledger": _sql("SELECT * FROM ledger"),
    "offset_resume": _sql("""
        SELECT group_id, '{' || string_agg(positions, ',' ORDER BY topic) || '}' AS starting_offsets
        FROM (SELECT group_id, topic, '"' || topic || '":{' || string_agg('"' || partition || '":' || next_offset,
                     ',' ORDER BY partition) || '}' AS positions FROM ledger GROUP BY group_id, topic)
        GROUP BY group_id"""),
    "offset_resume_rest": _sql("""
        SELECT 'ODS_BASE_LOG' AS topic, 'ODS_BASE_LOG_GROUP' AS group_id, CAST(event_id % 4 AS INTEGER) AS partition,
               count(*) AS messages, min(event_id // 4) AS first_offset, max(event_id // 4) AS last_offset
        FROM events WHERE event_id // 4 >= 100 GROUP BY event_id % 4"""),
    "stream_log_split": _sql("""
        SELECT topic, count(*) AS messages, min(ts) AS first_ts, max(ts) AS last_ts FROM message GROUP BY topic"""),
    "stream_change_routing": _sql("""
        SELECT target, count(*) AS rows FROM (
            SELECT topic AS target FROM fact UNION ALL SELECT 'DIM:' || "table" FROM dim_newest) GROUP BY target"""),
    "stream_dau_dedup": _sql("SELECT * FROM first_visit"),
    "stream_dau_dedup_bounded": _sql("SELECT dt, mid FROM first_visit"),
    "stream_dau_wide": _sql("SELECT * FROM dau"),
    "stream_restart": _sql("SELECT * FROM first_visit"),
    "stream_new_checkpoint": _sql("SELECT * FROM first_visit"),
    "stream_order_join": _sql("SELECT * FROM wide"),
    "stream_dau_changing_dims": _sql("""
        SELECT * REPLACE (
            CASE WHEN CAST(user_id AS BIGINT) % 10 = 3 THEN NULL WHEN dt >= '2024-01-17' THEN user_gender
                 WHEN user_gender = 'M' THEN 'F' WHEN user_gender = 'F' THEN 'M' END AS user_gender,
            CASE WHEN CAST(user_id AS BIGINT) % 10 <> 3 THEN user_age END AS user_age,
            CASE WHEN CAST(province_id AS BIGINT) % 10 <> 3 THEN province_name END AS province_name,
            CASE WHEN CAST(province_id AS BIGINT) % 10 <> 3 THEN province_iso_code END AS province_iso_code,
            CASE WHEN CAST(province_id AS BIGINT) % 10 <> 3 THEN province_3166_2 END AS province_3166_2,
            CASE WHEN CAST(province_id AS BIGINT) % 10 <> 3 THEN province_area_code END AS province_area_code) FROM dau"""),
    "stream_order_new_checkpoint": _sql("""
        SELECT * REPLACE (CASE WHEN order_id % 7 = 0 THEN total_amount + 1000 ELSE total_amount END AS total_amount)
        FROM wide"""),
    "stream_unmatched": _sql("""
        SELECT topic, id FROM (
            SELECT 'ORDER_UNMATCHED' AS topic, id, create_time FROM order_info WHERE id NOT IN (SELECT o_id FROM pair)
            UNION ALL
            SELECT 'ORDER_DETAIL_UNMATCHED', id, create_time FROM order_detail WHERE id NOT IN (SELECT d_id FROM pair))
        WHERE epoch(CAST(create_time AS TIMESTAMP)) + 86400 <= greatest(
            (SELECT max(epoch(CAST(create_time AS TIMESTAMP))) FROM order_info),
            (SELECT max(epoch(CAST(create_time AS TIMESTAMP))) FROM order_detail))"""),
}
