"""The same results as SQL over the whole tables, written independently of the DataFrame code."""

_ROUTED = """
    SELECT event_id, 'gamma' AS queue FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'hadron' FROM events WHERE value > 10
"""
_SERVICE = """
    SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey
"""
_BOTH_SIGNS = """
    SELECT event_id, 0 AS pos, value AS v, 'q1' AS queue FROM events
    UNION ALL SELECT event_id, 1, -value, 'q1' FROM events
"""
_EVENTS = "SELECT event_id, event_type, value FROM events"
_COUNT = "SELECT count(*) AS n FROM events"

_RATE = """
        SELECT block, count(*) AS n, max(us) - min(us) AS span_us
        FROM (SELECT epoch_us(ts) AS us, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS block FROM events)
        GROUP BY block
    """
ORACLES = {
    "source_scan": "SELECT event_id, user_id, event_type, value FROM events",
    "multi_source": """
        SELECT 'events' AS source, count(*) AS n FROM events
        UNION ALL SELECT 'orders', count(*) FROM orders
    """,
    "sharded_source": _EVENTS,
    "custom_source": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000",
    "random_source": """
        SELECT att, count(*) AS n, true AS mean_is_0, true AS sd_is_1
        FROM events, (VALUES ('att1'), ('att2')) t(att) GROUP BY att
    """,
    "constant_source": """
        SELECT event_id, CAST(1 AS BIGINT) AS id, 'streams Framework' AS name, ['v1', 'v2', 'v3'] AS data FROM events
    """,
    "source_limit": "SELECT event_id FROM events ORDER BY event_id LIMIT 1000",
    "tolerant_read": _EVENTS + " WHERE event_type NOT IN ('error', 'click')",
    "tolerant_split": """
        SELECT 'item' AS kind, event_id, NULL::VARCHAR AS broken FROM events WHERE event_type NOT IN ('error', 'click')
        UNION ALL
        SELECT 'broken', NULL, CASE event_type
            WHEN 'error' THEN substr('{"event_id":' || event_id || ',"event_type":"error"', 1, 14)
            ELSE '{"event_id":' || event_id || ',"event_type":"click","value":"none"}' END
        FROM events WHERE event_type IN ('error', 'click')
    """,
    "large_limit": """
        SELECT count(*) AS n, max(l_orderkey) AS l_orderkey, arg_max(l_linenumber, (l_orderkey, l_linenumber)) AS l_linenumber
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY ALL LIMIT (SELECT 2 * count(*) // 3 FROM lineitem))
    """,
    "tolerant_projection": """
        SELECT count(*) AS n, count(event_id) AS ids, CAST(sum(event_id) AS BIGINT) AS total, count(*) AS "rows"
        FROM events WHERE event_type NOT IN ('error', 'click')
    """,
    "arrival_id": "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS id FROM events",
    "json_sink": _EVENTS,
    "queue_sink": _ROUTED,
    "custom_sink": "SELECT event_id, value FROM events",
    "log_tap": "SELECT event_id FROM events",
    "terminal_process": _COUNT + " WHERE event_type = 'click'",
    "process_chain": "SELECT event_id, value * 2 AS v2, 'data' AS src FROM events WHERE event_type = 'click'",
    "set_value": """SELECT event_id, 'true' AS "fromQueue" FROM events""",
    "create_id": """
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS id
        FROM orders WHERE o_orderstatus = 'F'
    """,
    "alternate_ab": """
        SELECT event_id,
               CASE WHEN (row_number() OVER (ORDER BY event_id) - 1) % 2 = 0 THEN 'A' ELSE 'B' END AS flag
        FROM events
    """,
    "data_rate": _RATE,
    "instance_tag": "SELECT event_id, 'reader' AS process, true AS named FROM events",
    "attr_access": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               json_extract_string(props, '$.zz') IS NOT NULL AS has_zz
        FROM events
    """,
    "skip_rows": "SELECT event_id FROM events WHERE event_type <> 'error'",
    "conditional_set": "SELECT event_id, CASE WHEN value > 10 THEN 'high' END AS level FROM events",
    "conditional_skip": """
        SELECT event_id, CASE WHEN value > 10 THEN 'high' END AS level
        FROM events WHERE event_type <> 'error' AND NOT (value > 10 AND event_type = 'click')
    """,
    "open_condition": """
        SELECT event_id, CASE WHEN k > 3 THEN 'yes' END AS big
        FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) WHERE k <> 1
    """,
    "open_put": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS dotted,
               event_type AS same, event_id AS n FROM events
    """,
    "drop_null_items": "SELECT event_id, event_type FROM events WHERE value > 10",
    "unrouted_dropped": "SELECT event_id, 'gamma' AS queue FROM events WHERE event_type = 'error'",
    "enqueue_one": "SELECT event_id, 'q1' AS queue FROM events",
    "enqueue_route": _ROUTED,
    "enqueue_multi": """
        SELECT event_id, 'hi' AS queue FROM events WHERE value > 10
        UNION ALL SELECT event_id, 'err' FROM events WHERE event_type = 'error'
    """,
    "enqueue_bulk": _BOTH_SIGNS,
    "split_select": """
        SELECT CASE event_type WHEN 'error' THEN 'gamma' ELSE 'hadron' END AS queue,
               count(*) AS n, min(event_id) AS first_id
        FROM events WHERE event_type IN ('error', 'click') GROUP BY 1
    """,
    "flatmap_emit": """
        SELECT event_id, 0 AS ord, 'out' AS target FROM events
        UNION ALL SELECT event_id, 1, 'gamma' FROM events WHERE event_type = 'error'
        UNION ALL SELECT event_id, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END, 'hi'
        FROM events WHERE value > 10
    """,
    "udtf_emit": _BOTH_SIGNS,
    "custom_emit": _BOTH_SIGNS,
    "named_output": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "multi_output": "SELECT event_id, output FROM events, (VALUES ('a'), ('b')) t(output) WHERE value > 10",
    "shared_input": """
        SELECT 'p1' AS process, event_id FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'p2', event_id FROM events WHERE value > 10
    """,
    "chain_by_id": "SELECT event_id, 'second' AS stage FROM events WHERE event_type = 'click'",
    "rebind_name": "SELECT event_id FROM events WHERE event_type = 'view'",
    "output_plus_queues": """
        SELECT event_id, CAST(NULL AS VARCHAR) AS queue FROM events
        UNION ALL SELECT event_id, 'gamma' FROM events WHERE event_type = 'error'
    """,
    "output_named_as_queue": """
        SELECT event_id, CAST(NULL AS VARCHAR) AS queue FROM events
        UNION ALL SELECT event_id, 'gamma' FROM events WHERE event_type = 'error'
    """,
    "undeclared_queue": """
        SELECT 'gamma' AS queue, count(*) AS n FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'ghost', CAST(0 AS BIGINT)
    """,
    "routing_sample": """
        SELECT CASE WHEN turn % 2 = 0 THEN 'gamma' ELSE 'hadron' END AS queue, count(*) AS n
        FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS turn FROM events) GROUP BY 1
    """,
    "queue_sample": """SELECT event_id, 'q1' AS queue, 'true' AS "fromQueue" FROM events""",
    "count_sample": "SELECT count(*) AS n FROM lineitem",
    "key_partition": "SELECT event_id, user_id FROM events",
    "keyed_running_count": """
        SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events
    """,
    "keyed_apply": """
        SELECT event_id, user_id,
               coalesce(event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS d
        FROM events
    """,
    "flow_keyed_process": """
        SELECT event_id, user_id, gap, gap > 200 AS far
        FROM (SELECT event_id, user_id, coalesce(event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS gap
              FROM events)
    """,
    "item_count": _COUNT,
    "finish_totals": _COUNT,
    "udf_processor": "SELECT event_id, upper(event_type) AS t FROM events",
    "service_lookup": _SERVICE,
    "service_lookup_large": _SERVICE,
    "partition_setup": """
        SELECT event_id, CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 ELSE 0 END AS BIGINT) AS code
        FROM events
    """,
    "copies_invariant": """
        SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v
        FROM events GROUP BY event_type
    """,
    "coalesce_leaf": "SELECT event_id FROM events",
    "stream_route": _ROUTED,
    "stream_fan_out": _ROUTED,
    "stateful_stream": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "stream_create_id": """
        SELECT count(*) AS n, CAST(0 AS BIGINT) AS first, count(*) - 1 AS last,
               CAST(CAST(count(*) AS HUGEINT) * (count(*) - 1) // 2 AS VARCHAR) AS total
        FROM events
    """,
    "stream_service_lookup": _SERVICE,
    "flow_live": """
        WITH n AS (SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS id FROM events),
        g AS (SELECT *, coalesce(id - lag(id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS gap FROM n)
        SELECT *, gap > 200 AS far, 'far' AS queue FROM g WHERE gap > 200
        UNION ALL SELECT *, gap > 200 AS far, 'near' AS queue FROM g WHERE gap <= 250
    """,
    "custom_stream_source": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000",
    "custom_stream_sink": "SELECT event_id, value FROM events",
    "stateful_map": "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id",
    "live_finish": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "stream_data_rate": _RATE,
}
