"""The registered queries as SQL over the benchmark tables.

``_VIEWS`` are the logs, ledgers and catalogs of :mod:`topiclog.plans.views`; ``_sql`` puts those a statement
names, and those they name, in front of it.
"""

from __future__ import annotations

import re


def _partition(key: str, count: int) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 8))::BIGINT % {count} AS INTEGER)"


def _log(rows: str, parts: str, order: str) -> str:
    return f"""SELECT r.*, p.base + row_number() OVER (PARTITION BY r.topic, r."partition" ORDER BY {order}) - 1 AS "offset", p.base
        FROM {rows} r JOIN {parts} p ON r.topic = p.topic AND r."partition" = p."partition" """


def _parts(rows: str, count: int, base: int) -> str:
    return f"""SELECT topic, CAST(i AS INTEGER) AS "partition", CAST({base} * (i + 1) AS BIGINT) AS base
        FROM (SELECT topic, unnest(range({count})) AS i FROM (SELECT DISTINCT topic FROM {rows}))"""


def _marks(log: str, parts: str) -> str:
    return f"""SELECT p.topic, p."partition", coalesce(min(l."offset"), p.base) AS lowmark,
        coalesce(max(l."offset") + 1, p.base) AS highmark
        FROM {parts} p LEFT JOIN {log} l ON l.topic = p.topic AND l."partition" = p."partition"
        GROUP BY p.topic, p."partition", p.base"""


def _commits(log: str) -> str:
    return f"""SELECT CASE WHEN "partition" = 3 THEN 'g2' ELSE 'g1' END AS group_id, topic, "partition",
        CASE WHEN topic LIKE '%.error' AND "partition" = 0 THEN -1
             WHEN regexp_matches(topic, '\\.(view|ship_O)$') AND "partition" = 2 THEN ("offset" - base) // 2
             WHEN "partition" = 1 AND "offset" % 2 = 1 THEN base + ("offset" - base) // 4
             ELSE base + ("offset" - base) // 2 END AS "offset",
        CASE WHEN regexp_matches(topic, '\\.dc[1R]\\.') THEN 'kafka' ELSE 'zookeeper' END AS storage,
        "offset" AS commit_seq FROM {log}"""


def _last(commits: str) -> str:
    return f"""SELECT group_id, storage, topic, "partition", arg_max("offset", commit_seq) AS "offset"
        FROM {commits} GROUP BY group_id, storage, topic, "partition" """


def _metadata(marks: str, last: str, storage: str) -> str:
    return f"""SELECT m.topic, m."partition", CASE WHEN c."offset" = -1 THEN 0 ELSE coalesce(c."offset", 0) END AS "current",
        m.highmark, m.lowmark, c."offset" AS committed
        FROM {marks} m LEFT JOIN {last} c ON c.topic = m.topic AND c."partition" = m."partition"
        AND c.group_id = 'g1' AND c.storage = '{storage}'"""


_TOPIC = "'scribe.dc' || l_returnflag || '.ship_' || l_linestatus"
_CLUSTER_TYPE = "CASE WHEN {0} % 2 = 0 THEN 'standard' ELSE 'scribe' END"

_VIEWS = {
    "v_events": f"""SELECT 'scribe.dc' || (user_id % 2) || '.' || event_type AS topic,
        {_partition("CAST(user_id AS VARCHAR)", 4)} AS "partition",
        CAST(user_id AS VARCHAR) AS "key", props AS "value", ts, event_id FROM events""",
    "v_event_parts": _parts("v_events", 4, 100),
    "v_mixed": f"""SELECT topic, {_partition('coalesce("key", "value")', 4)} AS "partition", "key", "value", event_id FROM (
        SELECT topic, CASE WHEN CAST("key" AS BIGINT) % 3 <> 0 THEN "key" END AS "key", "value", event_id FROM v_events)""",
    "v_mixed_log": _log("v_mixed", "v_event_parts", "event_id"),
    "v_event_log": _log("v_events", "v_event_parts", "event_id"),
    "v_event_marks": _marks("v_event_log", "v_event_parts"),
    "v_event_commits": _commits("v_event_log"),
    "v_event_last": _last("v_event_commits"),
    "v_event_meta": _metadata("v_event_marks", "v_event_last", "zookeeper"),
    "v_event_meta_kafka": _metadata("v_event_marks", "v_event_last", "kafka"),
    "v_shipments": f"""SELECT {_TOPIC} AS topic, {_partition("CAST(l_orderkey AS VARCHAR)", 8)} AS "partition",
        CAST(l_orderkey AS VARCHAR) AS "key", l_partkey || ':' || l_suppkey || ':' || l_linenumber AS "value",
        l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem""",
    "v_shipment_parts": _parts("v_shipments", 8, 1000),
    "v_shipment_log": _log("v_shipments", "v_shipment_parts", "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"),
    "v_shipment_marks": _marks("v_shipment_log", "v_shipment_parts"),
    "v_shipment_commits": _commits("v_shipment_log"),
    "v_shipment_last": _last("v_shipment_commits"),
    "v_shipment_meta": _metadata("v_shipment_marks", "v_shipment_last", "zookeeper"),
    "v_requests": """SELECT DISTINCT
        'scribe.dc' || CASE WHEN event_type = 'signup' THEN 9 ELSE user_id % 2 END || '.' || event_type AS topic,
        CASE WHEN event_type <> 'error' THEN CAST(user_id % 3 * 2 AS INTEGER) END AS "partition" FROM events""",
    "v_valid": """SELECT topic, "partition" FROM v_event_parts p WHERE EXISTS (SELECT 1 FROM v_requests r
        WHERE r.topic = p.topic AND (r."partition" IS NULL OR r."partition" = p."partition"))""",
    "v_places": f"""SELECT {_CLUSTER_TYPE.format("s_suppkey")} AS type, 'cluster' || s_suppkey AS name,
        'a' || s_suppkey || ':9092,b' || s_suppkey || ':9092' AS brokers,
        'y' || s_suppkey || ':2181,z' || s_suppkey || ':2181' AS zookeeper, n_name AS region, r_name AS superregion
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_clusters": "SELECT type, name, brokers, zookeeper FROM v_places",
    "v_catalog": f"""SELECT DISTINCT {_CLUSTER_TYPE.format("l_suppkey")} AS cluster_type,
        'cluster' || l_suppkey AS cluster_name, {_TOPIC} AS topic, CAST(l_orderkey % 8 AS INTEGER) AS "partition" FROM lineitem""",
    "v_held": """SELECT DISTINCT p.*, c.topic FROM v_catalog c
        JOIN v_places p ON p.type = c.cluster_type AND p.name = c.cluster_name""",
    "v_subscriptions": """SELECT DISTINCT 'group' || user_id AS group_id,
        'scribe.dc' || CASE WHEN event_type = 'signup' THEN 9 ELSE user_id % 2 END || '.' || event_type AS topic FROM events""",
    "v_members": "SELECT 'g' || s_nationkey AS group_id, 'consumer-' || s_suppkey AS member_id FROM supplier",
    "v_joined": "SELECT * FROM v_members UNION ALL SELECT DISTINCT group_id, 'consumer-0new' FROM v_members",
    "v_units": f"""SELECT DISTINCT 'g' || s_nationkey AS group_id, {_TOPIC} AS topic,
        CAST(l_orderkey % 8 AS INTEGER) AS "partition" FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "v_dealt": """SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY topic || '-' || "partition") - 1 AS turn FROM v_units""",
    "v_assigned": """SELECT d.group_id, m.member_id, d.topic, d."partition" FROM v_dealt d JOIN (
        SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY member_id) - 1 AS seat,
        count(*) OVER (PARTITION BY group_id) AS seats FROM v_members) m
        ON d.group_id = m.group_id AND d.turn % m.seats = m.seat""",
    "v_reassigned": """SELECT d.group_id, m.member_id, d.topic, d."partition" FROM v_dealt d JOIN (
        SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY member_id) - 1 AS seat,
        count(*) OVER (PARTITION BY group_id) AS seats FROM v_joined) m
        ON d.group_id = m.group_id AND d.turn % m.seats = m.seat""",
    "v_names": """SELECT CASE l_linenumber WHEN 1 THEN 'scribble.' || l_returnflag || '.ship.' || l_suppkey
        WHEN 2 THEN 'scribe.' || l_returnflag WHEN 3 THEN 'scribe' || l_returnflag
        ELSE 'scribe.' || l_returnflag || '.ship.' || l_suppkey END AS topic FROM lineitem""",
    "v_samples": """SELECT CASE event_type WHEN 'click' THEN 'produce_request_timer' WHEN 'view' THEN 'fetch_request_timer'
        WHEN 'error' THEN 'failed_paylads_count' WHEN 'signup' THEN 'out_of_range_counts' ELSE 'unknown_metric' END AS name,
        "value" / 1000 AS "value", 'client' || (user_id % 5) AS client_id FROM events""",
}


def _sql(body: str) -> str:
    """``body`` behind a WITH of all views it needs."""
    needed: set[str] = set()

    def add(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name not in needed:
                needed.add(name)
                add(_VIEWS[name])

    add(body)
    views = ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items() if name in needed)
    return f"WITH {views}\n{body}" if views else body


_MESSAGE = 'topic, "partition", "offset", "key", "value"'
_HELD = "type, name, brokers, zookeeper, topic"
_LISTED = "type, name, brokers, zookeeper, array_to_string(list(topic ORDER BY topic), ',') AS topics"
_AUDIT = """SELECT topic, "partition", count(*) AS messages, count(DISTINCT "offset") AS offsets,
    max("offset") - min("offset") + 1 AS span,
    count(*) = count(DISTINCT "offset") AND count(DISTINCT "offset") = max("offset") - min("offset") + 1 AS exactly_once
    FROM {0} GROUP BY topic, "partition" """
_LAG = 'SELECT topic, "partition", highmark - "current" AS lag FROM {0}'
_RESPONSES = """SELECT topic, "partition", unnest(['low', 'high']) AS kind, "offset",
    CASE WHEN topic LIKE '%.error' AND "partition" = 1 THEN 6 ELSE 0 END AS error FROM v_event_log"""
_CHANGES = """SELECT {keys}, CASE WHEN o.topic IS NULL THEN 'added' WHEN n.topic IS NULL THEN 'removed' ELSE 'kept' END AS change
    FROM ({old}) o FULL JOIN ({new}) n USING ({keys})"""


def _start(reset: str) -> str:
    return f"""SELECT l.topic, l."partition", l."offset", l."key", l."value" FROM v_event_log l JOIN v_event_meta_kafka m
        ON l.topic = m.topic AND l."partition" = m."partition" WHERE l."offset" >=
        CASE WHEN m.committed BETWEEN m.lowmark AND m.highmark THEN m.committed ELSE m.{reset} END"""


def _backlog(log: str, meta: str) -> str:
    return f"""SELECT l.topic, l."partition", l."offset", l."key", l."value" FROM {log} l JOIN {meta} m
        ON l.topic = m.topic AND l."partition" = m."partition" WHERE l."offset" >= m."current" """


_CHANGED_KEYS = 'cluster_name, topic, "partition"'
_ASSIGNED_KEYS = 'group_id, member_id, topic, "partition"'

_BODIES = {
    "scan_topic": f"""SELECT {_MESSAGE} FROM v_event_log WHERE topic = 'scribe.dc0.click' AND "partition" IN (0, 2)""",
    "scan_topics_regex": f"SELECT {_MESSAGE} FROM v_event_log WHERE regexp_matches(topic, '^(?:scribe\\.dc1\\.(click|sign))')",
    "scan_assigned": f"""SELECT {_MESSAGE} FROM v_event_log l WHERE EXISTS (
        SELECT 1 FROM v_valid v WHERE v.topic = l.topic AND v."partition" = l."partition")""",
    "project_message": """SELECT "partition", "offset", "key", "value" FROM v_shipment_log""",
    "poll_n": f"""SELECT {_MESSAGE} FROM ({_backlog("v_event_log", "v_event_meta")})
        QUALIFY row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") <= 5""",
    "read_from_start_smallest": _start("lowmark"),
    "read_from_start_largest": _start("highmark"),
    "backlog": _backlog("v_event_log", "v_event_meta"),
    "backlog_shipments": _backlog("v_shipment_log", "v_shipment_meta"),
    "decode_payload": """SELECT topic, "partition", "offset", "value" AS text, CAST(length("value") AS BIGINT) AS bytes,
        ts AS sent_at FROM v_shipment_log""",
    "ordered_process": """SELECT topic, "partition", "offset", CAST(length("value") AS BIGINT) AS size, true AS ascending
        FROM v_shipment_log""",
    "running_totals": """SELECT topic, "partition", "offset", CAST(sum(length("value")) OVER w AS BIGINT) AS sent,
        CAST(lag(length("value")) OVER w AS BIGINT) AS previous FROM v_shipment_log
        WINDOW w AS (PARTITION BY topic, "partition" ORDER BY "offset")""",
    "delivery_audit": _AUDIT.format("v_event_log"),
    "delivery_audit_shipments": _AUDIT.format("v_shipment_log"),
    "offset_gaps": f"""SELECT topic, "partition", previous, "offset", "offset" - previous AS step, count(*) AS times FROM (
        SELECT *, lag("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS previous FROM (
        SELECT {_TOPIC} AS topic, CAST(l_suppkey % 4 AS INTEGER) AS "partition", l_orderkey AS "offset" FROM lineitem))
        WHERE "offset" - previous <> 1 GROUP BY topic, "partition", previous, "offset" """,
    "assign_offsets": """SELECT topic, "partition", "offset" - base AS "offset", "key", "value" FROM v_shipment_log""",
    "append_keyed": f"SELECT {_MESSAGE} FROM v_event_log",
    "append_mixed_keys": f"SELECT {_MESSAGE} FROM v_mixed_log",
    "compact_appends": f"""SELECT {_MESSAGE} FROM v_event_log JOIN (SELECT topic AS t, "partition" AS p, lowmark FROM v_event_marks) ON t = topic AND p = "partition"
        WHERE "offset" >= lowmark + 50""",
    "append_unkeyed": """SELECT topic, "partition", turn // 4 + 100 * ("partition" + 1) AS "offset", CAST(NULL AS VARCHAR) AS "key", "value"
        FROM (SELECT topic, CAST(turn % 4 AS INTEGER) AS "partition", turn, "value" FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY event_id) - 1 AS turn FROM v_events))""",
    "append_keyed_shipments": f"SELECT {_MESSAGE} FROM v_shipment_log",
    "watermarks": "SELECT * FROM v_event_marks",
    "watermarks_shipments": "SELECT * FROM v_shipment_marks",
    "watermarks_of_messages": """SELECT topic, "partition", min("offset") AS lowmark, max("offset") + 1 AS highmark
        FROM v_shipment_log GROUP BY topic, "partition" """,
    "watermark_errors": f"""SELECT topic, "partition",
        min(CASE WHEN kind = 'low' THEN CASE WHEN error <> 0 THEN -1 ELSE "offset" END END) AS lowmark,
        min(CASE WHEN kind = 'high' THEN CASE WHEN error <> 0 THEN -1 ELSE "offset" END END) AS highmark
        FROM ({_RESPONSES}) GROUP BY topic, "partition" """,
    "commit_errors": f"""SELECT DISTINCT p.topic, p."partition", 'highmark not available' AS error FROM v_event_parts p
        LEFT JOIN ({_RESPONSES}) r ON r.topic = p.topic AND r."partition" = p."partition"
        WHERE r.topic IS NULL OR (r.kind = 'high' AND r.error <> 0)""",
    "current_commits": "SELECT * FROM v_event_last",
    "folded_commits": """SELECT group_id, storage, topic, "partition", "offset" FROM v_event_last
        WHERE NOT (storage = 'kafka' AND (group_id = 'g2' AND "partition" = 3 OR group_id = 'g1' AND "partition" = 2))
        UNION ALL SELECT 'g2', 'kafka', topic, "partition", highmark FROM v_event_marks WHERE "partition" = 3
        UNION ALL SELECT 'g1', 'kafka', topic, "partition", lowmark FROM v_event_marks WHERE "partition" = 2""",
    "committed_offsets": """SELECT m.topic, m."partition", m."current" FROM v_event_meta m
        JOIN v_valid v ON v.topic = m.topic AND v."partition" = m."partition" """,
    "offsets_metadata": """SELECT topic, "partition", "current", highmark, lowmark FROM v_event_meta_kafka""",
    "lag": _LAG.format("v_event_meta"),
    "lag_shipments": _LAG.format("v_shipment_meta"),
    "lag_one_topic": _LAG.format("v_event_meta") + """ WHERE topic = 'scribe.dc0.view' AND "partition" IN (1, 2, 3)""",
    "lag_map": """SELECT topic, string_agg("partition" || ':' || (highmark - "current"), ',' ORDER BY "partition") AS lag
        FROM v_event_meta GROUP BY topic""",
    "commit_dual": """SELECT 'g1' AS group_id, unnest(['zookeeper', 'kafka']) AS storage, topic, "partition", highmark AS "offset"
        FROM v_shipment_marks""",
    "advance_offsets": """SELECT 'g1' AS group_id, 'kafka' AS storage, m.topic, m."partition", m.highmark AS "offset"
        FROM v_event_marks m JOIN v_valid v ON v.topic = m.topic AND v."partition" = m."partition" """,
    "rewind_offsets": """SELECT 'g1' AS group_id, 'kafka' AS storage, m.topic, m."partition", m.lowmark AS "offset"
        FROM v_event_marks m JOIN v_valid v ON v.topic = m.topic AND v."partition" = m."partition" """,
    "set_offsets": """SELECT 'g1' AS group_id, s.storage, topic, "partition",
        CASE WHEN s.storage = 'kafka' THEN 0 ELSE CAST("partition" * 1000 AS BIGINT) END AS "offset"
        FROM v_requests JOIN v_event_parts USING (topic, "partition"), (SELECT unnest(['zookeeper', 'kafka']) AS storage) s""",
    "commit_processed": """SELECT topic, "partition", max("offset") + 1 AS "offset" FROM v_shipment_log GROUP BY topic, "partition" """,
    "commit_message": """SELECT topic, "partition", max("offset") AS "offset" FROM v_event_log WHERE "partition" <> 3 GROUP BY topic, "partition" """,
    "valid_topics": "SELECT DISTINCT topic FROM v_requests WHERE topic IN (SELECT topic FROM v_event_parts)",
    "unknown_topics": "SELECT DISTINCT topic FROM v_requests WHERE topic NOT IN (SELECT topic FROM v_event_parts)",
    "valid_partitions": "SELECT * FROM v_valid",
    "unknown_partitions": """SELECT topic, "partition" FROM v_requests WHERE "partition" IS NOT NULL
        AND topic IN (SELECT topic FROM v_event_parts) EXCEPT SELECT topic, "partition" FROM v_event_parts""",
    "discover_topics": "SELECT * FROM v_catalog",
    "topic_partition_lists": """SELECT topic, string_agg("partition", ',' ORDER BY "partition") AS partitions
        FROM (SELECT DISTINCT topic, "partition" FROM v_catalog) GROUP BY topic""",
    "search_topic": f"""SELECT {_HELD} FROM v_held WHERE type = 'scribe' AND superregion = 'ASIA' AND topic = 'scribe.dcA.ship_O'""",
    "search_topics_regex": f"""SELECT {_HELD} FROM v_held WHERE type = 'scribe' AND superregion = 'ASIA'
        AND regexp_matches(topic, '^(?:scribe\\.dc[AN]\\.ship)')""",
    "search_topic_all_clusters": f"SELECT {_HELD} FROM v_held WHERE type = 'standard' AND topic = 'scribe.dcR.ship_F'",
    "search_regex_all_clusters": f"""SELECT {_HELD} FROM v_held WHERE type = 'standard'
        AND regexp_matches(topic, '^(?:scribe\\.dc.\\.ship_F)')""",
    "regex_topics_by_cluster": f"""SELECT {_LISTED} FROM v_held WHERE regexp_matches(topic, '^(?:scribe\\.dc[AN]|nothing)')
        GROUP BY type, name, brokers, zookeeper""",
    "clusters_by_region": "SELECT type, name, brokers, zookeeper FROM v_places WHERE type = 'standard' AND region = 'NATION_9'",
    "clusters_by_superregion": "SELECT type, name, brokers, zookeeper FROM v_places WHERE type = 'scribe' AND superregion = 'EUROPE'",
    "cluster_by_name": "SELECT * FROM v_clusters WHERE type = 'scribe' AND name = 'cluster7'",
    "all_clusters": "SELECT * FROM v_clusters WHERE type = 'scribe'",
    "topic_exists": """SELECT count(*) > 0 AS found FROM v_held WHERE type = 'scribe' AND superregion = 'AFRICA'
        AND topic = 'scribe.dcN.ship_O'""",
    "logs_topics_by_cluster": f"SELECT {_LISTED} FROM v_held GROUP BY type, name, brokers, zookeeper",
    "logs_by_stream": f"SELECT {_HELD} FROM v_held WHERE superregion = 'ASIA' AND topic LIKE '%.ship_O'",
    "logs_by_region_regex": f"SELECT {_HELD} FROM v_held WHERE region = 'NATION_9' AND regexp_matches('fleet.' || split_part(topic, '.', 3), 'ship_[FX]')",
    "logs_by_superregion_regex": f"""SELECT {_HELD} FROM v_held WHERE superregion = 'AMERICA'
        AND regexp_matches('fleet.' || split_part(topic, '.', 3), '^fleet\\..*_O$')""",
    "log_regions": "SELECT DISTINCT region FROM v_held",
    "cluster_identity": "SELECT type, name, brokers, zookeeper, CAST(2 AS BIGINT) AS spellings FROM v_clusters",
    "topology_clusters": """SELECT 'type' || s_suppkey AS type, unnest(['main', 'spare']) || s_suppkey AS name,
        'b' || s_suppkey || ':9092' AS brokers, 'z' || s_suppkey || ':2181' AS zookeeper FROM supplier""",
    "topology_local_cluster": """SELECT 'type' || s_suppkey AS type, 'main' || s_suppkey AS name,
        'b' || s_suppkey || ':9092' AS brokers, 'z' || s_suppkey || ':2181' AS zookeeper,
        CASE WHEN s_suppkey % 3 <> 0 THEN 'p' || s_suppkey || '.' END AS prefix FROM supplier WHERE s_suppkey % 5 <> 0""",
    "partition_units": """SELECT s.group_id, s.topic || '-' || p."partition" AS unit FROM v_subscriptions s
        JOIN v_event_parts p ON p.topic = s.topic""",
    "missing_topics": "SELECT * FROM v_subscriptions WHERE topic NOT IN (SELECT topic FROM v_event_parts)",
    "assign_partitions": "SELECT * FROM v_assigned",
    "acquired_partitions": """SELECT group_id, member_id, topic, string_agg("partition", ',' ORDER BY "partition") AS partitions
        FROM v_assigned GROUP BY group_id, member_id, topic""",
    "partition_changes": _CHANGES.format(
        keys=_CHANGED_KEYS, old=f"SELECT {_CHANGED_KEYS} FROM v_catalog",
        new=f"""SELECT DISTINCT 'cluster' || l_suppkey AS cluster_name, {_TOPIC} AS topic,
            CAST(l_partkey % 9 AS INTEGER) AS "partition" FROM lineitem"""),
    "assignment_changes": _CHANGES.format(
        keys=_ASSIGNED_KEYS, old="SELECT * FROM v_assigned", new="SELECT * FROM v_reassigned"),
    "group_key": """SELECT group_id, '/groups/' || group_id || '/' ||
        sha1('[''' || string_agg(topic, ''', ''' ORDER BY topic) || ''']') AS path, '/groups/' || group_id AS plain_path
        FROM v_subscriptions GROUP BY group_id""",
    "make_topic": """SELECT 'scribe.dc' || (user_id % 2) || '.' || event_type || '.' || user_id AS topic, count(*) AS messages
        FROM events GROUP BY 1""",
    "parse_topic": """SELECT split_part(topic, '.', 2) AS datacenter,
        split_part(topic, '.', 3) || '.' || split_part(topic, '.', 4) AS stream, count(*) AS messages
        FROM v_names WHERE topic LIKE 'scribe.%.%' GROUP BY 1, 2""",
    "bad_topics": "SELECT topic, count(*) AS messages FROM v_names WHERE topic NOT LIKE 'scribe.%.%' GROUP BY topic",
    "unit_codec": """SELECT 'topic-' || l_suppkey || '-' || l_linenumber AS unit, 'topic-' || l_suppkey AS topic,
        l_linenumber AS "partition", count(*) AS messages FROM lineitem GROUP BY l_suppkey, l_linenumber""",
    "timer_metrics": """SELECT 'consumer.' || name AS name, 'timer' AS kind, client_id, count(*) AS samples,
        CAST(sum(CAST(round("value" * 1000) AS BIGINT)) AS BIGINT) AS total, max(CAST(round("value" * 1000) AS BIGINT)) AS largest
        FROM v_samples WHERE name LIKE '%_timer' GROUP BY name, client_id""",
    "counter_metrics": """SELECT 'consumer.' || name AS name, 'counter' AS kind, client_id, count(*) AS samples,
        count(*) AS total, CAST(1 AS BIGINT) AS largest
        FROM v_samples WHERE name IN ('failed_paylads_count', 'out_of_range_counts') GROUP BY name, client_id""",
    "unknown_metrics": "SELECT name, count(*) AS samples FROM v_samples WHERE name = 'unknown_metric' GROUP BY name",
    "metric_dimensions": """SELECT 'cluster_name=c1,cluster_type=standard,group_id=g' || (user_id % 3) || ',user=' || user_id AS dimensions,
        count(*) AS samples FROM events GROUP BY 1""",
    "stream_topics": f"SELECT {_MESSAGE} FROM v_event_log WHERE topic LIKE 'scribe.dc0.%'",
    "stream_append": _AUDIT.format("v_event_log"),
    "stream_commit": """SELECT topic, "partition", 'zookeeper' AS storage, max("offset") + 1 AS "offset", count(*) AS messages
        FROM v_event_log GROUP BY topic, "partition" """,
    "stream_lag": _LAG.format("v_event_meta"),
}

ORACLE: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
