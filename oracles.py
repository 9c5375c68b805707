"""Expected answers in DuckDB SQL, computed from base columns, never by parsing text."""

from __future__ import annotations

NS = """CASE {k} % 4 WHEN 0 THEN 'default' WHEN 1 THEN 'kube-system'
    WHEN 2 THEN 'monitoring' ELSE 'ingress-nginx' END"""
NS_USER = NS.format(k="user_id")
AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"
SINCE = "TIMESTAMP '2024-01-10 00:00:00'"
UNTIL = "TIMESTAMP '2024-01-20 06:30:00'"
FALLBACK = "TIMESTAMP '2024-03-01 00:00:00'"
RANGE_START = "TIMESTAMP '2023-12-31 00:00:00'"

# Fixture A. "size" is the line's length in bytes with its line break.
RAW_LOGS = f"""raw AS (
    SELECT event_id AS line_no, {NS_USER} AS namespace, 'pod-' || user_id AS pod_name,
        CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'sidecar' END AS container_name,
        event_id % 8 AS m, user_id, ts, event_type,
        CASE event_id % 8
            WHEN 0 THEN '{{"level":"error","msg":"m"}}'
            WHEN 1 THEN '{{"level":7,"severity":"warning"}}'
            WHEN 2 THEN '{{"level":"","severity":"fatal"}}'
            WHEN 3 THEN 'level="debug" user=' || user_id
            WHEN 4 THEN 'log_level=trace Warning: ' || value
            WHEN 5 THEN 'handled ' || event_type
            WHEN 6 THEN 'short line' ELSE '   ' || chr(9) || ' ' END AS text
    FROM events)"""
LOGS = f"""{RAW_LOGS}, sized AS (
    SELECT *, strlen(text) + CASE WHEN m < 6 THEN 31 ELSE 0 END + 1 AS size FROM raw),
logs AS (
    SELECT *, CASE WHEN m < 6 THEN ts END AS timestamp, text AS log_message,
        CASE m WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'FATAL' WHEN 3 THEN 'DEBUG'
            WHEN 4 THEN 'WARN' WHEN 5 THEN CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END
            ELSE 'INFO' END AS log_level
    FROM sized WHERE m < 7)"""
# Lines of pods that exist and have logs.
POD_LOGS = f"""{LOGS}, pod_logs AS (
    SELECT l.*, c_custkey, lower(c_mktsegment) AS app, 'node-' || c_custkey % 7 AS node_name,
        CAST(CASE WHEN container_name = 'app' THEN c_custkey % 5 ELSE c_custkey % 2 END AS INTEGER)
            AS restart_count
    FROM logs l JOIN customer ON c_custkey = user_id WHERE c_custkey % 10 <> 9)"""

# Fixture C.
AUDIT = f"""entries AS (
    SELECT *, event_id AS line_no,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS stage_timestamp,
        CASE WHEN event_id % 77 = 0 THEN NULL ELSE ts END AS request_received_time,
        CASE WHEN event_id % 13 = 0 THEN '' ELSE 'a-' || event_id // 2 END AS audit_id,
        CASE event_id % 7 WHEN 0 THEN 'Request' WHEN 3 THEN 'RequestResponse' ELSE 'Metadata' END AS level,
        CASE WHEN user_id % 3 < 2 AND event_id % 2 = 0 THEN 'uid-' || user_id END AS user_uid,
        CASE WHEN event_id % 5 > 1 THEN 'Failure' END AS response_status,
        CASE WHEN event_id % 5 > 1 THEN 'Forbidden' END AS response_reason,
        CASE WHEN event_id % 2 = 0 THEN 'RequestReceived' ELSE 'ResponseComplete' END AS stage,
        CASE WHEN event_id % 23 = 0 THEN '' ELSE CASE event_type WHEN 'click' THEN 'get'
            WHEN 'view' THEN 'list' WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'update'
            ELSE 'delete' END END AS verb,
        CASE user_id % 3 WHEN 0 THEN 'system:serviceaccount:' || user_id
            WHEN 1 THEN 'user-' || user_id END AS user_name,
        CASE WHEN user_id % 3 < 2 THEN 'g' || user_id % 5 END AS first_group,
        CASE WHEN user_id % 10 = 0 THEN NULL ELSE {NS_USER} END AS namespace,
        CASE event_id % 5 WHEN 0 THEN 'pods' WHEN 1 THEN 'secrets' WHEN 2 THEN 'rolebindings'
            WHEN 3 THEN 'clusterrolebindings' ELSE 'services' END AS resource,
        CASE event_id % 6 WHEN 0 THEN 'exec' WHEN 1 THEN 'portforward' WHEN 2 THEN 'attach'
            WHEN 3 THEN 'status' END AS subresource,
        'n-' || event_id AS name,
        CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 201 WHEN 2 THEN 401 ELSE 403 END
            AS response_code,
        '10.0.0.' || user_id % 250 AS ip,
        'ua-' || user_id % 4 AS user_agent
    FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 37 <> 0),
audit_logs AS (
    SELECT *, '/apis/x/' || resource || '/' || event_id
            || CASE WHEN event_id % 29 = 0 THEN '/escalate' ELSE '' END
            || CASE WHEN event_id % 31 = 0 THEN '/bind' ELSE '' END AS request_uri,
        ip || ',::1' AS source_ips,
        first_group || ',system:authenticated' AS user_groups,
        coalesce(stage_timestamp, request_received_time) AS tp_timestamp
    FROM entries)"""
# Fallback identity: time text has its fraction's trailing zeros cut.
AUDIT_ID = """CASE WHEN audit_id <> '' THEN audit_id ELSE
    verb || '|' || resource || '|' || coalesce(namespace, '') || '|' || name || '|' || request_uri
    || '|' || regexp_replace(regexp_replace(strftime(
        coalesce(tp_timestamp, {start}), '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), '\\.$', '') || 'Z' END"""
KEYED_AUDIT = f"""{AUDIT}, keyed AS (
    SELECT *, {AUDIT_ID.format(start=RANGE_START)} AS row_id,
        epoch_us(coalesce(tp_timestamp, {RANGE_START})) // 1000 AS row_ms, 'p1' AS tp_partition,
        CAST(tp_timestamp AS DATE) AS tp_date
    FROM audit_logs)"""

# Fixture D.
EVENTS = f"""cluster AS (
    SELECT *, event_id AS line_no, {NS_USER} AS namespace,
        CASE WHEN event_type = 'error' THEN 'Warning' ELSE 'Normal' END AS etype,
        CASE event_type WHEN 'error' THEN 'BackOff' WHEN 'click' THEN 'Pulled'
            WHEN 'view' THEN 'Scheduled' WHEN 'signup' THEN 'Created' ELSE 'Killing' END AS reason,
        event_type || ' on ' || user_id || ' took ' || value AS message,
        CASE event_id % 7 WHEN 0 THEN 'Node' WHEN 1 THEN 'Deployment' ELSE 'Pod' END AS object_kind,
        CASE WHEN event_id % 9 = 0 THEN 'elsewhere' ELSE {NS_USER} END AS involved, 'pod-' || user_id % 20 AS object_name,
        CASE event_id % 3 WHEN 0 THEN 'kubelet' WHEN 1 THEN 'scheduler' ELSE 'controller' END
            AS source_component,
        CASE event_id % 4 WHEN 0 THEN ts - INTERVAL 1 HOUR WHEN 2 THEN ts END AS first_timestamp,
        CASE WHEN event_id % 4 IN (0, 1) THEN ts END AS last_timestamp,
        1 + event_id % 5 AS n
    FROM events),
evts AS (
    SELECT *, coalesce(last_timestamp, first_timestamp, {FALLBACK}) AS timestamp,
        md5(namespace || ':' || reason || ':' || object_kind || ':' || object_name || ':'
            || source_component) AS deduplication_key
    FROM cluster)"""
MERGED = f"""{EVENTS}, merged AS (
    SELECT deduplication_key,
        arg_min(namespace, line_no) AS namespace, arg_min(etype, line_no) AS event_type,
        arg_min(reason, line_no) AS reason, arg_min(message, line_no) AS message,
        arg_min(object_kind, line_no) AS object_kind, arg_min(object_name, line_no) AS object_name,
        arg_min(source_component, line_no) AS source_component,
        CAST(sum(n) AS BIGINT) AS count,
        arg_max(last_timestamp, line_no) FILTER (WHERE last_timestamp IS NOT NULL)
            AS last_timestamp,
        arg_min({{'t': timestamp}}, line_no).t AS first_seen,
        arg_min({{'t': first_timestamp}}, line_no).t AS first_timestamp
    FROM evts {{where}} GROUP BY deduplication_key)"""
MERGED_COLUMNS = """deduplication_key, namespace, event_type, reason, message, object_kind,
    object_name, source_component, count, coalesce(last_timestamp, first_seen) AS timestamp,
    first_timestamp, last_timestamp"""


def merged(where: str = "") -> str:
    return MERGED.replace("{where}", where).replace("{{", "{").replace("}}", "}")


# Fixture E.
POD_STATUS = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Running' WHEN 'AUTOMOBILE' THEN 'Pending'
    WHEN 'MACHINERY' THEN 'Failed' WHEN 'HOUSEHOLD' THEN 'Succeeded' ELSE 'Unknown' END"""
READY = "p_size * (p_partkey % 3) // 2"
REPLICA_RULE = f"""CASE WHEN {READY} = 0 THEN 'Pending' WHEN {READY} < p_size THEN 'Updating'
    ELSE 'Ready' END"""
DEPLOYMENT_STATUS = f"""CASE WHEN p_partkey % 41 = 0 THEN ''
    WHEN p_partkey % 5 IN (1, 3) THEN 'Ready' WHEN p_partkey % 5 IN (2, 4) THEN 'Failed'
    WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE {REPLICA_RULE} END"""
PODS = f"""pods AS (
    SELECT *, 'Pod' AS resource_type, 'pod-' || c_custkey AS resource_name,
        replace(lower(n_name), '_', '-') AS namespace, {POD_STATUS} AS status, 'node-' || c_custkey % 7 AS node_name,
        TIMESTAMP '2024-01-01' + to_hours(CAST(c_custkey AS INTEGER)) AS created_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
RESOURCES = f"""{PODS}, located AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey), resources AS (
    SELECT namespace, resource_type, resource_name, status, node_name, created_at FROM pods
    UNION ALL SELECT replace(lower(n_name), '_', '-'), 'Service', 'svc-' || s_suppkey, 'Active', '', NULL
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'apps', 'Deployment', 'dep-' || p_partkey, {DEPLOYMENT_STATUS}, '', NULL
        FROM part
    UNION ALL SELECT 'apps', CASE WHEN p_partkey % 2 = 0 THEN 'StatefulSet' ELSE 'DaemonSet' END,
        'set-' || p_partkey, {REPLICA_RULE}, '', NULL FROM part
    UNION ALL SELECT CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'storage' END,
        CASE WHEN o_orderkey % 2 = 0 THEN 'PersistentVolume' ELSE 'PersistentVolumeClaim' END,
        'vol-' || o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Bound' WHEN 'O' THEN 'Available'
            ELSE 'Released' END, '', NULL FROM orders
    UNION ALL SELECT replace(lower(n_name), '_', '-'), 'Ingress', 'ing-' || s_suppkey,
        CASE WHEN s_suppkey % 2 = 0 THEN 'Active' ELSE 'Ready' END, '', NULL FROM located
    UNION ALL SELECT replace(lower(n_name), '_', '-'), 'NetworkPolicy', 'np-' || s_suppkey, 'Active', '', NULL
        FROM located
    UNION ALL SELECT replace(lower(n_name), '_', '-'), 'ConfigMap', 'cm-' || s_suppkey, 'Active', '', NULL FROM located
    UNION ALL SELECT replace(lower(n_name), '_', '-'), 'Secret', 'sec-' || s_suppkey, 'Active', '', NULL FROM located
    UNION ALL SELECT '', 'CustomThing', 'ct-' || c_custkey, CASE c_custkey % 3
        WHEN 0 THEN 'Synced' WHEN 1 THEN 'Lagging' ELSE 'Active' END, '', NULL FROM customer)"""

KEYS = "namespace, pod_name, container_name"
PER_CONTAINER = f"PARTITION BY {KEYS} ORDER BY line_no"


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    o["pod_log_parse"] = f"""WITH {LOGS} SELECT line_no, {KEYS}, timestamp,
        CASE WHEN m < 6 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '000Z' END AS ts_raw,
        log_message FROM logs"""
    o["pod_log_levels"] = f"WITH {LOGS} SELECT line_no, log_level FROM logs"
    o["pod_log_doc_levels"] = """WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
        levels AS (SELECT doc_id, CASE WHEN contains(upper(line), 'FATAL') THEN 'FATAL'
            WHEN contains(upper(line), 'ERROR') THEN 'ERROR'
            WHEN contains(upper(line), 'WARN') THEN 'WARN'
            WHEN contains(upper(line), 'INFO') THEN 'INFO'
            WHEN contains(upper(line), 'DEBUG') THEN 'DEBUG'
            WHEN contains(upper(line), 'TRACE') THEN 'TRACE' ELSE 'INFO' END AS log_level
        FROM lines WHERE regexp_matches(line, '\\S'))
        SELECT doc_id, log_level, count(*) AS lines FROM levels GROUP BY ALL"""
    o["pod_log_enrich"] = f"""WITH {POD_LOGS} SELECT line_no, {KEYS}, log_level, node_name, app,
        CAST(0 AS INTEGER) AS annotations, restart_count, 'blue' AS cluster_name,
        'blue' AS tp_source_name, 'kubernetes_pod_logs' AS tp_source_type
        FROM pod_logs WHERE c_custkey % 3 = 1 AND c_custkey % 10 <= 8"""
    o["pod_containers"] = f"""SELECT {NS.format(k='c_custkey')} AS namespace,
        'pod-' || c_custkey AS pod_name, c.name AS container_name,
        CAST(c.i AS INTEGER) AS container_index, 'node-' || c_custkey % 7 AS node_name,
        CAST(CASE c.i WHEN 0 THEN c_custkey % 5 WHEN 1 THEN c_custkey % 2 ELSE 0 END AS INTEGER)
            AS restart_count, c_custkey % 10 <> 9 AS has_logs
        FROM customer, (VALUES (0, 'app'), (1, 'sidecar'), (2, 'setup')) AS c(i, name)"""
    o["pod_log_tail"] = f"""WITH {RAW_LOGS} SELECT line_no, {KEYS} FROM raw
        QUALIFY row_number() OVER ({PER_CONTAINER} DESC) <= 3"""
    o["pod_log_long_tail"] = f"""WITH {RAW_LOGS} SELECT line_no, {KEYS} FROM raw
        QUALIFY row_number() OVER (
            PARTITION BY namespace, container_name ORDER BY line_no DESC) <= 1001"""
    o["pod_log_row_limit"] = f"""WITH {LOGS} SELECT line_no, log_level FROM logs
        WHERE log_level IN ('ERROR', 'INFO') QUALIFY row_number() OVER ({PER_CONTAINER}) <= 2"""
    o["pod_log_byte_limit"] = f"""WITH {LOGS} SELECT line_no, {KEYS} FROM sized
        QUALIFY sum(size) OVER ({PER_CONTAINER} ROWS UNBOUNDED PRECEDING) <= 200"""
    o["pod_log_filtered"] = f"""WITH {POD_LOGS}
        SELECT line_no, namespace, pod_name, timestamp, log_level FROM (
            SELECT * FROM pod_logs WHERE namespace IN ('default', 'monitoring')
                AND log_level IN ('ERROR', 'INFO', 'WARN')
                AND (timestamp IS NULL OR timestamp BETWEEN {SINCE} AND {UNTIL})
            QUALIFY row_number() OVER ({PER_CONTAINER}) <= 4)
        ORDER BY {KEYS}, line_no LIMIT 500"""
    o["enriched_rows"] = f"""WITH {POD_LOGS} SELECT line_no, '' AS cluster_name,
        'kubernetes_pod_logs' AS tp_source_name, 'kubernetes_pod_logs' AS tp_source_type
        FROM pod_logs WHERE log_level = 'FATAL'"""

    o["audit_parse"] = f"""WITH {AUDIT} SELECT line_no, 'Event' AS kind,
        'audit.k8s.io/v1' AS api_version, level, audit_id, stage, request_uri, verb,
        user_name, user_uid, false AS impersonated, namespace, resource,
        subresource, name, user_agent, response_code, response_status, response_reason,
        '' AS cluster_name, user_groups, source_ips, request_received_time, stage_timestamp,
        value AS annotation_k FROM audit_logs"""
    o["audit_filter"] = f"""WITH {AUDIT} SELECT line_no, verb, resource, namespace, stage_timestamp
        FROM audit_logs WHERE (tp_timestamp IS NULL OR tp_timestamp BETWEEN {SINCE} AND {UNTIL})
        AND namespace IN ('default', 'monitoring') AND resource IN ('pods', 'secrets')
        AND verb IN ('get', 'list', 'create') AND stage = 'ResponseComplete'
        AND level = 'Metadata'"""
    o["audit_filter_users"] = f"""WITH {AUDIT} SELECT line_no, user_name, user_agent FROM audit_logs
        WHERE user_name IN ('user-1', 'user-4', 'system:serviceaccount:3', 'user-100')
        AND user_agent IN ('ua-0', 'ua-1', 'ua-3')"""
    o["audit_filter_groups_ips_codes"] = f"""WITH {AUDIT}
        SELECT line_no, response_code, user_groups, source_ips FROM audit_logs
        WHERE first_group IN ('g1', 'g3') AND user_id % 250 % 3 = 0 AND response_code IN (401, 403)"""
    o["audit_enrich"] = f"""WITH {KEYED_AUDIT} SELECT line_no, row_id AS tp_id, tp_timestamp, tp_date,
        'kubernetes_audit_logs' AS tp_table, tp_partition, 'blue' AS tp_source_name,
        'kubernetes_audit_logs' AS tp_source_type FROM keyed"""
    o["audit_dedup"] = f"""WITH {KEYED_AUDIT} SELECT line_no, verb, resource, row_id, row_ms FROM keyed
        QUALIFY row_number() OVER (PARTITION BY row_id, row_ms ORDER BY line_no) = 1"""
    o["audit_source_cascade"] = f"""WITH {AUDIT}
        SELECT audit_id, stage, verb, request_uri, stage_timestamp
        FROM audit_logs WHERE event_id % 4 = 2"""
    o["audit_file_limit"] = f"""WITH {AUDIT} SELECT request_uri, verb FROM audit_logs
        WHERE verb IN ('get', 'list')
        QUALIFY row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) <= 7"""
    o["audit_tail"] = f"""WITH {AUDIT}, tail AS (
            SELECT event_id FROM events
            QUALIFY row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id DESC) <= 50)
        SELECT request_uri, verb FROM audit_logs JOIN tail USING (event_id)"""
    o["audit_apiserver_lines"] = f"""WITH {AUDIT} SELECT line_no, verb, resource FROM audit_logs
        JOIN customer ON c_custkey = user_id WHERE user_id % 4 = 1 AND user_id % 5 IN (0, 1)"""
    o["audit_collector_lines"] = f"""WITH {AUDIT} SELECT line_no, verb, resource FROM audit_logs
        JOIN customer ON c_custkey = user_id WHERE user_id % 5 = 2"""
    o["sink_partitioned"] = f"""WITH {KEYED_AUDIT}
        SELECT line_no, verb, resource, tp_partition, tp_date FROM keyed"""

    o["event_parse"] = f"""WITH {EVENTS} SELECT line_no, namespace, etype AS event_type, reason, message,
        object_kind, object_name, CAST(NULL AS VARCHAR) AS object_uid, source_component,
        CAST(NULL AS VARCHAR) AS source_host, n AS count, deduplication_key, timestamp,
        first_timestamp, last_timestamp FROM evts"""
    o["event_filter"] = f"""WITH {EVENTS} SELECT line_no, reason, object_name, timestamp FROM evts
        WHERE coalesce(CASE WHEN event_id % 4 = 0 THEN ts END, first_timestamp, last_timestamp)
            BETWEEN {SINCE} AND {UNTIL}
        AND namespace IN ('default', 'kube-system') AND user_id % 20 % 3 = 0
        AND source_component IN ('kubelet', 'controller') AND user_id % 3 = 0
        AND event_type IN ('error', 'click')
        AND CAST(substr(split_part(CAST(value AS VARCHAR), '.', 2), 1, 1) AS INTEGER) <= 4"""
    o["event_namespace"] = f"""WITH {EVENTS} SELECT line_no, namespace FROM evts
        WHERE namespace = 'monitoring' AND involved = 'monitoring'"""
    o["event_merge"] = f"WITH {merged()} SELECT {MERGED_COLUMNS} FROM merged"
    o["event_limit"] = f"""WITH {merged("WHERE etype = 'Warning'")}
        SELECT deduplication_key, object_name, count FROM merged ORDER BY deduplication_key LIMIT 25"""

    o["resource_rows"] = f"""WITH {RESOURCES} SELECT namespace, resource_type, resource_name,
        'blue' AS cluster_name, 'blue' AS tp_source_name FROM resources"""
    o["resource_pods"] = f"""WITH {PODS} SELECT namespace, resource_name, status, node_name,
        'u-' || c_custkey AS uid, CAST(c_custkey AS VARCHAR) AS resource_version,
        '10.1.0.' || c_custkey % 250 AS pod_ip, status AS phase,
        CAST(c_custkey % 5 + c_custkey % 3 AS INTEGER) AS restart_count,
        CASE WHEN c_custkey % 2 = 0 THEN 'Burstable' END AS qos_class, created_at,
        lower(c_mktsegment) AS app, CAST(0 AS INTEGER) AS annotations, node_name AS spec_node
        FROM pods"""
    o["resource_services"] = """SELECT replace(lower(n_name), '_', '-') AS namespace, 'svc-' || s_suppkey AS resource_name,
        'Active' AS status, CASE s_suppkey % 3 WHEN 0 THEN 'ClusterIP' WHEN 1 THEN 'NodePort'
            ELSE 'LoadBalancer' END AS service_type, '10.2.0.' || s_suppkey % 250 AS cluster_ip,
        '1.1.1.' || s_suppkey % 250 AS external_ips
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
    o["resource_status"] = f"""WITH {RESOURCES}
        SELECT resource_type, resource_name, status FROM resources"""
    o["resource_replicas"] = f"""WITH counters AS (
        SELECT 'Deployment' AS resource_type, 'dep-' || p_partkey AS resource_name,
            p_partkey % 41 <> 0 AS known, p_size AS desired,
            CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size END AS current, {READY} AS ready,
            0 AS updated, {READY} AS available, 0 AS unavailable FROM part
        UNION ALL SELECT 'StatefulSet', 'set-' || p_partkey, true, p_size, p_size, {READY}, 0, 0, 0
            FROM part WHERE p_partkey % 2 = 0
        UNION ALL SELECT 'DaemonSet', 'set-' || p_partkey, true, p_size, p_size, {READY}, 0,
            p_size - 1, 0 FROM part WHERE p_partkey % 2 = 1)
        SELECT resource_type, resource_name, CAST(CASE WHEN known THEN desired END AS INTEGER) AS desired,
            CAST(CASE WHEN known THEN current END AS INTEGER) AS current,
            CAST(CASE WHEN known THEN ready END AS INTEGER) AS ready,
            CAST(CASE WHEN known THEN updated END AS INTEGER) AS updated,
            CAST(CASE WHEN known THEN available END AS INTEGER) AS available,
            CAST(CASE WHEN known THEN unavailable END AS INTEGER) AS unavailable FROM counters"""
    o["resource_volumes"] = """SELECT CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'storage' END AS namespace,
        CASE WHEN o_orderkey % 2 = 0 THEN 'PersistentVolume' ELSE 'PersistentVolumeClaim' END
            AS resource_type, 'vol-' || o_orderkey AS resource_name,
        CASE o_orderstatus WHEN 'F' THEN 'Bound' WHEN 'O' THEN 'Available' ELSE 'Released' END AS status,
        CASE WHEN o_orderkey % 3 = 0 THEN 'fast' ELSE 'slow' END AS storage_class,
        'Filesystem' AS volume_mode, 'ReadWriteOnce,ReadOnlyMany' AS access_modes FROM orders"""
    o["resource_owner_conditions"] = f"""WITH {PODS} SELECT resource_name, CAST(1 AS INTEGER) AS owners,
        'Deployment' AS owner_kind, 'dep-' || c_custkey % 100 AS owner_name,
        c_custkey % 2 = 0 AS owner_controller, 'Ready' AS condition_type,
        CASE WHEN c_custkey % 2 = 0 THEN 'True' ELSE 'False' END AS condition_status,
        CAST(NULL AS VARCHAR) AS condition_message, TIMESTAMP '2024-02-01' AS condition_time FROM pods"""
    o["resource_filter"] = f"""WITH {RESOURCES}
        SELECT namespace, resource_type, resource_name, status, node_name FROM resources
        WHERE (created_at IS NULL OR created_at BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-02-01')
        AND namespace IN ('', 'nation-2', 'nation-7', 'apps')
        AND resource_type IN ('Pod', 'Deployment', 'PersistentVolume')
        AND status IN ('Running', 'Failed', 'Ready', 'Bound')
        AND node_name IN ('', 'node-1', 'node-2', 'node-5')
        AND right(resource_name, 1) IN ('1', '2', '3', '4', '5', '6')
        ORDER BY namespace, resource_type, resource_name LIMIT 400"""
    o["resource_filter_labels"] = f"""WITH {PODS} SELECT namespace, resource_name, status FROM pods
        WHERE c_mktsegment = 'MACHINERY' AND c_custkey % 7 = 0 AND c_custkey < 1500"""
    o["resource_secret_redaction"] = """SELECT k.kind AS resource_type, k.p || s_suppkey AS resource_name,
        CAST(s_suppkey % 4 AS INTEGER) AS data_keys,
        CASE WHEN k.kind = 'Secret' THEN 'Opaque' END AS secret_type, false AS leaks
        FROM supplier, (VALUES ('ConfigMap', 'cm-'), ('Secret', 'sec-')) AS k(kind, p)"""

    o["q1_recent_errors"] = f"""WITH {POD_LOGS} SELECT timestamp, namespace, pod_name, log_message
        FROM pod_logs WHERE log_level = 'ERROR' AND timestamp > {AS_OF} - INTERVAL 1 HOUR
        ORDER BY timestamp DESC"""
    o["q2_backoff_warnings"] = f"""WITH {merged()} SELECT namespace, object_name, message, count
        FROM merged WHERE reason = 'BackOff' AND event_type = 'Warning' ORDER BY last_timestamp DESC"""
    o["q3_pods_per_namespace"] = f"""WITH {PODS} SELECT namespace, count(*) AS pod_count
        FROM pods GROUP BY namespace"""
    o["q4_failed_authentication"] = f"""WITH {AUDIT}
        SELECT stage_timestamp, user_name, source_ips, request_uri, response_code FROM audit_logs
        WHERE response_code IN (401, 403) AND stage_timestamp > {AS_OF} - INTERVAL 1 HOUR
        ORDER BY stage_timestamp DESC"""
    o["q5_secret_access"] = f"""WITH {AUDIT}
        SELECT stage_timestamp, user_name, verb, namespace, name, response_code FROM audit_logs
        WHERE resource = 'secrets' AND verb IN ('get', 'list') ORDER BY stage_timestamp DESC"""
    o["q6_human_admin_changes"] = f"""WITH {AUDIT}
        SELECT stage_timestamp, user_name, verb, resource, namespace, name, response_code
        FROM audit_logs WHERE verb IN ('create', 'update', 'patch', 'delete')
        AND user_name NOT LIKE 'system:%' ORDER BY stage_timestamp DESC"""
    o["q7_privilege_escalation"] = f"""WITH {AUDIT}
        SELECT stage_timestamp, user_name, request_uri, source_ips, response_code FROM audit_logs
        WHERE event_id % 29 = 0 OR event_id % 31 = 0 OR event_id % 5 IN (2, 3)
        ORDER BY stage_timestamp DESC"""
    o["q8_interactive_access"] = f"""WITH {AUDIT}
        SELECT stage_timestamp, user_name, namespace, name AS pod_name, subresource, source_ips
        FROM audit_logs WHERE subresource IN ('exec', 'portforward', 'attach')
        ORDER BY stage_timestamp DESC"""

    o["scan_pod_logs"] = f"""WITH {POD_LOGS}, tail AS (
            SELECT line_no FROM raw QUALIFY row_number() OVER ({PER_CONTAINER} DESC) <= 5)
        SELECT {KEYS}, timestamp, log_level, log_message FROM pod_logs JOIN tail USING (line_no)
        WHERE namespace IN ('kube-system', 'monitoring')"""
    o["log_manifest"] = f"""WITH {RAW_LOGS} SELECT {KEYS}, count(*) AS n_lines,
            count(*) FILTER (WHERE m = 6) AS n_undated,
            sum(strlen(text) + CASE WHEN m < 6 THEN 32 ELSE 1 END)::BIGINT AS read_bytes,
            min(ts) FILTER (WHERE m < 6) AS first_time, max(ts) FILTER (WHERE m < 6) AS last_time
        FROM raw GROUP BY ALL"""
    o["scan_listed_logs"] = f"""WITH {POD_LOGS} SELECT {KEYS}, timestamp, log_level, log_message
        FROM pod_logs WHERE namespace IN ('kube-system', 'monitoring')
        AND (timestamp IS NULL OR timestamp BETWEEN {SINCE} AND {UNTIL})"""
    o["pod_log_two_dumps"] = o["pod_log_enrich"]
    o["resource_newest"] = o["resource_pods"]
    o["pod_log_collect_once"] = f"""WITH {LOGS} SELECT line_no, {KEYS}, timestamp FROM logs
        QUALIFY row_number() OVER (PARTITION BY {KEYS}, timestamp ORDER BY line_no) = 1"""
    o["event_collect_once"] = f"""WITH {EVENTS} SELECT line_no, message, deduplication_key AS row_id,
        epoch_us(timestamp) // 1000 AS row_ms FROM evts
        QUALIFY row_number() OVER (PARTITION BY deduplication_key, epoch_us(timestamp) // 1000 ORDER BY line_no) = 1"""
    o["scan_events"] = o["event_merge"]
    o["scan_resources"] = f"""WITH {RESOURCES} SELECT resource_type, status, count(*) AS objects,
        count(DISTINCT resource_name) AS names FROM resources GROUP BY ALL"""
    o["stream_event_merge"] = o["event_merge"]
    first_half = "WHERE line_no < (SELECT count(*) // 2 FROM events)"
    numbered = "SELECT * REPLACE (row_number() OVER (ORDER BY line_no) - 1 AS line_no) FROM evts"
    o["stream_event_backlog"] = o["event_merge"].replace("FROM evts", f"FROM ({numbered}) {first_half}")
    o["stream_log_follow"] = f"""WITH {POD_LOGS} SELECT {KEYS}, timestamp, log_level, node_name
        FROM pod_logs WHERE log_level IN ('ERROR', 'FATAL') AND (timestamp IS NULL OR timestamp >= {SINCE})"""
    o["stream_log_growth"] = f"WITH {LOGS} SELECT {KEYS}, timestamp, log_message FROM logs"
    o["stream_collect_once"] = f"""WITH {KEYED_AUDIT} SELECT verb, resource, row_id, row_ms FROM keyed
        QUALIFY row_number() OVER (PARTITION BY row_id, row_ms ORDER BY line_no) = 1"""
    return o
