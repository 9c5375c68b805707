"""Telemetry text derived from the benchmark tables.

Projections that turn ``events``, ``customer`` and the other tables into log
lines, audit entries, event objects and API objects, deterministically, so that
expected results can be computed from the base columns alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAMESPACES = ["default", "kube-system", "monitoring", "ingress-nginx"]


#: rows of a base table that one task turns into telemetry, some hundred bytes each
TASK_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Narrow base rows over so many tasks that each has few; one file would be one task.

    The rows come from a few megabytes of Parquet, but their texts are parsed, sorted and
    shuffled further on.  Small tables stay where they are.
    """
    n_tasks = rows.count() // TASK_ROWS + 1
    return rows.repartition(n_tasks) if n_tasks > 1 else rows


def choose(index: str, values: list[str]) -> str:
    """SQL picking a value by position."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def namespace_of(key: str) -> str:
    return choose(f"{key} % 4", NAMESPACES)


def prefix_of(ts: str) -> str:
    """A 30-character time prefix; the source column has microseconds."""
    return f"""date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'000Z'")"""


def _json(*columns: Column) -> Column:
    """An object without the members that are NULL."""
    return F.to_json(F.struct(*columns))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A: namespace, pod_name, container_name, value, line_no."""
    events = spread(table(spark, sf_dir, "events"))
    message = """CASE event_id % 8
        WHEN 0 THEN '{"level":"error","msg":"m"}'
        WHEN 1 THEN '{"level":7,"severity":"warning"}'
        WHEN 2 THEN '{"level":"","severity":"fatal"}'
        WHEN 3 THEN concat('level="debug" user=', user_id)
        WHEN 4 THEN concat('log_level=trace Warning: ', value)
        WHEN 5 THEN concat('handled ', event_type) END"""
    line = f"""CASE WHEN event_id % 8 = 6 THEN 'short line'
        WHEN event_id % 8 = 7 THEN '   \t '
        ELSE concat({prefix_of('ts')}, ' ', {message}) END"""
    return events.select(
        F.expr(namespace_of("user_id")).alias("namespace"),
        F.expr("concat('pod-', user_id)").alias("pod_name"),
        F.expr("if(event_id % 2 = 0, 'app', 'sidecar')").alias("container_name"),
        F.expr(line).alias("value"),
        F.col("event_id").alias("line_no"),
    )


def write_logs(lines: DataFrame, root: str) -> None:
    """One file ``0.log`` per container below ``root``, in line order, written by tasks.

    A second call with more lines lets the files grow; a repeated task writes the same again.
    """
    keys = ["namespace", "pod_name", "container_name"]

    def write(batches):
        import pyarrow as pa

        from harborlight.sources.growing import opened

        system, inside = opened(root)
        now, out, n = None, None, 0
        for batch in batches:
            for *key, value, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if out:
                        out.close()
                    named = zip(keys, (v or "__HIVE_DEFAULT_PARTITION__" for v in key), strict=True)
                    folder = "/".join([inside, *(f"{k}={v}" for k, v in named)])
                    system.create_dir(folder)
                    now, out, n = key, system.open_output_stream(f"{folder}/0.log"), n + 1
                out.write((value or "").encode() + b"\n")
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    ordered = lines.repartition(*keys).sortWithinPartitions(*keys, "line_no")
    ordered.select(*keys, "value", "line_no").mapInArrow(write, "files long").agg({"files": "sum"}).collect()


def pod_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B: one pod object per customer."""
    key = "c_custkey"
    waiting = f"{key} % 10 = 9"

    def status(name: str, restarts: str) -> str:
        return f"""struct('{name}' AS name, cast({restarts} AS int) AS restartCount,
            struct(if({waiting}, map('reason', 'x'), NULL) AS waiting,
                   if({waiting}, NULL, map('startedAt', 'x')) AS running) AS state)"""

    pod = f"""struct('Pod' AS kind,
        struct(concat('pod-', {key}) AS name, {namespace_of(key)} AS namespace,
            map('app', lower(c_mktsegment), 'tier', concat('t', {key} % 3)) AS labels) AS metadata,
        struct(concat('node-', {key} % 7) AS nodeName,
            array(struct('app' AS name), struct('sidecar' AS name)) AS containers,
            array(struct('setup' AS name)) AS initContainers) AS spec,
        struct(array({status('app', key + ' % 5')}, {status('sidecar', key + ' % 2')})
            AS containerStatuses) AS status)"""
    return spread(table(spark, sf_dir, "customer")).select(F.to_json(F.expr(pod)).alias("value"))


AUDIT_VERBS = """CASE event_type WHEN 'click' THEN 'get' WHEN 'view' THEN 'list'
    WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'update' WHEN 'error' THEN 'delete' END"""
AUDIT_RESOURCES = ["pods", "secrets", "rolebindings", "clusterrolebindings", "services"]


def audit_lines(spark: SparkSession, sf_dir: str, also: Sequence[Column] = ()) -> DataFrame:
    """Fixture C: value, line_no, and ``also`` of the same event."""
    e = "event_id"
    resource = choose(f"{e} % 5", AUDIT_RESOURCES)
    stamp = prefix_of("ts")
    uri = f"""concat('/apis/x/', {resource}, '/', {e},
        if({e} % 29 = 0, '/escalate', ''), if({e} % 31 = 0, '/bind', ''))"""
    user = f"""CASE user_id % 3
        WHEN 0 THEN concat('"user":{{"username":"system:serviceaccount:', user_id, '"')
        WHEN 1 THEN concat('"user":{{"username":"user-', user_id, '"') END"""
    namespace = f"""if(user_id % 10 = 0, '', concat('"namespace":"', {namespace_of('user_id')}, '",'))"""
    sub = f"""CASE {e} % 6 WHEN 0 THEN ',"subresource":"exec"'
        WHEN 1 THEN ',"subresource":"portforward"' WHEN 2 THEN ',"subresource":"attach"'
        WHEN 3 THEN ',"subresource":"status"' ELSE '' END"""
    entry = f"""concat('{{"kind":"Event","apiVersion":"audit.k8s.io/v1","level":"', {AUDIT_LEVELS}, '",',
        if({e} % 13 = 0, '', concat('"auditID":"a-', {e} div 2, '",')),
        '"stage":"', if({e} % 2 = 0, 'RequestReceived', 'ResponseComplete'), '",',
        if({e} % 77 = 0, '', concat('"requestReceivedTimestamp":"', {stamp}, '",')),
        if({e} % 11 = 0, '', concat('"stageTimestamp":"', {stamp}, '",')),
        '"verb":', if({e} % 23 = 0, '5', concat('"', {AUDIT_VERBS}, '"')), ',',
        coalesce(concat({user}, if({e} % 2 = 0, concat(',"uid":"uid-', user_id, '"'), ''), ',"groups":["g', user_id % 5, '",7,"system:authenticated"]}},'), ''),
        '"objectRef":{{', {namespace}, '"resource":"', {resource}, '","name":"n-', {e}, '"', {sub}, '}},',
        '"requestURI":"', {uri}, '",',
        '"sourceIPs":["10.0.0.', user_id % 250, '","::1"],"userAgent":"ua-', user_id % 4, '",',
        '"responseStatus":{{"code":', {choose(e + ' % 5', ['200', '201', '401', '403', '403.0'])},
            if({e} % 5 > 1, ',"status":"Failure","reason":"Forbidden"', ''), '}},',
        '"annotations":{{"k":', value, '}}}}')"""
    line = f"""CASE WHEN {e} % 17 = 0 THEN 'not json'
        WHEN {e} % 19 = 0 THEN '{{"kind":"Pod","auditID":"x"}}'
        WHEN {e} % 37 = 0 THEN concat({entry}, ' trailing')
        ELSE {entry} END"""
    return spread(table(spark, sf_dir, "events")).select(
        F.expr(line).alias("value"), F.col("event_id").alias("line_no"), *also
    )


EVENT_REASONS = """CASE event_type WHEN 'error' THEN 'BackOff' WHEN 'click' THEN 'Pulled'
    WHEN 'view' THEN 'Scheduled' WHEN 'signup' THEN 'Created' WHEN 'purchase' THEN 'Killing' END"""
EVENT_OBJECTS = "CASE event_id % 7 WHEN 0 THEN 'Node' WHEN 1 THEN 'Deployment' ELSE 'Pod' END"
AUDIT_LEVELS = "CASE event_id % 7 WHEN 0 THEN 'Request' WHEN 3 THEN 'RequestResponse' ELSE 'Metadata' END"
EVENT_COMPONENTS = ["kubelet", "scheduler", "controller"]


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture D: value, line_no; later arrivals have lower resource versions."""
    return event_objects_of(spread(table(spark, sf_dir, "events")))


def event_objects_of(rows: DataFrame) -> DataFrame:
    """Fixture D of these rows of ``events``, in their order."""
    e = "event_id"
    first = f"""CASE {e} % 4 WHEN 0 THEN {prefix_of("ts - INTERVAL '1' HOUR")}
        WHEN 2 THEN {prefix_of('ts')} END"""
    event = f"""struct('Event' AS kind,
        struct({namespace_of('user_id')} AS namespace, cast(1000000000 - {e} AS string) AS resourceVersion,
            map('team', concat('t', user_id % 3)) AS labels) AS metadata,
        if(event_type = 'error', 'Warning', 'Normal') AS type,
        {EVENT_REASONS} AS reason,
        concat(event_type, ' on ', user_id, ' took ', cast(value AS string)) AS message,
        struct({EVENT_OBJECTS} AS kind, concat('pod-', user_id % 20) AS name,
            if({e} % 9 = 0, 'elsewhere', {namespace_of('user_id')}) AS namespace) AS involvedObject,
        struct({choose(e + ' % 3', EVENT_COMPONENTS)} AS component) AS source,
        {first} AS firstTimestamp,
        if({e} % 4 = 0, {prefix_of('ts')}, NULL) AS lastTimestamp,
        if({e} % 4 = 1, {prefix_of('ts')}, NULL) AS eventTime,
        cast(1 + {e} % 5 AS int) AS count)"""
    return rows.select(F.to_json(F.expr(event)).alias("value"), F.col("event_id").alias("line_no"))


POD_PHASES = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Running' WHEN 'AUTOMOBILE' THEN 'Pending'
    WHEN 'MACHINERY' THEN 'Failed' WHEN 'HOUSEHOLD' THEN 'Succeeded' ELSE 'Unknown' END"""
SERVICE_TYPES = ["ClusterIP", "NodePort", "LoadBalancer"]
CREATED = "2024-02-01T00:00:00Z"


def resource_pods(spark: SparkSession, sf_dir: str) -> DataFrame:
    pod = f"""struct('Pod' AS kind,
        struct(concat('pod-', c_custkey) AS name, replace(lower(n_name), '_', '-') AS namespace,
            concat('u-', c_custkey) AS uid, cast(c_custkey AS string) AS resourceVersion,
            date_format(timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(c_custkey AS int)),
                "yyyy-MM-dd'T'HH:mm:ss'Z'") AS creationTimestamp,
            map('app', lower(c_mktsegment)) AS labels,
            array(struct('apps/v1' AS apiVersion, 'Deployment' AS kind,
                concat('dep-', c_custkey % 100) AS name, 'u' AS uid,
                c_custkey % 2 = 0 AS controller)) AS ownerReferences) AS metadata,
        struct(concat('node-', c_custkey % 7) AS nodeName) AS spec,
        struct({POD_PHASES} AS phase, concat('10.1.0.', c_custkey % 250) AS podIP,
            if(c_custkey % 2 = 0, 'Burstable', NULL) AS qosClass,
            array(struct('app' AS name, cast(c_custkey % 5 AS int) AS restartCount),
                struct('sidecar' AS name, cast(c_custkey % 3 AS int) AS restartCount))
                AS containerStatuses,
            array(struct('Ready' AS type, if(c_custkey % 2 = 0, 'True', 'False') AS status,
                'because' AS reason, '{CREATED}' AS lastTransitionTime)) AS conditions) AS status)"""
    customers = spread(table(spark, sf_dir, "customer"))
    return _in_nation(customers, "c_nationkey", spark, sf_dir).select(
        F.to_json(F.expr(pod)).alias("value")
    )


def resource_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = f"""concat('{{"kind":"Service","metadata":{{"name":"svc-', s_suppkey, '","namespace":"',
        replace(lower(n_name), '_', '-'), '"}},"spec":{{"type":"', {choose('s_suppkey % 3', SERVICE_TYPES)},
        '","clusterIP":"10.2.0.', s_suppkey % 250, '","externalIPs":["1.1.1.', s_suppkey % 250,
        '",7]}}}}')"""
    suppliers = spread(table(spark, sf_dir, "supplier"))
    return _in_nation(suppliers, "s_nationkey", spark, sf_dir).select(
        F.expr(service).alias("value")
    )


def resource_workloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Deployment and a StatefulSet or DaemonSet per part."""
    ready = "cast(p_size * (p_partkey % 3) div 2 AS int)"
    available = "struct('Available' AS type, 'True' AS status)"
    stuck = "struct('Progressing' AS type, 'False' AS status)"
    conditions = f"""CASE p_partkey % 5 WHEN 1 THEN array({available}) WHEN 2 THEN array({stuck})
        WHEN 3 THEN array({available}, {stuck}) WHEN 4 THEN array({stuck}, {available}) END"""
    metadata = "struct(concat('{name}-', p_partkey) AS name, 'apps' AS namespace) AS metadata"
    deployment = f"""struct('Deployment' AS kind, {metadata.format(name='dep')},
        struct(p_size AS replicas) AS spec,
        if(p_partkey % 41 = 0, NULL,
            struct(if(p_partkey % 7 = 0, NULL, p_size) AS replicas, {ready} AS readyReplicas,
                {ready} AS availableReplicas, {conditions} AS conditions)) AS status)"""
    stateful = f"""struct('StatefulSet' AS kind, {metadata.format(name='set')},
        struct(p_size AS replicas) AS spec,
        struct(p_size AS replicas, {ready} AS readyReplicas) AS status)"""
    daemon = f"""struct('DaemonSet' AS kind, {metadata.format(name='set')},
        struct(p_size AS desiredNumberScheduled, p_size AS currentNumberScheduled,
            {ready} AS numberReady, p_size - 1 AS numberAvailable) AS status)"""
    parts = spread(table(spark, sf_dir, "part"))
    return parts.select(
        F.explode(
            F.array(
                F.to_json(F.expr(deployment)),
                F.when(F.expr("p_partkey % 2 = 0"), F.to_json(F.expr(stateful))).otherwise(
                    F.to_json(F.expr(daemon))
                ),
            )
        ).alias("value")
    )


def resource_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cluster-scoped volume or a claim per order."""
    volume = """struct(if(o_orderkey % 2 = 0, 'PersistentVolume', 'PersistentVolumeClaim') AS kind,
        struct(concat('vol-', o_orderkey) AS name,
            if(o_orderkey % 2 = 0, NULL, 'storage') AS namespace) AS metadata,
        struct(if(o_orderkey % 3 = 0, 'fast', 'slow') AS storageClassName, 'Filesystem' AS volumeMode,
            array('ReadWriteOnce', 'ReadOnlyMany') AS accessModes) AS spec,
        struct(CASE o_orderstatus WHEN 'F' THEN 'Bound' WHEN 'O' THEN 'Available'
            ELSE 'Released' END AS phase) AS status)"""
    return spread(table(spark, sf_dir, "orders")).select(F.to_json(F.expr(volume)).alias("value"))


def resource_network_and_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four objects per supplier and one of an unknown kind per customer."""
    meta = "struct(concat('{p}-', s_suppkey) AS name, replace(lower(n_name), '_', '-') AS namespace) AS metadata"
    data = """map_from_entries(transform(slice(array('a', 'b', 'c'), 1, s_suppkey % 4),
        k -> struct(k, concat('secret-value-', k))))"""
    ingress = f"""struct('Ingress' AS kind, {meta.format(p='ing')},
        struct('nginx' AS ingressClassName) AS spec,
        struct(struct(if(s_suppkey % 2 = 0, array(), array(map('ip', '9.9.9.9'))) AS ingress)
            AS loadBalancer) AS status)"""
    policy = f"struct('NetworkPolicy' AS kind, {meta.format(p='np')})"
    config = f"struct('ConfigMap' AS kind, {meta.format(p='cm')}, {data} AS data)"
    secret = f"""struct('Secret' AS kind, {meta.format(p='sec')}, {data} AS data,
        'Opaque' AS type)"""
    suppliers = _in_nation(spread(table(spark, sf_dir, "supplier")), "s_nationkey", spark, sf_dir)
    mine = suppliers.select(
        F.explode(
            F.array(*[F.to_json(F.expr(x)) for x in (ingress, policy, config, secret)])
        ).alias("value")
    )
    custom = """struct('CustomThing' AS kind, struct(concat('ct-', c_custkey) AS name) AS metadata,
        struct(if(c_custkey % 3 = 0, 'Synced', NULL) AS phase,
            if(c_custkey % 3 = 1, 'Lagging', NULL) AS state) AS status)"""
    customs = spread(table(spark, sf_dir, "customer")).select(F.to_json(F.expr(custom)).alias("value"))
    return mine.unionByName(customs)


def resource_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: API objects of all kinds."""
    parts = [
        resource_pods(spark, sf_dir),
        resource_services(spark, sf_dir),
        resource_workloads(spark, sf_dir),
        resource_volumes(spark, sf_dir),
        resource_network_and_config(spark, sf_dir),
    ]
    objects = parts[0]
    for part in parts[1:]:
        objects = objects.unionByName(part)
    return objects


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real text: every line of every document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )


def _in_nation(df: DataFrame, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return df.join(nation, df[key] == nation["n_nationkey"])
