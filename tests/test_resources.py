from __future__ import annotations

import datetime as dt
import json
import warnings

import pytest

from harborlight import schemas
from harborlight.operators import resources
from helpers import lines, optimized


def obj(kind, name="x", **parts) -> str:
    meta = {"name": name, **parts.pop("metadata", {})}
    return json.dumps({"kind": kind, "metadata": meta, **parts})


def rows(spark, *texts, **kw):
    return resources.parse_resources(lines(spark, *texts), **kw)


def status_of(spark, kind, **parts):
    return rows(spark, obj(kind, **parts)).first().status


def test_common_part(spark):
    text = obj(
        "Pod",
        metadata={
            "namespace": "ns",
            "uid": "u",
            "resourceVersion": "5",
            "creationTimestamp": "2024-01-01T00:00:00Z",
            "labels": {"a": "b"},
        },
    )
    row = rows(spark, text).first()
    assert (row.namespace, row.resource_name, row.uid, row.resource_version) == ("ns", "x", "u", "5")
    assert row.created_at == dt.datetime(2024, 1, 1) and row.labels == {"a": "b"}
    assert row.annotations == {} and row.status == "" and row.node_name == ""
    assert (row.spec, row.status_details, row.owner_references, row.conditions) == (None,) * 4


def test_objects_without_metadata_are_dropped(spark):
    texts = ['{"kind":"Pod"}', '{"kind":"Pod","metadata":"x"}', "junk", "[]", obj("Pod", "y")]
    assert [r.resource_name for r in rows(spark, *texts).collect()] == ["y"]
    nameless = rows(spark, '{"metadata":{"name":5,"labels":"x"}}').first()
    assert (nameless.resource_type, nameless.resource_name, nameless.labels) == ("", "", {})


def test_pod(spark):
    text = obj(
        "Pod",
        spec={"nodeName": "n"},
        status={
            "phase": "Running",
            "podIP": "1.2.3.4",
            "qosClass": "Burstable",
            "containerStatuses": [
                {"restartCount": 2},
                {"restartCount": "9"},
                "junk",
                {"restartCount": 3.9},
                {},
            ],
        },
    )
    row = rows(spark, text).first()
    assert (row.status, row.phase, row.node_name, row.pod_ip) == ("Running", "Running", "n", "1.2.3.4")
    assert (row.qos_class, row.restart_count, row.replicas) == ("Burstable", 5, None)


def test_service(spark):
    row = rows(
        spark,
        obj("Service", spec={"type": "NodePort", "clusterIP": "1.1.1.1", "externalIPs": ["a", 5, "b"]}),
    ).first()
    assert (row.status, row.service_type, row.cluster_ip) == ("Active", "NodePort", "1.1.1.1")
    assert row.external_ips == ["a", "b"]


READY = {"type": "Available", "status": "True"}
STUCK = {"type": "Progressing", "status": "False"}


@pytest.mark.parametrize(
    "status, expected",
    [
        ({"conditions": [READY, STUCK]}, "Ready"),
        ({"conditions": [STUCK, READY]}, "Failed"),
        ({"conditions": [{"type": "Available", "status": "False"}, "x", STUCK]}, "Failed"),
        ({"conditions": [{"type": "Available", "status": True}]}, "Unknown"),
        ({"replicas": 3, "readyReplicas": 0}, "Pending"),
        ({"replicas": 3, "readyReplicas": 2}, "Updating"),
        ({"replicas": 3, "readyReplicas": 3}, "Ready"),
        ({"replicas": 3}, "Unknown"),
        ({"readyReplicas": 3}, "Unknown"),
        ({"replicas": "3", "readyReplicas": 3}, "Unknown"),
        ({}, "Unknown"),
        (None, ""),
        ("text", ""),
    ],
)
def test_deployment_status(spark, status, expected):
    assert status_of(spark, "Deployment", status=status) == expected


def test_other_statuses(spark):
    cases = [
        ("StatefulSet", {"status": {"replicas": 2, "readyReplicas": 1, "conditions": [READY]}}, "Updating"),
        ("StatefulSet", {"status": {}}, "Unknown"),
        ("StatefulSet", {}, ""),
        ("DaemonSet", {"status": {"desiredNumberScheduled": 2, "numberReady": 2}}, "Ready"),
        ("DaemonSet", {"status": {"desiredNumberScheduled": 2, "numberReady": 0}}, "Pending"),
        ("DaemonSet", {"status": {"numberReady": 0}}, "Unknown"),
        ("PersistentVolume", {"status": {"phase": "Bound"}}, "Bound"),
        ("PersistentVolumeClaim", {}, ""),
        ("Ingress", {}, "Active"),
        ("Ingress", {"status": {"loadBalancer": {"ingress": []}}}, "Active"),
        ("Ingress", {"status": {"loadBalancer": {"ingress": [5]}}}, "Ready"),
        ("ConfigMap", {}, "Active"),
        ("Secret", {"status": {"phase": "odd"}}, "Active"),
        ("NetworkPolicy", {}, "Active"),
        ("ReplicaSet", {"status": {"phase": "P", "state": "S"}}, "P"),
        ("ReplicaSet", {"status": {"phase": 5, "state": "S"}}, "S"),
        ("Custom", {"status": {"state": None}}, "Active"),
        ("Custom", {}, "Active"),
    ]
    texts = [obj(kind, f"{i:02d}", **parts) for i, (kind, parts, _) in enumerate(cases)]
    got = rows(spark, *texts).orderBy("resource_name").collect()
    assert [(r.resource_type, r.status) for r in got] == [(k, s) for k, _, s in cases]


def test_replicas(spark):
    texts = [
        obj("Deployment", "a", spec={"replicas": 4}, status={"readyReplicas": 1, "updatedReplicas": 2}),
        obj("Deployment", "b", spec={"replicas": 4}, status={"replicas": 3, "unavailableReplicas": 1}),
        obj("Deployment", "c", spec={"replicas": 4}),
        obj("StatefulSet", "d", spec={"replicas": 4}, status={"replicas": 3, "availableReplicas": 9}),
        obj(
            "DaemonSet",
            "e",
            spec={"replicas": 4},
            status={"desiredNumberScheduled": 5, "numberAvailable": 2, "numberUnavailable": 3},
        ),
    ]
    got = {r.resource_name: r.replicas and tuple(r.replicas) for r in rows(spark, *texts).collect()}
    assert got == {
        "a": (4, 0, 1, 2, 0, 0),
        "b": (3, 3, 0, 0, 0, 1),
        "c": None,
        "d": (4, 3, 0, 0, 0, 0),
        "e": (5, 0, 0, 0, 2, 3),
    }


def test_volumes_and_ingress(spark):
    spec = {"storageClassName": "fast", "volumeMode": "Block", "accessModes": ["RWO", 1]}
    row = rows(spark, obj("PersistentVolume", spec=spec)).first()
    assert (row.storage_class, row.volume_mode, row.access_modes) == ("fast", "Block", ["RWO"])
    row = rows(spark, obj("Service", spec=spec)).first()
    assert (row.storage_class, row.volume_mode, row.access_modes) == (None, None, None)
    assert rows(spark, obj("Ingress", spec={"ingressClassName": "n"})).first().ingress_class == "n"


def test_parts_on_request(spark):
    text = obj(
        "Pod",
        metadata={
            "ownerReferences": [
                {"apiVersion": "apps/v1", "kind": "ReplicaSet", "name": "r", "uid": "u", "controller": True},
                "junk",
                {"name": 5, "controller": "yes"},
            ]
        },
        spec={"a": {"b": 1}},
        status={
            "phase": "Running",
            "conditions": [
                {"type": "T", "status": "True", "lastTransitionTime": "2024-01-01T00:00:00Z"},
                3,
                {"type": 5, "reason": "r", "message": "m", "lastTransitionTime": "never"},
            ],
        },
    )
    row = rows(
        spark, text, include_spec=True, include_status=True, include_owner_refs=True
    ).first()
    assert row.spec.toPython() == {"a": {"b": 1}}
    assert row.status_details.toPython()["phase"] == "Running"
    assert [tuple(o) for o in row.owner_references] == [
        ("apps/v1", "ReplicaSet", "r", "u", True),
        ("", "", "", "", None),
    ]
    assert [tuple(c) for c in row.conditions] == [
        ("T", "True", None, None, dt.datetime(2024, 1, 1)),
        ("", "", "r", "m", None),
    ]
    bare = rows(spark, obj("Pod", spec=[1]), include_spec=True, include_status=True).first()
    assert bare.spec.toPython() == {} and bare.status_details is None


def test_secret_values_never_show(spark):
    texts = [
        obj("Secret", "s", data={"k": "hidden-a", "l": "hidden-b"}, type="Opaque"),
        obj("Secret", "t", data="hidden-c"),
        obj("ConfigMap", "u", data={"k": "hidden-d"}, type="ignored"),
    ]
    df = rows(spark, *texts, include_spec=True, include_status=True, include_owner_refs=True)
    assert not any("hidden" in str(r) for r in df.collect())
    got = {r.resource_name: r.status_details.toPython() for r in df.collect()}
    assert got == {"s": {"data_keys_count": 2, "type": "Opaque"}, "t": {}, "u": {"data_keys_count": 1}}


def names(df):
    return [r.resource_name for r in df.collect()]


def test_filters(spark):
    texts = [
        obj("Pod", "p1", metadata={"namespace": "a", "creationTimestamp": "2024-01-02T00:00:00Z"},
            spec={"nodeName": "n1"}, status={"phase": "Running"}),
        obj("Pod", "p2", metadata={"namespace": "b", "labels": {"app": "web"}}, spec={"nodeName": "n2"}),
        obj("PersistentVolume", "v", status={"phase": "Bound"}),
        obj("Service", "s", metadata={"namespace": "a", "creationTimestamp": "2024-01-04T00:00:00Z"}),
        '{"kind":"Custom","metadata":{"namespace":"a"}}',
    ]
    parsed = rows(spark, *texts).cache()

    def kept(**kw):
        return sorted(names(resources.filter_resources(parsed, **kw)))

    assert kept() == ["", "p1", "p2", "s", "v"]
    assert kept(since=dt.datetime(2024, 1, 3)) == ["", "p2", "s", "v"]
    assert kept(until=dt.datetime(2024, 1, 2)) == ["", "p1", "p2", "v"]
    assert kept(namespaces=["b"]) == ["p2", "v"]  # unscoped objects pass
    assert kept(namespaces=["b", "*"]) == ["", "p1", "p2", "s", "v"]
    assert kept(resource_types=["Pod", "svc"]) == ["p1", "p2", "s"]
    assert kept(resource_names=["s"]) == ["", "s"]  # nameless objects pass
    assert kept(statuses=["Bound", "Active"]) == ["", "s", "v"]
    assert kept(node_names=["n2"]) == ["", "p2", "s", "v"]
    assert kept(label_selectors=["app=web"]) == ["p2"]
    assert kept(name_pattern="^p") == ["p1", "p2"]
    with pytest.warns(UserWarning, match="unsupported"):
        assert kept(resource_types=["Nonsense", "Service"]) == ["s"]
    with pytest.raises(ValueError):
        kept(name_pattern="[")


def test_kind_names():
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert resources.resource_kinds(["Pod", "pods", "svc", "deploy", "rs", "cm", "secrets"]) == [
            "Pod",
            "Pod",
            "Service",
            "Deployment",
            "ReplicaSet",
            "ConfigMap",
            "Secret",
        ]


def test_table_is_ordered_then_cut(spark):
    texts = [
        obj("Service", "b", metadata={"namespace": "n"}),
        obj("Pod", "z", metadata={"namespace": "n"}),
        obj("Pod", "a", metadata={"namespace": "n"}),
        obj("PersistentVolume", "v"),
    ]
    df = lines(spark, *texts)
    table = resources.cluster_resources(df, cluster_name="c")
    assert names(table) == ["v", "a", "z", "b"]
    assert names(resources.cluster_resources(df, limit=2)) == ["v", "a"]
    assert [f.name for f in table.schema] == [f.name for f in schemas.CLUSTER_RESOURCES]
    assert [f.dataType.simpleString() for f in table.schema] == [
        f.dataType.simpleString() for f in schemas.CLUSTER_RESOURCES
    ]


def test_unrequested_parts_cost_nothing(spark):
    lean = optimized(rows(spark, obj("Pod")))
    full = optimized(rows(spark, obj("Pod"), include_spec=True))
    assert lean.count("Generate inline") == full.count("Generate inline") == 1
    assert "StructField(spec,VariantType" not in lean and "StructField(spec,VariantType" in full


def test_objects_of_two_landed_dumps_count_once(spark, tmp_path):
    import os

    from harborlight.sources import landed

    def write(name, version, phase, age):
        doc = {"kind": "Pod", "metadata": {"name": "p", "namespace": "n", "resourceVersion": version}, "status": {"phase": phase}}
        path = tmp_path / name
        path.write_text(json.dumps(doc) + "\n")
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))

    write("a.json", "5", "Running", 0)
    write("b.json", "900", "Pending", 60)  # an older dump, whatever its version says
    objects = landed.scan_objects(spark, str(tmp_path))
    found = resources.cluster_resources(objects, statuses=["Running", "Pending"]).collect()
    assert [r.phase for r in found] == ["Running"]
    assert resources.cluster_resources(objects, newest_only=False).count() == 2


def test_only_asked_members_are_parsed(spark):
    """Columns, filters and the order decide what the parser builds."""
    frame = lines(spark, obj("Pod", "b"), obj("Pod", "a"))
    few = resources.cluster_resources(frame, columns=["resource_name", "uid"], node_names=["n1"])
    plan = optimized(few)
    assert few.columns == ["resource_name", "uid"]
    for member in ("nodeName", "name,", "namespace,", "kind,", "uid,"):
        assert f"StructField({member}" in plan, member
    for member in ("status", "replicas", "labels", "annotations", "clusterIP", "conditions"):
        assert f"StructField({member}" not in plan, member
    whole = resources.cluster_resources(frame, node_names=["n1"]).select("resource_name", "uid")
    assert few.collect() == whole.collect()
    with pytest.raises(ValueError):
        resources.cluster_resources(frame, columns=["resource_name", "no_such"])


@pytest.mark.parametrize("opened", [False, True])
def test_each_column_alone_is_as_among_all(spark, opened):
    """Whatever is parsed for one column, its values are those of a full parse."""
    texts = [
        obj("Pod", "p", status={"phase": "Running", "containerStatuses": [{"restartCount": 2}, 3]}),
        obj("Deployment", "d", spec={"replicas": 3}, status={"replicas": 2, "readyReplicas": 2}),
        obj("Service", "s", spec={"externalIPs": ["1", 2], "clusterIP": 7}),
        obj("Ingress", "i", status={"loadBalancer": {"ingress": [{"ip": "x"}]}}),
        obj("Secret", "x", data={"a": "b"}, type="Opaque"),
        '{"kind":"Pod"}',
    ]
    parts = dict(include_spec=True, include_status=True) if opened else {}
    names = ["status", "replicas", "external_ips", "cluster_ip", "restart_count"]
    everything = resources.cluster_resources(lines(spark, *texts), **parts).select(*names).collect()
    assert [r.status for r in everything].count("Ready") == 2  # the deployment and the ingress
    for name in names:
        alone = resources.cluster_resources(lines(spark, *texts), columns=[name], **parts)
        assert [r[0] for r in alone.collect()] == [r[name] for r in everything], name


def test_sorted_objects_are_parsed_before_the_sort(spark):
    """The sort reads its input twice, so what it reads must not be the parse."""
    pods = [(f'{{"kind":"Pod","metadata":{{"name":"p{i}","namespace":"n{i % 3}"}},"spec":{{"nodeName":"x"}}}}',) for i in (3, 1, 2)]
    found = resources.cluster_resources(spark.createDataFrame(pods, "value string"), include_spec=True)
    assert [r[0] for r in found.select("resource_name").collect()] == ["p3", "p1", "p2"]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in text and "Generate" not in text
