from __future__ import annotations

import pytest

from harborlight.operators import filters, options
from harborlight.plans.views import register_views


def test_methods():
    assert options.audit_method(None) is None and options.audit_method("") is None
    assert options.audit_method("file") == "file"
    with pytest.raises(ValueError, match="file, apiserver, daemonset"):
        options.audit_method("invalid")


def test_non_negative():
    assert options.non_negative("tail_lines", None) is None
    assert options.non_negative("tail_lines", 0) == 0
    with pytest.raises(ValueError, match="tail_lines cannot be negative"):
        options.non_negative("tail_lines", -1)


def test_namespace_lists():
    assert options.namespace_list("*") == ["*"]
    assert options.namespace_list("default, kube-system , monitoring") == [
        "default",
        "kube-system",
        "monitoring",
    ]
    assert options.namespace_list(["a", "b"]) == ["a", "b"]
    assert options.namespace_list(None) == [] and options.namespace_list("") == []
    with pytest.raises(ValueError):
        options.namespace_list("Invalid_Namespace")


def test_label_terms():
    terms = options.label_terms
    assert terms(["app=web", "a.b/c=1,t="]) == [("app", "in", ["web"]), ("a.b/c", "in", ["1"]), ("t", "in", [""])]
    assert terms("app==web, x != y,k,!n") == [
        ("app", "in", ["web"]), ("x", "notin", ["y"]), ("k", "exists", []), ("n", "absent", [])
    ]
    assert terms("a in (b, c),d notin (e)") == [("a", "in", ["b", "c"]), ("d", "notin", ["e"])]
    assert terms(None) == [] and terms("") == []
    for bad in ("a b", "a in b", "a=b,,c=d", "!", "a in (b", "=x", "a<3"):
        with pytest.raises(ValueError):
            terms(bad)


def test_label_terms_on_rows(spark):
    rows = [(1, {"app": "web", "tier": "x"}), (2, {"app": "db"}), (3, {}), (4, None)]
    df = spark.createDataFrame(rows, "id int, labels map<string,string>")
    want = {
        "app=web": [1], "app!=web": [2, 3, 4], "app in (web,db)": [1, 2], "app notin (db)": [1, 3, 4],
        "app": [1, 2], "!app": [3, 4], "app,tier!=x": [2], "app=": [],
    }
    for selector, ids in want.items():
        found = df.where(filters.has_labels(options.label_terms(selector))).select("id").collect()
        assert sorted(r.id for r in found) == ids, selector


def test_patterns(spark):
    assert options.pattern("p", "") is None and options.pattern("p", "^a") == "^a"
    for known_to_the_engine in (r"\p{Lu}", r"a\z", "(?<n>x)"):
        assert options.pattern("p", known_to_the_engine) == known_to_the_engine
    for bad in ("(", "(?P<n>x)"):
        with pytest.raises(ValueError, match="invalid p"):
            options.pattern("p", bad)


def test_views(spark):
    df = spark.range(3).withColumnRenamed("id", "namespace")
    assert register_views(cluster_events=df) == ["cluster_events", "kubernetes_events"]
    assert spark.sql("SELECT count(*) FROM kubernetes_events").first()[0] == 3
    with pytest.raises(ValueError, match="unknown table"):
        register_views(nodes=df)
