"""Cluster telemetry analytics on Spark: logs, events, objects, audit entries."""

from harborlight.operators.audit import audit_logs
from harborlight.operators.events import cluster_events
from harborlight.operators.podlogs import pod_containers, pod_logs
from harborlight.operators.resources import cluster_resources
from harborlight.plans.views import register_views
from harborlight.session import configure, scratch_dir

__all__ = [
    "audit_logs",
    "cluster_events",
    "cluster_resources",
    "configure",
    "pod_containers",
    "pod_logs",
    "register_views",
    "scratch_dir",
]
