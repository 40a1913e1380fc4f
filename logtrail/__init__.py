"""Drive-test log analytics as Spark jobs: ingest, clean, merge, unmerge, views."""

from logtrail.plans.merge import MergeOptions, merge, plan_merge, unmerge
from logtrail.plans.store import LogStore
from logtrail.session import build_session

__all__ = ["LogStore", "MergeOptions", "build_session", "merge", "plan_merge", "unmerge"]
