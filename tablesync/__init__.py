"""Keeping analytic tables in step with their sources, as Spark jobs."""

from tablesync.plans.spec import SpecError, SyncSpec
from tablesync.plans.sync import run_sync
from tablesync.sinks.table import TargetTable

__all__ = ["SpecError", "SyncSpec", "TargetTable", "run_sync"]
