"""Incremental warehouse loads on Spark.

The usual entry points::

    from tidemark import JobSpec, SearchColumn, TableRef, run_load, run_check
"""

from tidemark.operators.compare import compare_tables, pairs_from_specs
from tidemark.operators.merge import Stamp, merge_upsert
from tidemark.operators.quality import constraint_violations, duplicate_keys, profile_table, row_count
from tidemark.operators.reconcile import missing_in_source, missing_in_target, reconcile
from tidemark.plans.jobs import readiness_report, run_batch, run_check, run_load
from tidemark.session import build_session, shared_dir
from tidemark.spec import ExtraColumn, JobSpec, SearchColumn, SpecError, TableRef, validate_spec
from tidemark.streaming import start_incremental_load

__all__ = [
    "JobSpec", "SearchColumn", "TableRef", "ExtraColumn", "SpecError", "validate_spec", "Stamp",
    "run_load", "run_check", "run_batch", "readiness_report", "start_incremental_load",
    "merge_upsert", "reconcile", "missing_in_source", "missing_in_target",
    "row_count", "profile_table", "duplicate_keys", "constraint_violations", "compare_tables",
    "pairs_from_specs", "build_session", "shared_dir",
]
