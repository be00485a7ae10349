"""Protecting and moving tables with plain Spark: copies, checks, restores, retention."""

from tablevault.jobs.backup import cleanup, registered_name, registered_table, run_backup
from tablevault.jobs.etl import run_etl
from tablevault.operators.describe import created_time, describe, file_stats
from tablevault.operators.diff import (
    diff_rows,
    diff_rows_in_suspect_buckets,
    fingerprint,
    sample_diff,
)
from tablevault.operators.profile import profile, profile_diff
from tablevault.operators.rows import positive_ids, row_count, sample_rows, spread_sample
from tablevault.operators.snapshots import Snapshot, TableName, Vault, deep_clone
from tablevault.operators.verify import Checks, verify, verify_clone
from tablevault.plans.plan import due_tables, load_plan, ordered, plan_rows, ranked, with_location
from tablevault.plans.retention import expired, retention_days
from tablevault.sources.files import (
    csv_dialect,
    object_store_path,
    read_files,
    read_or_none,
    write_files,
)
from tablevault.sources.schema import create_schema
from tablevault.sources.versioned import read_delta_table, write_delta_table

__all__ = [
    "Checks",
    "Snapshot",
    "TableName",
    "Vault",
    "cleanup",
    "create_schema",
    "created_time",
    "csv_dialect",
    "deep_clone",
    "describe",
    "diff_rows",
    "diff_rows_in_suspect_buckets",
    "due_tables",
    "expired",
    "file_stats",
    "fingerprint",
    "load_plan",
    "object_store_path",
    "ordered",
    "plan_rows",
    "positive_ids",
    "profile",
    "profile_diff",
    "ranked",
    "read_delta_table",
    "read_files",
    "read_or_none",
    "registered_name",
    "registered_table",
    "retention_days",
    "row_count",
    "run_backup",
    "run_etl",
    "sample_diff",
    "sample_rows",
    "spread_sample",
    "verify",
    "verify_clone",
    "with_location",
    "write_delta_table",
    "write_files",
]
