"""The backup job: clone what is due, verify it, log it; and remove what has expired."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from threading import get_ident
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.columns import quoted
from tablevault.functions.sizing import shuffle_for
from tablevault.functions.time import AsOf, moment, now
from tablevault.operators.snapshots import Snapshot, TableName, Vault
from tablevault.operators.verify import Checks, verify
from tablevault.plans import audit as log
from tablevault.plans.plan import STORAGE_TYPES, due_tables, with_location
from tablevault.plans.retention import expired

logger = logging.getLogger(__name__)

# How the data check compares a copy with its source.
EXACT, FINGERPRINT, SAMPLE = "exact", "fingerprint", "sample"

Source = Callable[[TableName], DataFrame | str]


def table_in_catalog(name: TableName) -> str:
    return name.sql


def run_backup(
    vault: Vault,
    plan: DataFrame,
    *,
    source: Source = table_in_catalog,
    as_of: AsOf | None = None,
    method: str = EXACT,
    side_by_side: int = 1,
) -> DataFrame:
    """Back up every due table in priority order and return the run's log rows.

    `source` finds a table's data by its name. `method` is the data check: 'exact' compares
    all rows, 'fingerprint' compares hashes that the copy job took with those of its files,
    'sample' compares the plan's `sample_size` first rows. A table's `row_count_check` and
    `data_sample_check` switch the two checks off.

    A copy is published once it passed, and registered in the backup schema, where SQL reads
    it by its `registered_name`; a registration that fails is logged as an operation apart
    from the run. Tables that share an external address get folders of
    their catalog and schema below it. With a table's `fail_fast`, an error or a failed
    check ends the run with that error; without it, the run goes on. Both are logged.

    With `side_by_side`, so many tables are worked on at once, begun in priority order. Small
    tables then share the cluster, by turns if its scheduler is FAIR. A run that ends with an
    error begins no other table, but finishes those it has begun.
    """
    if method not in (EXACT, FINGERPRINT, SAMPLE):
        raise ValueError(f"unknown verification method: {method}")
    as_of = as_of or now()
    run_id = uuid4().hex
    due = with_location(due_tables(plan, vault.audit(), as_of))
    shared = _shared_locations(with_location(plan))
    namespaces = {
        (r["backup_catalog"], r["backup_schema"]): vault.create_namespace(*r)
        for r in plan.select("backup_catalog", "backup_schema").distinct().collect()
    }

    def back_up(row) -> None:
        namespace = namespaces[row["backup_catalog"], row["backup_schema"]]
        _back_up(vault, row, source, as_of, run_id, method, shared, namespace)

    # One row per due table. Each row's copy and checks are Spark jobs of their own.
    if side_by_side > 1:
        _all_of(vault.spark, back_up, due.toLocalIterator(), side_by_side)
    else:
        for row in due.toLocalIterator():
            back_up(row)
    return vault.audit().filter(F.col("run_id") == run_id)


def _all_of(spark: SparkSession, work: Callable, rows: Iterator, at_once: int) -> None:
    """Do `work` for all rows, some at once, up to the first error, which is raised."""

    def pooled(row) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"backup-{get_ident()}")
        work(row)

    with ThreadPoolExecutor(at_once) as pool:
        running: set[Future] = set()
        try:
            for row in rows:
                if len(running) == at_once:
                    done, running = wait(running, return_when=FIRST_COMPLETED)
                    for table in done:
                        table.result()
                running.add(pool.submit(inheritable_thread_target(spark)(pooled), row))
        finally:
            wait(running)
        for table in running:
            table.result()


def registered_name(namespace: str, name: TableName) -> str:
    """The table in the backup schema by which SQL reads a table's newest passed backup.

    `<catalog>_<schema>_<table>` where all three are plain letters and digits. Otherwise two
    underscores part them, and every other character is written as an underscore and two
    hexadecimal digits for each of its bytes. No two tables have the same name, and
    `registered_table` tells which table a name means.
    """
    parts = (name.catalog, name.schema, name.table)
    if all(re.fullmatch("[A-Za-z0-9]+", part) for part in parts):
        return f"{namespace}.{quoted('_'.join(parts))}"
    return f"{namespace}.{quoted('__'.join(map(_escaped, parts)))}"


def _escaped(part: str) -> str:
    return re.sub(
        "[^A-Za-z0-9]", lambda m: "".join(f"_{byte:02x}" for byte in m[0].encode()), part
    )


def registered_table(registered: str) -> TableName:
    """The table whose backup is registered under a name (without its schema)."""
    if "__" not in registered:
        return TableName(*registered.split("_"))
    parts, at = [b""], 0
    while at < len(registered):
        if registered.startswith("__", at):
            parts.append(b"")
            at += 2
        elif registered[at] == "_":
            parts[-1] += bytes.fromhex(registered[at + 1 : at + 3])
            at += 3
        else:
            parts[-1] += registered[at].encode()
            at += 1
    return TableName(*(part.decode() for part in parts))


def _shared_locations(plan: DataFrame) -> set[str]:
    """External addresses that several tables of the plan have in common."""
    counts = plan.filter("storage_location IS NOT NULL").groupBy("storage_location").count()
    return {r["storage_location"] for r in counts.filter("count > 1").collect()}


def _location(vault: Vault, row, name: TableName, shared: set[str]) -> str:
    external = row["storage_location"]
    if external in shared:
        return f"{external.removesuffix('/' + name.table)}/{name.path}"
    if external:
        return external
    if row["use_external_location"]:
        if (row["storage_type"] or "").lower() in STORAGE_TYPES:
            raise ValueError(f"storage of {name} lacks an account or a container")
        logger.error("Unsupported storage for %s: %s", name, row["storage_type"])
    home = TableName(row["backup_catalog"], row["backup_schema"], "").path
    return f"{vault.root}/{home}".rstrip("/") + f"/{name.path}"


def _back_up(
    vault: Vault, row, source: Source, as_of: AsOf, run_id: str, method: str, shared: set[str],
    namespace: str,
) -> None:
    name = TableName(row["catalog"], row["schema"], row["table"])
    snapshot: Snapshot | None = None
    try:
        original = source(name)
        snapshot = vault.copy(
            original,
            name,
            location=_location(vault, row, name, shared),
        )
        outcome, details = log.SKIPPED, None
        if row["verify_enabled"]:
            details = _check(vault, row, original, snapshot, method)
            outcome = log.PASSED if details["passed"] else log.FAILED
        if outcome == log.FAILED:
            raise VerificationError(f"Verification failed for {name}", details)
    except Exception as error:
        logger.error("Backup of %s failed: %s", name, error)
        _log_failure(vault, name, snapshot, error, as_of, run_id)
        if row["fail_fast"]:
            raise
        return
    vault.publish(
        snapshot,
        as_of=as_of,
        run_id=run_id,
        verification_status=outcome,
        verification_details=details,
    )
    try:
        vault.register(name, registered_name(namespace, name), snapshot.version)
    except Exception as error:  # the backup itself is good and published
        logger.error("Cannot register the backup of %s: %s", name, error)
        entry = {
            "run_id": uuid4().hex,
            "timestamp": moment(vault.spark, as_of),
            "operation": log.REGISTER,
            **name.key,
            "source_version": snapshot.version,
            "status": log.FAILED,
            "error_message": str(error),
        }
        log.append_row(vault.spark, vault.audit_path, entry)


class VerificationError(RuntimeError):
    """A copy that does not match its source."""

    def __init__(self, message: str, details: dict) -> None:
        super().__init__(message)
        self.details = details


def _check(vault: Vault, row, original: DataFrame | str, snapshot: Snapshot, method: str) -> dict:
    copy = snapshot.read(vault.spark)
    check_rows, check_data = row["row_count_check"], row["data_sample_check"]
    if check_data and method == FINGERPRINT:
        # The manifest was made by reading all files of the copy.
        found = (snapshot.manifest["rows"], int(snapshot.manifest["checksum"]))
        return {
            "method": method,
            "source_rows": snapshot.row_count,
            "target_rows": found[0],
            "passed": found == snapshot.fingerprint,
        }
    frame = vault.spark.table(original) if isinstance(original, str) else original
    checks = Checks(
        row_count=check_rows,
        sample=check_data,
        sample_size=row["sample_size"],
        full_diff=check_data and method == EXACT,
    )
    with shuffle_for(vault.spark, 2 * snapshot.size):
        return {"method": method, **verify(frame, copy, checks).first().asDict()}


def _log_failure(
    vault: Vault, name: TableName, snapshot: Snapshot | None, error: Exception, as_of: AsOf,
    run_id: str,
) -> None:
    if snapshot is not None:
        details = getattr(error, "details", None)
        vault.publish(
            snapshot,
            as_of=as_of,
            run_id=run_id,
            status=log.FAILED,
            error=str(error),
            verification_status=log.FAILED if details else log.SKIPPED,
            verification_details=details,
        )
        return
    row = {
        "run_id": run_id,
        "timestamp": moment(vault.spark, as_of),
        "operation": log.BACKUP,
        **name.key,
        "status": log.FAILED,
        "error_message": str(error),
        "verification_status": log.SKIPPED,
    }
    log.append_row(vault.spark, vault.audit_path, row)


def cleanup(
    vault: Vault, plan: DataFrame, *, as_of: AsOf | None = None,
    leftovers_after: float | None = None,
) -> int:
    """Remove every expired version and finish interrupted removals; returns how many.

    Logs of tables that have grown to many files are compacted. With `leftovers_after`, what
    killed or replaced work left behind more than so many hours ago goes too.
    """
    as_of = as_of or now()
    try:
        dropped = vault.drop_versions(expired(vault.audit(), plan, as_of), as_of)
        vault.compact_audit()
        if leftovers_after is not None:
            vault.remove_leftovers(leftovers_after, as_of)
        return dropped
    except Exception as error:
        logger.error("Clean-up failed: %s", error)
        raise


