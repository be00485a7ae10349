"""Copies of tables as immutable, numbered Parquet snapshots, and their way back."""

from __future__ import annotations

import json
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from urllib.parse import quote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column, limb_total_of, quoted
from tablevault.functions.sizing import shuffle_for
from tablevault.functions.time import AsOf, instant, moment, now
from tablevault.operators.describe import describe, file_stats, partition_columns
from tablevault.operators import manifest as proof
from tablevault.operators.diff import fingerprint, fingerprint_metrics
from tablevault.operators.verify import Checks, verify_clone
from tablevault.plans import audit as log
from tablevault.sources import filesystem

logger = logging.getLogger(__name__)

DELETERS = 16
# Damaged files that an error names; all of them are in `Vault.damage`.
NAMED = 10
# How a restored copy is compared with its snapshot, beside the recorded proof (names, types and
# the row counts of file footers) and where there is none.
PROVEN, UNPROVEN = Checks(full_diff=False, sample=False), Checks()


@dataclass(frozen=True)
class TableName:
    """A table, always by all three parts."""

    catalog: str
    schema: str
    table: str

    def __str__(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"

    @property
    def sql(self) -> str:
        return ".".join(quoted(part) for part in (self.catalog, self.schema, self.table))

    @property
    def path(self) -> str:
        return "/".join(quote(part, safe=" ") for part in (self.catalog, self.schema, self.table))

    @property
    def key(self) -> dict[str, str]:
        return {"catalog": self.catalog, "schema": self.schema, "table": self.table}


@dataclass(frozen=True)
class Snapshot:
    """One version of a table's backup."""

    name: TableName
    version: int
    path: str
    schema: T.StructType
    row_count: int
    partition_by: list[str] = field(default_factory=list)
    fingerprint: tuple[int, int] | None = None
    source_properties: list[dict] | None = None
    seconds: int = 0
    stats: dict = field(default_factory=dict)
    # Where its files are recorded, and the record's own totals.
    manifest_path: str | None = None
    manifest: dict | None = None

    @property
    def size(self) -> int:
        """Bytes of its files, as far as known."""
        return self.stats.get("total_size_bytes") or 0

    def read(self, spark: SparkSession) -> DataFrame:
        """The version's rows, with the source's column order and types."""
        return self._frame(spark)

    def read_what_can_be(self, spark: SparkSession) -> DataFrame:
        """`read` that passes over files that are gone or cannot be read."""
        return self._frame(spark, ignoreCorruptFiles="true", ignoreMissingFiles="true")

    def _frame(self, spark: SparkSession, **options: str) -> DataFrame:
        frame = spark.read.schema(self.schema).options(**options).parquet(self.path)
        return frame.select(*[frame[quoted(f.name)] for f in self.schema.fields])


class Vault:
    """A folder of snapshots and the audit log that publishes them.

    Snapshots lie at `<root>/<catalog>/<schema>/<table>/v=<n>/`, or below an external
    location, and are never changed. The log lies at `<root>/_audit/`, and what each file of
    a snapshot held when it was made at `<root>/_manifests/`.
    """

    def __init__(self, spark: SparkSession, root: str, audit_path: str | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.audit_path = audit_path or f"{self.root}/_audit"

    # -- log -----------------------------------------------------------------------------

    def audit(self) -> DataFrame:
        return log.read_audit(self.spark, self.audit_path)

    def _history(self, name: TableName) -> DataFrame:
        return log.read_table_audit(self.spark, self.audit_path, name.key)

    def compact_audit(self, least_files: int = log.MOST_FILES) -> int:
        """Write the logs of tables that have many files as one file each; see `audit.compact`."""
        return log.compact(self.spark, self.audit_path, least_files)

    def versions(self) -> DataFrame:
        """Every version that can be restored, with what the log says about it."""
        return log.published(self.audit())

    # -- namespace -----------------------------------------------------------------------

    def create_namespace(self, catalog: str, schema: str) -> str:
        """Make sure the place for backups exists; repeating it changes nothing.

        Returns the schema to register backups in: the schema of that catalog where the
        session has such a catalog, else `<catalog>_<schema>` in the session catalog.
        """
        known = self.spark.conf.get(f"spark.sql.catalog.{catalog}", None)
        if known or catalog == "spark_catalog":
            namespace = f"{quoted(catalog)}.{quoted(schema)}"
        else:
            namespace = quoted(f"{catalog}_{schema}")
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
        filesystem.make_directory(self.spark, self.root)
        return namespace

    # -- clone ---------------------------------------------------------------------------

    def copy(
        self,
        source: DataFrame | str,
        name: TableName,
        *,
        location: str | None = None,
        partition_by: list[str] | None = None,
        with_fingerprint: bool = True,
    ) -> Snapshot:
        """Write the next version of `name` without publishing it.

        The row count and the fingerprint are taken by the copy job itself, so they describe
        exactly what was copied even while the source changes. The files are then read once
        for the manifest: each file's size, rows and checksum. `with_fingerprint=False`
        leaves both out; such a version is restored on a comparison with itself alone. A
        table keeps its partition columns and file layout. With `partition_by`, rows are
        first rebalanced by those columns, which lets Spark split hot values and join small
        ones.
        """
        started = time.monotonic()
        properties = None
        if isinstance(source, str):
            rows = describe(self.spark, source, on_error="empty").collect()
            properties = [row.asDict() for row in rows]
            frame = self.spark.table(source)
            if partition_by is None:
                partition_by = partition_columns(self.spark, source)
        else:
            frame = source
            if partition_by:
                frame = frame.hint("rebalance", *[column(c) for c in partition_by])
        version = self._next_version(name)
        path = f"{location or f'{self.root}/{name.path}'}/v={version}"
        observed = Observation()
        metrics = (
            fingerprint_metrics(frame.schema)
            if with_fingerprint
            else [F.count(F.lit(1)).alias("row_count")]
        )
        # The version is not published, so what an interrupted run left here is free to go.
        writer = frame.observe(observed, *metrics).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        seen = observed.get
        stats = file_stats(self.spark, path).first()
        snapshot = Snapshot(
            name=name,
            version=version,
            path=path,
            schema=frame.schema,
            row_count=seen["row_count"],
            partition_by=list(partition_by or []),
            source_properties=properties,
            stats=stats.asDict(),
        )
        if with_fingerprint:
            snapshot = replace(
                self._recorded(snapshot),
                fingerprint=(seen["row_count"], limb_total_of(seen, "checksum")),
            )
        return replace(snapshot, seconds=int(time.monotonic() - started))

    def _recorded(self, snapshot: Snapshot) -> Snapshot:
        """Write a snapshot's manifest beside the snapshots, a row per file."""
        path = f"{self.root}/_manifests/{snapshot.name.path}/v={snapshot.version}"
        lines = proof.manifest(snapshot.read(self.spark), snapshot.path)
        lines.write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(proof.MANIFEST).parquet(path)
        return replace(snapshot, manifest_path=path, manifest=proof.totals(written))

    def _next_version(self, name: TableName) -> int:
        highest = self._history(name).agg(F.max("target_version")).first()[0]
        return (highest or 0) + 1

    def publish(
        self,
        snapshot: Snapshot,
        *,
        as_of: AsOf | None = None,
        run_id: str | None = None,
        status: str = log.SUCCESS,
        error: str | None = None,
        verification_status: str = log.SKIPPED,
        verification_details: dict | None = None,
    ) -> None:
        """Log a copy. With status SUCCESS this is what makes the version exist."""
        stats = snapshot.stats
        row = {
            "run_id": run_id or uuid4().hex,
            "timestamp": moment(self.spark, as_of or now()),
            "operation": log.BACKUP,
            **snapshot.name.key,
            "target_version": snapshot.version,
            "row_count": snapshot.row_count,
            "status": status,
            "error_message": error,
            "duration_seconds": snapshot.seconds,
            "verification_status": verification_status,
            "verification_details": _json(verification_details),
            "storage_location": snapshot.path,
            "deep_clone_metadata": _json(
                {
                    "schema": snapshot.schema.jsonValue(),
                    "partition_by": snapshot.partition_by,
                    "fingerprint": snapshot.fingerprint
                    and [str(part) for part in snapshot.fingerprint],
                    "manifest_path": snapshot.manifest_path,
                    "manifest": snapshot.manifest,
                }
            ),
            "source_table_properties": _json(snapshot.source_properties),
            "target_table_properties": _json(
                {"provider": "parquet", "columns": snapshot.schema.simpleString()}
            ),
            "partition_info": _json(
                {"columns": snapshot.partition_by, "partitions": stats["partition_count"]}
            ),
            "file_count": stats["file_count"],
            "total_size_bytes": stats["total_size_bytes"],
            "last_modified": stats["last_modified"],
        }
        log.append_row(self.spark, self.audit_path, row)

    def clone(
        self,
        source: DataFrame | str,
        name: TableName,
        *,
        mode: str = "new_version",
        location: str | None = None,
        partition_by: list[str] | None = None,
        as_of: AsOf | None = None,
    ) -> Snapshot:
        """Copy a whole table, data and metadata, and publish the copy.

        `mode="if_not_exists"` does nothing where a version exists already;
        `mode="new_version"` adds one beside it. Errors are logged and raised.
        """
        if mode not in ("new_version", "if_not_exists"):
            raise ValueError(f"unknown mode: {mode}")
        if mode == "if_not_exists":
            present = self._find(name)
            if present:
                return present
        try:
            snapshot = self.copy(source, name, location=location, partition_by=partition_by)
        except Exception as error:
            logger.error("Cannot clone %s: %s", name, error)
            raise
        self.publish(snapshot, as_of=as_of)
        return snapshot

    # -- read and restore ----------------------------------------------------------------

    def _find(
        self, name: TableName, version: int | None = None, as_of: AsOf | None = None
    ) -> Snapshot | None:
        rows = log.published(self._history(name))
        if version is not None:
            rows = rows.filter(F.col("target_version") == version)
        if as_of is not None:
            rows = rows.filter(F.col("timestamp") <= instant(as_of))
        row = rows.orderBy(F.desc("target_version")).first()
        if row is None:
            return None
        details = json.loads(row["deep_clone_metadata"])
        properties = row["source_table_properties"]
        return Snapshot(
            name=name,
            version=row["target_version"],
            path=row["storage_location"],
            schema=T.StructType.fromJson(details["schema"]),
            row_count=row["row_count"],
            partition_by=details["partition_by"],
            source_properties=json.loads(properties) if properties else None,
            fingerprint=tuple(map(int, details["fingerprint"])) if details["fingerprint"] else None,
            stats={"total_size_bytes": row["total_size_bytes"]},
            manifest_path=details.get("manifest_path"),
            manifest=details.get("manifest"),
        )

    def snapshot(
        self, name: TableName, version: int | None = None, as_of: AsOf | None = None
    ) -> Snapshot:
        """The newest version, a given one, or the newest not after `as_of`."""
        found = self._find(name, version, as_of)
        if found is None:
            raise LookupError(f"no backup of {name} (version={version}, as_of={as_of})")
        return found

    def read(
        self, name: TableName, version: int | None = None, as_of: AsOf | None = None
    ) -> DataFrame:
        return self.snapshot(name, version, as_of).read(self.spark)

    def restore(
        self,
        name: TableName,
        target: str,
        *,
        version: int | None = None,
        as_of: AsOf | None = None,
        overwrite: bool = False,
        checks: Checks | None = None,
        when: AsOf | None = None,
    ) -> Snapshot:
        """Bring a backup back to the path `target`.

        The snapshot's files must be those of its manifest; any other file is named and
        nothing is written. The rows are then written beside the target and their
        fingerprint there must be the recorded one; `checks` adds further comparisons with
        the snapshot. Only then do they take the target's place by renaming, so a live table
        is never without a good copy. Where the store has no cheap rename, restore to an
        unused path instead, or by `restore_table`.
        """
        started = time.monotonic()
        found = self.snapshot(name, version, as_of)
        target = target.rstrip("/")
        occupied = filesystem.exists(self.spark, target)
        if occupied and not overwrite:
            raise FileExistsError(f"{target} exists; pass overwrite=True to replace it")
        staged = f"{target}.restored-{uuid4().hex}"
        self._write_verified(found, staged, checks)
        if occupied:
            previous = f"{target}.replaced-{uuid4().hex}"
            filesystem.rename(self.spark, target, previous)
            try:
                filesystem.rename(self.spark, staged, target)
            except Exception:
                filesystem.rename(self.spark, previous, target)
                raise
            filesystem.delete(self.spark, previous)
        else:
            filesystem.rename(self.spark, staged, target)
        self._log_restore(found, target, when, started)
        return found

    def restore_table(
        self,
        name: TableName,
        table: str,
        *,
        location: str | None = None,
        version: int | None = None,
        as_of: AsOf | None = None,
        overwrite: bool = False,
        checks: Checks | None = None,
        when: AsOf | None = None,
    ) -> Snapshot:
        """Bring a backup back as the catalog table `table`.

        Partition columns, column comments, the table comment and its properties come back
        with the rows. The rows go to `location`, by default a fresh folder of the table's
        schema, and are verified there before the table is pointed at them. What a managed
        table held before stays for queries that read it, and is one of the `leftovers`.
        """
        started = time.monotonic()
        found = self.snapshot(name, version, as_of)
        if self.spark.catalog.tableExists(table) and not overwrite:
            raise FileExistsError(f"{table} exists; pass overwrite=True to replace it")
        if location is None:
            schema, _, last = table.rpartition(".")
            home = self.spark.catalog.getDatabase(schema or self.spark.catalog.currentDatabase())
            location = f"{home.locationUri.rstrip('/')}/{last.strip('`')}-{uuid4().hex}"
        self._write_verified(found, location, checks)
        replaced = self._publish_table(table, replace(found, path=location))
        self._log_restore(found, table, when, started, replaced)
        return found

    def _publish_table(self, table: str, data: Snapshot) -> str | None:
        """Make `table` read a snapshot's files; returns the place of data it owned before.

        A Parquet table of the same columns and without partitions is pointed at the files in
        one step, so there is no moment without it, and queries that have begun read on.
        Other tables are defined anew and take the name.
        """
        if not self.spark.catalog.tableExists(table):
            self._create_table(table, data)
            return None
        details, now_there = self._details(table), self.spark.table(table).schema
        shape = [(f.name, f.dataType, f.nullable) for f in data.schema.fields]
        same = [(f.name, f.dataType, f.nullable) for f in now_there.fields] == shape
        plain = not data.partition_by and not partition_columns(self.spark, table)
        if not (same and plain and (details.get("provider") or "").lower() == "parquet"):
            self._create_table(table, data)
            return None
        self.spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(data.path)}")
        self.spark.catalog.refreshTable(table)
        self._describe_as(table, data)
        managed = (details.get("type") or "").upper() == "MANAGED"
        return details.get("location") if managed else None

    def _describe_as(self, table: str, data: Snapshot) -> None:
        """Give `table` the comments and properties of a snapshot's source."""
        before = describe(self.spark, table).collect()
        about = data.source_properties or []

        def of(rows, section: str) -> dict[str, str]:
            return {r["key"]: r["value"] for r in rows if r["section"] == section}

        wanted, there = of(about, "property"), of(before, "property")
        gone = [_literal(key) for key in there if key not in wanted]
        if gone:
            self.spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({', '.join(gone)})")
        if wanted:
            pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in wanted.items())
            self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
        comment = of(about, "detail").get("comment")
        if comment != of(before, "detail").get("comment"):
            self.spark.sql(f"COMMENT ON TABLE {table} IS {_literal(comment) if comment else 'NULL'}")
        noted = of(before, "comment")
        for field in data.schema.fields:
            note = field.metadata.get("comment", "")
            if note != noted.get(field.name, ""):
                self.spark.sql(
                    f"ALTER TABLE {table} ALTER COLUMN {quoted(field.name)} COMMENT {_literal(note)}"
                )

    def leftovers(self, hours: float = 24, as_of: AsOf | None = None) -> DataFrame:
        """Folders that killed or replaced work has left behind: (path, kind, modified).

        'copy' and 'manifest': versions that no row of the log names, or that were deleted.
        'restore': what a restore had written, or moved aside, beside a target that exists.
        'replaced': data of a managed table that a restore has pointed elsewhere. Only what
        was last changed more than `hours` ago, so work that is going on is left alone. The
        folders of versions and targets are listed, never files.
        """
        audit = self.audit()
        plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        backups = audit.where((F.col("operation") == log.BACKUP) & F.col("storage_location").isNotNull())
        places = backups.select(F.regexp_replace("storage_location", "/v=[0-9]+$", "").alias("place"))
        inside = [(self.root, "/*" * depth + "/v=*") for depth in (3, 5)]
        outside = [
            (r["place"], "/v=*") for r in places.distinct().toLocalIterator()
            if not f"{r['place']}/".startswith(f"{self.root}/")
        ]
        found = [(*f, "copy") for at in inside + outside for f in filesystem.matching(self.spark, *at)]
        manifests = f"{self.root}/_manifests"
        found += [(*f, "manifest") for f in filesystem.matching(self.spark, manifests, "/*/*/*/v=*")]
        restored = audit.where(F.col("operation") == log.RESTORE)
        replaced = F.get_json_object("target_table_properties", "$.replaced").alias("replaced")
        for row in restored.select("storage_location", replaced).distinct().toLocalIterator():
            target, before = row["storage_location"], row["replaced"]
            if "/" in target and filesystem.exists(self.spark, target):
                for kind in (".restored-*", ".replaced-*"):
                    beside = filesystem.matching(self.spark, target, kind)
                    found += [(*f, "restore") for f in beside]
            if before and before != self._location_of(target):
                found += [(*f, "replaced") for f in filesystem.matching(self.spark, before, "")]
        listed = self.spark.createDataFrame(found, "path string, millis bigint, kind string").distinct()
        known = log.kept(audit).select(
            F.regexp_replace("storage_location", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "").alias("known"),
            F.get_json_object("deep_clone_metadata", "$.manifest_path").alias("manifest"),
        )
        known = known.select(
            F.explode(
                F.array("known", F.regexp_replace("manifest", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""))
            ).alias("known")
        )
        modified = F.timestamp_millis("millis")
        age = F.make_dt_interval(secs=F.lit(float(hours) * 3600))
        old = modified < instant(as_of or now()) - age
        return (
            listed.where(old)
            .withColumn("plain", plain)
            .join(known, (F.col("plain") == F.col("known")) & F.col("kind").isin("copy", "manifest"), "left_anti")
            .select("path", "kind", modified.alias("modified"))
        )

    def remove_leftovers(self, hours: float = 24, as_of: AsOf | None = None) -> int:
        """Delete the folders that `leftovers` lists; returns how many."""
        paths = [r["path"] for r in self.leftovers(hours, as_of).collect()]  # names of folders
        for path in paths:
            logger.info("Removing what was left at %s", path)
            filesystem.delete(self.spark, path)
        return len(paths)

    def _location_of(self, table: str) -> str | None:
        """Where a catalog table's data lies; None if there is no such table."""
        try:
            return self._details(table).get("location")
        except AnalysisException:
            return None

    def _details(self, table: str) -> dict[str, str]:
        rows = describe(self.spark, table).collect()
        return {r["key"]: r["value"] for r in rows if r["section"] == "detail"}

    def damage(
        self, name: TableName, version: int | None = None, as_of: AsOf | None = None, *,
        content: bool = True,
    ) -> DataFrame:
        """A version's files that are not those that were backed up: (file, problem, ...).

        Reads the listing, and the rows once unless `content=False`; see `manifest.damage`.
        """
        return self._damage(self.snapshot(name, version, as_of), content)

    def _damage(self, found: Snapshot, content: bool = True) -> DataFrame:
        if not found.manifest_path:
            raise LookupError(f"version {found.version} of {found.name} has no manifest")
        lines = self.spark.read.schema(proof.MANIFEST).parquet(found.manifest_path)
        if proof.totals(lines) != found.manifest:
            raise RuntimeError(
                f"version {found.version} of {found.name} is damaged: its manifest is not the "
                "one that was recorded"
            )
        frame = found.read_what_can_be(self.spark) if self._there(found) else self._nothing(found)
        return proof.damage(lines, frame, found.path, content)

    def _there(self, found: Snapshot) -> bool:
        return filesystem.exists(self.spark, found.path)

    def _nothing(self, found: Snapshot) -> DataFrame:
        return self.spark.createDataFrame([], found.schema)

    def _refuse_damaged(self, found: Snapshot) -> None:
        rows = self._damage(found).limit(NAMED + 1).collect()
        if rows:
            names = ", ".join(f"{r['problem']} {r['file']}" for r in rows[:NAMED])
            more = " and more" if len(rows) > NAMED else ""
            raise RuntimeError(
                f"version {found.version} of {found.name} is damaged: its files are not those "
                f"that were backed up: {names}{more}"
            )

    def _write_verified(self, found: Snapshot, path: str, checks: Checks | None) -> None:
        """Write a snapshot's rows to an unused path and check them there.

        Before anything is written, the files are compared with the manifest. What the write
        job has counted, and what the written files hold, must be what was recorded when the
        backup was made. A version without a manifest is compared with its copy instead.
        """
        if found.manifest_path:
            self._refuse_damaged(found)
        checks = checks or (PROVEN if found.manifest_path else UNPROVEN)
        try:
            rows, observed = found.read(self.spark), Observation()
            writer = rows.observe(observed, *fingerprint_metrics(rows.schema)).write
            if found.partition_by:
                writer = writer.partitionBy(*found.partition_by)
            writer.parquet(path)
            seen = observed.get
            if seen["row_count"] != found.row_count:
                raise RuntimeError(
                    f"version {found.version} of {found.name} is damaged: it has "
                    f"{seen['row_count']} rows, {found.row_count} were backed up"
                )
            if found.fingerprint and limb_total_of(seen, "checksum") != found.fingerprint[1]:
                raise RuntimeError(
                    f"version {found.version} of {found.name} is damaged: its rows are not "
                    "those that were backed up"
                )
            copy = replace(found, path=path).read(self.spark)
            same = not found.fingerprint or _fingerprint_of(copy) == found.fingerprint
            if same:
                with shuffle_for(self.spark, 2 * found.size):
                    same = verify_clone(found.read(self.spark), copy, checks)
            if not same:
                raise RuntimeError(
                    f"Restored copy of {found.name} does not match version {found.version}"
                )
        except Exception:
            filesystem.delete(self.spark, path)
            raise

    def _create_table(self, table: str, data: Snapshot) -> None:
        """Define `table` over a snapshot's files, with what is known of its source.

        The definition is made under another name and then takes the table's, so a failure
        leaves the table that was there as it was.
        """
        parser = self.spark._jsparkSession.sessionState().sqlParser()
        found = parser.parseMultipartIdentifier(table)
        names = [found.apply(i) for i in range(found.length())]

        def beside(label: str) -> str:
            return ".".join(map(quoted, [*names[:-1], f"{names[-1]}_{label}_{uuid4().hex}"]))

        fresh, previous = beside("fresh"), beside("previous")
        self._define(fresh, data)
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
            return
        try:
            self.spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
        except Exception:
            self.spark.sql(f"DROP TABLE {fresh}")
            raise
        try:
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        except Exception:
            self.spark.sql(f"ALTER TABLE {previous} RENAME TO {table}")
            self.spark.sql(f"DROP TABLE {fresh}")
            raise
        self.spark.sql(f"DROP TABLE {previous}")

    def _define(self, table: str, data: Snapshot) -> None:
        types = self.spark._jvm.org.apache.spark.sql.types.DataType
        columns = [
            f"{quoted(f.name)} {types.fromJson(f.dataType.json()).sql()}"
            + ("" if f.nullable else " NOT NULL")
            + (f" COMMENT {_literal(f.metadata['comment'])}" if "comment" in f.metadata else "")
            for f in data.schema.fields
        ]
        clauses = [f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet"]
        if data.partition_by:
            clauses.append(f"PARTITIONED BY ({', '.join(map(quoted, data.partition_by))})")
        clauses.append(f"LOCATION {_literal(data.path)}")
        about = data.source_properties or []
        clauses += [
            f"COMMENT {_literal(row['value'])}"
            for row in about
            if (row["section"], row["key"]) == ("detail", "comment")
        ]
        properties = [
            f"{_literal(row['key'])} = {_literal(row['value'])}"
            for row in about
            if row["section"] == "property"
        ]
        if properties:
            clauses.append(f"TBLPROPERTIES ({', '.join(properties)})")
        self.spark.sql(" ".join(clauses))
        if data.partition_by:
            self.spark.catalog.recoverPartitions(table)

    def _log_restore(
        self, found: Snapshot, target: str, when: AsOf | None, started: float,
        replaced: str | None = None,
    ) -> None:
        row = {
            "run_id": uuid4().hex,
            "timestamp": moment(self.spark, when or now()),
            "operation": log.RESTORE,
            **found.name.key,
            "source_version": found.version,
            "row_count": found.row_count,
            "status": log.SUCCESS,
            "duration_seconds": int(time.monotonic() - started),
            "verification_status": log.PASSED,
            "storage_location": target,
            "target_table_properties": _json({"replaced": replaced} if replaced else None),
        }
        log.append_row(self.spark, self.audit_path, row)

    def register(self, name: TableName, table: str, version: int | None = None) -> None:
        """Make a version readable by SQL as the external table `table`.

        Registering again points the table at another version; snapshot files are not
        touched. A table of that name that does not read a version of `name` is refused.
        """
        found = self.snapshot(name, version)
        if self.spark.catalog.tableExists(table):
            own = {self._plain(r[0]) for r in self._versions_of(name).collect()}
            about = self._details(table)
            if (about.get("type") or "").upper() != "EXTERNAL" or (
                self._plain(about.get("location") or "") not in own
            ):
                raise ValueError(f"{table} exists and is no registered version of {name}")
        self._create_table(table, found)

    def _versions_of(self, name: TableName) -> DataFrame:
        """Where versions of one table lie or have lain."""
        rows = self._history(name).filter(F.col("operation") == log.BACKUP)
        return rows.select("storage_location").distinct()

    def _plain(self, path: str) -> str:
        return filesystem.qualified(self.spark, path).rstrip("/") if path else ""

    # -- removal -------------------------------------------------------------------------

    def drop_versions(self, versions: DataFrame, as_of: AsOf | None = None) -> int:
        """Remove versions: unpublish them, then delete their files, then log the deletion.

        A run that stops in between leaves versions unpublished but not deleted; the next
        run finishes them. Returns how many were deleted.
        """
        run_id, at = uuid4().hex, moment(self.spark, as_of or now())

        def entries(rows: DataFrame, operation: str) -> DataFrame:
            return rows.select(
                F.lit(run_id).alias("run_id"),
                F.lit(at).alias("timestamp"),
                F.lit(operation).alias("operation"),
                *log.VERSION_KEY,
                F.lit(log.SUCCESS).alias("status"),
                "storage_location",
            )

        log.append(entries(versions, log.EXPIRE), self.audit_path)
        pending = log.undeleted(self.audit())

        def drop(row) -> None:
            logger.info(
                "Dropping %s.%s.%s version %s",
                row["catalog"], row["schema"], row["table"], row["target_version"],
            )
            filesystem.delete(self.spark, row["storage_location"])
            name = TableName(row["catalog"], row["schema"], row["table"])
            manifest = f"{self.root}/_manifests/{name.path}/v={row['target_version']}"
            filesystem.delete(self.spark, manifest)

        # Stores delete slowly one by one; an error of any of them ends the removal unlogged.
        with ThreadPoolExecutor(DELETERS) as pool:
            dropped = sum(1 for _ in pool.map(drop, pending.toLocalIterator()))
        if dropped:
            log.append(entries(pending, log.DROP), self.audit_path)
        return dropped


def deep_clone(
    vault: Vault,
    *,
    source_catalog: str,
    source_schema: str,
    source_table: str,
    target_catalog: str,
    target_schema: str,
    target_table: str,
    source: DataFrame | None = None,
    mode: str = "if_not_exists",
    location: str | None = None,
) -> Snapshot:
    """Clone one fully named table to another name in the vault.

    `source` stands in for the named table where the session's catalogs do not have it.
    """
    origin = TableName(source_catalog, source_schema, source_table)
    target = TableName(target_catalog, target_schema, target_table)
    return vault.clone(
        source if source is not None else origin.sql, target, mode=mode, location=location
    )


def _fingerprint_of(rows: DataFrame) -> tuple[int, int]:
    seen = fingerprint(rows).first()
    return seen["row_count"], int(seen["checksum"])


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _json(value) -> str | None:
    return None if value is None else json.dumps(value, default=str)
