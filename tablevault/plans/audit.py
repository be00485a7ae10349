"""The audit log: one row per operation, in an append-only Parquet table.

It is also what publishes a backup: a version exists when a successful backup row names
it and no later row expired it. Readers therefore never see a copy that is incomplete or
failed its checks. One writer at a time is assumed.

Rows lie at `<log>/table_key=<key of the table>/gen=<n>/`, so what is asked about one table
reads that table's folder alone. Each operation adds a file there; `compact` writes the rows
of a folder as one file of the next generation. Only a table's newest generation counts. That
file appears at once or not at all, so a compaction that stops halfway has changed nothing for
some tables and is done for others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.sources import filesystem

# The log's columns and types.
AUDIT_COLUMNS = {
    "run_id": "string",
    "timestamp": "timestamp",
    "operation": "string",
    "catalog": "string",
    "schema": "string",
    "table": "string",
    "source_version": "bigint",
    "target_version": "bigint",
    "row_count": "bigint",
    "status": "string",
    "error_message": "string",
    "duration_seconds": "bigint",
    "verification_status": "string",
    "verification_details": "string",
    "storage_location": "string",
    "deep_clone_metadata": "string",
    "source_table_properties": "string",
    "target_table_properties": "string",
    "partition_info": "string",
    "file_count": "bigint",
    "total_size_bytes": "bigint",
    "last_modified": "timestamp",
}
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            {"string": T.StringType(), "bigint": T.LongType(), "timestamp": T.TimestampType()}[kind],
        )
        for name, kind in AUDIT_COLUMNS.items()
    ]
)

TABLE_KEY = ["catalog", "schema", "table"]
VERSION_KEY = [*TABLE_KEY, "target_version"]

BACKUP, RESTORE, EXPIRE, DROP = "backup", "restore", "expire", "drop"
REGISTER = "register"
SUCCESS, FAILED = "SUCCESS", "FAILED"
PASSED, SKIPPED = "PASSED", "SKIPPED"


_KEY, _GENERATION = "table_key", "gen"
_STORED = T.StructType(
    [
        *AUDIT_SCHEMA,
        T.StructField(_KEY, T.StringType()),
        T.StructField(_GENERATION, T.IntegerType()),
    ]
)
# Files of a table's log from which on they are written as one.
MOST_FILES = 32


def table_key(catalog: str, schema: str, table: str) -> str:
    """The name of a table's folder: short, and safe in a path, whatever the table's name."""
    return hashlib.sha256("\0".join((catalog, schema, table)).encode()).hexdigest()[:16]


def _key_column() -> Column:
    """`table_key` of the columns."""
    names = F.concat(F.col("catalog"), F.lit("\0"), F.col("schema"), F.lit("\0"), F.col("table"))
    return F.substring(F.sha2(names, 256), 1, 16)


def _empty(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in AUDIT_COLUMNS.items()]
    )


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all generations, with their folders."""
    return spark.read.schema(_STORED).parquet(path)


def _newest(stored: DataFrame) -> DataFrame:
    """Rows of each table's newest generation."""
    newest = stored.groupBy(_KEY).agg(F.max(_GENERATION).alias(_GENERATION))
    return stored.join(newest, [_KEY, _GENERATION])


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The log at `path`, empty if nothing was logged yet."""
    if not filesystem.exists(spark, path):
        return _empty(spark)
    return _newest(_stored(spark, path)).select(*AUDIT_COLUMNS)


def read_table_audit(spark: SparkSession, path: str, key: Mapping[str, str]) -> DataFrame:
    """What the log says about one table; only this table's folder is listed and read."""
    folder = f"{path}/{_KEY}={table_key(*(key[c] for c in TABLE_KEY))}"
    generation = _generation(spark, folder)
    if generation is None:
        return _empty(spark)
    rows = spark.read.schema(AUDIT_SCHEMA).parquet(f"{folder}/{_GENERATION}={generation}")
    for name in TABLE_KEY:
        rows = rows.filter(F.col(name) == key[name])
    return rows


def _generation(spark: SparkSession, folder: str) -> int | None:
    """The newest generation in a table's folder that has a file."""
    names = filesystem.children(spark, folder)
    prefix = f"{_GENERATION}="
    found = sorted((int(n.removeprefix(prefix)) for n in names if n.startswith(prefix)), reverse=True)
    for generation in found:
        files = filesystem.children(spark, f"{folder}/{prefix}{generation}")
        if any(f.startswith("part-") for f in files):
            return generation
    return None


def append_row(spark: SparkSession, path: str, row: Mapping[str, Any]) -> None:
    """Append one operation on one table; columns left out are NULL."""
    folder = f"{path}/{_KEY}={table_key(*(row[c] for c in TABLE_KEY))}"
    generation = _generation(spark, folder) or 0
    rows = spark.range(1).select(*[F.lit(v).alias(name) for name, v in row.items()])
    _columns(rows).coalesce(1).write.mode("append").parquet(f"{folder}/{_GENERATION}={generation}")


def append(rows: DataFrame, path: str) -> None:
    """Append operations given as a DataFrame; columns left out are NULL."""
    spark = rows.sparkSession
    keyed = _columns(rows).withColumn(_KEY, _key_column())
    if filesystem.exists(spark, path):
        newest = _stored(spark, path).groupBy(_KEY).agg(F.max(_GENERATION).alias(_GENERATION))
        keyed = keyed.join(newest, _KEY, "left")
    else:
        keyed = keyed.withColumn(_GENERATION, F.lit(None).cast("int"))
    _write(keyed.withColumn(_GENERATION, F.coalesce(_GENERATION, F.lit(0))), path)


def _columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in AUDIT_COLUMNS.items()
        ]
    )


def _write(rows: DataFrame, path: str) -> None:
    """One file for each table that has rows, whole or not there."""
    placed = rows.select(*AUDIT_COLUMNS, _KEY, _GENERATION).repartition(_KEY)
    placed.write.mode("append").partitionBy(_KEY, _GENERATION).parquet(path)


def compact(spark: SparkSession, path: str, least_files: int = MOST_FILES) -> int:
    """Write the log of every table that has `least_files` files or more as one file.

    One job for all tables; returns how many it was. The files that were replaced stay until
    the next compaction of their table, so a reader that began before can end. Nothing must
    be appended meanwhile.
    """
    if not filesystem.exists(spark, path):
        return 0
    stored = _stored(spark, path)
    files = stored.groupBy(_KEY, _GENERATION).agg(
        F.countDistinct(stored["_metadata.file_path"]).alias("files")
    )
    last = files.groupBy(_KEY).agg(F.max_by(F.struct(_GENERATION, "files"), _GENERATION).alias("at"))
    crowded = last.where(F.col("at.files") >= least_files).select(_KEY, f"at.{_GENERATION}")
    tables = {r[_KEY]: r[_GENERATION] for r in crowded.collect()}  # names of folders, no rows
    if tables:
        rows = stored.join(crowded, [_KEY, _GENERATION])
        _write(rows.withColumn(_GENERATION, F.col(_GENERATION) + 1), path)
    for key, generation in tables.items():
        folder = f"{path}/{_KEY}={key}"
        for name in filesystem.children(spark, folder):
            if name.startswith(f"{_GENERATION}=") and int(name.partition("=")[2]) < generation:
                filesystem.delete(spark, f"{folder}/{name}")
    return len(tables)


def _operations(audit: DataFrame, operation: str, status: str = SUCCESS) -> DataFrame:
    return audit.filter((F.col("operation") == operation) & (F.col("status") == status))


def last_success(audit: DataFrame) -> DataFrame:
    """One row per table: the time of its last successful backup."""
    return _operations(audit, BACKUP).groupBy(*TABLE_KEY).agg(
        F.max("timestamp").alias("last_backup")
    )


def published(audit: DataFrame) -> DataFrame:
    """The backup row of every version that can be restored now."""
    gone = _operations(audit, EXPIRE).select(*VERSION_KEY)
    return _operations(audit, BACKUP).join(gone, VERSION_KEY, "left_anti")


def latest_versions(audit: DataFrame) -> DataFrame:
    """One row per table: its newest version that can be restored."""
    return published(audit).groupBy(*TABLE_KEY).agg(
        F.max("target_version").alias("target_version")
    )


def discarded(audit: DataFrame) -> DataFrame:
    """Copies that failed and were not expired yet; nothing reads them."""
    gone = _operations(audit, EXPIRE).select(*VERSION_KEY)
    return (
        _operations(audit, BACKUP, FAILED)
        .filter("target_version IS NOT NULL AND storage_location IS NOT NULL")
        .join(gone, VERSION_KEY, "left_anti")
    )


def kept(audit: DataFrame) -> DataFrame:
    """The backup row of every version, good or failed, whose files are not known to be gone."""
    gone = _operations(audit, DROP).select(*VERSION_KEY)
    copies = audit.filter((F.col("operation") == BACKUP) & F.col("storage_location").isNotNull())
    return copies.join(gone, VERSION_KEY, "left_anti")


def undeleted(audit: DataFrame) -> DataFrame:
    """Expired versions whose files are not known to be gone, as after an interrupted cleanup."""
    dropped = _operations(audit, DROP).select(*VERSION_KEY)
    return _operations(audit, EXPIRE).join(dropped, VERSION_KEY, "left_anti")
