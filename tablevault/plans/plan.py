"""The backup plan: which tables to protect, how often, and where to.

A plan is a relation with one row per table. It comes from a nested configuration
document (backup target, storage, then catalogs, schemas, tables) or from any DataFrame
with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.time import AsOf, age_days
from tablevault.operators.rows import numbered
from tablevault.plans.audit import TABLE_KEY, last_success

# Days between backups, by frequency.
FREQUENCY_DAYS = {"daily": 1, "weekly": 7, "monthly": 30}

# What a table gets when its configuration does not say.
VERIFY_ENABLED = True
ROW_COUNT_CHECK = True
DATA_SAMPLE_CHECK = True
SAMPLE_SIZE = 1000
FAIL_FAST = True
MAX_RETRIES = 3
RETRY_DELAY_SECONDS = 60
USE_EXTERNAL_LOCATION = False

_STORAGE = (
    "struct<type string, storage_type string, account string, container string, "
    "container_name string, path_prefix string, use_external_location boolean>"
)
_TABLE = (
    "struct<backup_frequency string, priority int, retention_days int, "
    "verification struct<enabled boolean, row_count_check boolean, "
    "data_sample_check boolean, sample_size int>, "
    "error_handling struct<fail_fast boolean, max_retries int, retry_delay_seconds int>, "
    f"storage {_STORAGE}>"
)
DOCUMENT_SCHEMA = (
    "backup_catalog string, backup_schema string, "
    "backup_location struct<catalog string, schema string>, "
    f"storage {_STORAGE}, "
    "settings struct<verification_enabled boolean, retention_days int, max_retries int>, "
    f"catalogs map<string, struct<schemas map<string, struct<tables map<string, {_TABLE}>>>>>"
)

PLAN_ORDER = [*TABLE_KEY]


def load_plan(spark: SparkSession, path: str) -> DataFrame:
    """Read one JSON configuration document as a plan."""
    return plan_rows(spark.read.text(path, wholetext=True), "value")


def plan_rows(documents: DataFrame, json_col: str, first_ordinal: str | None = None) -> DataFrame:
    """Flatten configuration documents, one per row of text, into plan rows.

    `ordinal` counts tables in document order. Where a plan is spread over many documents,
    `first_ordinal` names the column with each document's first ordinal. Malformed text is
    an error, and so is a table without frequency or priority.
    """
    start = F.col(first_ordinal) if first_ordinal else F.lit(0)
    parsed = documents.select(
        start.cast("bigint").alias("first"),
        F.from_json(F.col(json_col), DOCUMENT_SCHEMA, {"mode": "FAILFAST"}).alias("doc"),
    )
    tables = parsed.select("first", "doc", F.posexplode(_tables(F.col("doc.catalogs"))))
    entry, doc = F.col("col.entry"), F.col("doc")
    storage = F.coalesce(entry["storage"], doc["storage"])
    checks, errors, settings = entry["verification"], entry["error_handling"], doc["settings"]
    name = F.concat_ws(".", "col.catalog", "col.schema", "col.table")
    return tables.select(
        (F.col("first") + F.col("pos")).alias("ordinal"),
        F.col("col.catalog").alias("catalog"),
        F.col("col.schema").alias("schema"),
        F.col("col.table").alias("table"),
        _required(entry["backup_frequency"], "string", "backup_frequency", name).alias(
            "backup_frequency"
        ),
        _required(entry["priority"], "int", "priority", name).alias("priority"),
        F.coalesce(
            checks["enabled"], settings["verification_enabled"], F.lit(VERIFY_ENABLED)
        ).alias("verify_enabled"),
        F.coalesce(checks["row_count_check"], F.lit(ROW_COUNT_CHECK)).alias("row_count_check"),
        F.coalesce(checks["data_sample_check"], F.lit(DATA_SAMPLE_CHECK)).alias(
            "data_sample_check"
        ),
        F.coalesce(checks["sample_size"], F.lit(SAMPLE_SIZE)).alias("sample_size"),
        F.coalesce(errors["fail_fast"], F.lit(FAIL_FAST)).alias("fail_fast"),
        F.coalesce(errors["max_retries"], settings["max_retries"], F.lit(MAX_RETRIES)).alias(
            "max_retries"
        ),
        F.coalesce(errors["retry_delay_seconds"], F.lit(RETRY_DELAY_SECONDS)).alias(
            "retry_delay_seconds"
        ),
        F.coalesce(entry["retention_days"], settings["retention_days"]).alias("retention_days"),
        F.coalesce(storage["storage_type"], storage["type"]).alias("storage_type"),
        storage["account"].alias("account"),
        F.coalesce(storage["container_name"], storage["container"]).alias("container_name"),
        storage["path_prefix"].alias("path_prefix"),
        F.coalesce(storage["use_external_location"], F.lit(USE_EXTERNAL_LOCATION)).alias(
            "use_external_location"
        ),
        _required(
            F.coalesce(doc["backup_catalog"], doc["backup_location"]["catalog"]),
            "string", "backup_catalog", F.lit("the document"),
        ).alias("backup_catalog"),
        _required(
            F.coalesce(doc["backup_schema"], doc["backup_location"]["schema"]),
            "string", "backup_schema", F.lit("the document"),
        ).alias("backup_schema"),
    )


def _tables(catalogs: Column) -> Column:
    """All tables of a document as one array, in document order."""
    per_catalog = F.transform(
        F.map_entries(catalogs),
        lambda c: F.transform(
            F.map_entries(c["value"]["schemas"]),
            lambda s: F.transform(
                F.map_entries(s["value"]["tables"]),
                lambda t: F.struct(
                    c["key"].alias("catalog"),
                    s["key"].alias("schema"),
                    t["key"].alias("table"),
                    t["value"].alias("entry"),
                ),
            ),
        ),
    )
    return F.flatten(F.flatten(per_catalog))


def _required(value: Column, dtype: str, field: str, where: Column) -> Column:
    problem = F.concat(F.lit(f"missing {field} in "), where)
    return F.coalesce(value, F.raise_error(problem).cast(dtype))


STORAGE_TYPES = ("abfss", "s3", "gcs")


def with_location(plan: DataFrame) -> DataFrame:
    """Add `storage_location`: the external address of a table's backups.

    NULL when external storage is off or its type is not one of abfss, s3 and gcs.
    """
    tail = F.concat_ws("/", F.nullif(F.col("path_prefix"), F.lit("")), F.col("table"))
    kind = F.lower("storage_type")
    address = (
        F.when(
            kind == "abfss",
            F.concat(
                F.lit("abfss://"), "container_name", F.lit("@"), "account",
                F.lit(".dfs.core.windows.net/"), tail,
            ),
        )
        .when(kind == "s3", F.concat(F.lit("s3://"), "container_name", F.lit("/"), tail))
        .when(kind == "gcs", F.concat(F.lit("gs://"), "container_name", F.lit("/"), tail))
    )
    return plan.withColumn("storage_location", F.when(F.col("use_external_location"), address))


def with_due(plan: DataFrame, audit: DataFrame, as_of: AsOf) -> DataFrame:
    """Add each table's last successful backup, whether it is due, and why.

    A table never backed up is due whatever its frequency. Otherwise enough whole days must
    have passed; a frequency that is not known is never due. Both join sides hold one row
    per table, so no key is hot, and Spark broadcasts a side only if its size allows.
    """
    interval = F.lit(None).cast("int")
    for frequency, days in FREQUENCY_DAYS.items():
        interval = F.when(F.col("backup_frequency") == frequency, days).otherwise(interval)
    elapsed = age_days(F.col("last_backup"), as_of)
    return (
        plan.join(last_success(audit), TABLE_KEY, "left")
        .withColumn(
            "due_reason",
            F.when(F.col("last_backup").isNull(), "never backed up")
            .when(interval.isNull(), "unknown frequency")
            .when(elapsed >= interval, "interval elapsed")
            .otherwise("not yet"),
        )
        .withColumn("due", F.col("due_reason").isin("never backed up", "interval elapsed"))
    )


def ordered(plan: DataFrame) -> DataFrame:
    """Higher priority first; equal priorities keep configuration order."""
    return plan.orderBy(F.desc("priority"), "ordinal", *PLAN_ORDER)


def ranked(plan: DataFrame) -> DataFrame:
    """`ordered` as a column: `backup_rank` counts from 1. Needs no single-task sort."""
    return numbered(plan, "backup_rank", "priority", "ordinal", ties=PLAN_ORDER)


def due_tables(plan: DataFrame, audit: DataFrame, as_of: AsOf) -> DataFrame:
    """The tables to back up now, in order."""
    return ordered(with_due(plan, audit, as_of).filter("due"))
