"""What Spark's catalog and the file system know about a table."""

from __future__ import annotations

import json
import logging
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

DESCRIPTION_SCHEMA = "section string, key string, value string"


def describe(spark: SparkSession, table: str, on_error: str = "raise") -> DataFrame:
    """A table's metadata as `(section, key, value)` rows.

    Sections are 'column' (name and type), 'comment' (of a column), 'partition' (position
    and column), 'property' and 'detail' (provider, location, created_time, ...), so a name
    that occurs in several places is kept in each. With `on_error="empty"` a table that
    cannot be described gives no rows.
    """
    try:
        rows = _description(spark, table)
    except AnalysisException as error:
        if on_error != "empty":
            raise
        logger.error("Cannot describe %s: %s", table, error)
        rows = []
    return spark.createDataFrame(rows, DESCRIPTION_SCHEMA)


def _description(spark: SparkSession, table: str) -> list[tuple[str, str, str]]:
    raw = _metadata(spark, table)
    # Comments as the catalog has them: a relation may be cached from before they changed.
    comments = {c["name"]: c.get("comment") for c in raw.get("columns", [])}
    rows = []
    for field in spark.table(table).schema.fields:
        rows.append(("column", field.name, field.dataType.simpleString()))
        if comments.get(field.name):
            rows.append(("comment", field.name, comments[field.name]))
    for position, name in enumerate(raw.pop("partition_columns", [])):
        rows.append(("partition", str(position), name))
    for key, value in raw.pop("table_properties", {}).items():
        rows.append(("property", key, value))
    raw.pop("columns", None)
    for key, value in raw.items():
        rows.append(("detail", key, value if isinstance(value, str) else json.dumps(value)))
    return rows


def _metadata(spark: SparkSession, table: str) -> dict:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return _metadata(spark, table).get("partition_columns", [])


def created_time(spark: SparkSession, table: str) -> datetime | None:
    """When the catalog says the table was created; None if it does not say."""
    text = _metadata(spark, table).get("created_time")
    return datetime.fromisoformat(text) if text else None


def file_stats(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """One row about the data files below `path`: how many, bytes, newest change, partitions.

    Reads the listing only; file content is pruned from the scan.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_size_bytes"),
        F.max("modificationTime").alias("last_modified"),
        F.countDistinct(folder).alias("partition_count"),
    )
