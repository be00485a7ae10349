"""Tables at a path that keep their history when overwritten.

Where the session has the Delta source it is used. Elsewhere each write is a new snapshot,
published by the log beside it, so that an interrupted overwrite leaves the previous one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablevault.operators.snapshots import TableName, Vault

_NAME = TableName("path", "default", "data")


def has_delta(spark: SparkSession) -> bool:
    """Whether the session can read Delta tables: a data source of that name is installed."""
    sources = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        sources.lookupDataSource("delta", spark._jsparkSession.sessionState().conf())
    except Exception:
        return False
    return True


def write_delta_table(df: DataFrame, path: str) -> None:
    """Replace the table at `path` in one step, keeping earlier versions."""
    spark = df.sparkSession
    if has_delta(spark):
        df.write.format("delta").mode("overwrite").save(path)
    else:
        Vault(spark, path).clone(df, _NAME, location=f"{path.rstrip('/')}/data")


def read_delta_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of the table at `path`, or an earlier one; errors propagate."""
    if has_delta(spark):
        reader = spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        return reader.load(path)
    return Vault(spark, path).read(_NAME, version)
