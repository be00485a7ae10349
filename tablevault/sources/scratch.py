"""Where intermediate tables go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that the session names for intermediate data.

    A session without that setting uses a folder below its warehouse, which all executors
    share too; never a folder of one machine.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/tablevault/{label}-{uuid4().hex}"
