"""How long backups are kept, and which have expired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.functions.time import AsOf, age_days
from tablevault.plans.audit import TABLE_KEY, discarded, published

# Days to keep backups, by frequency, and the general limit.
RETENTION_DAYS = {"daily": 7, "weekly": 30, "monthly": 90}
DEFAULT_RETENTION_DAYS = 30


def retention_days(plan: DataFrame) -> DataFrame:
    """One row: the days that apply to every table without its own setting.

    The shortest period any planned frequency asks for, and never more than the general
    limit; that limit alone for an empty plan.
    """
    period = F.lit(None).cast("int")
    for frequency, days in RETENTION_DAYS.items():
        period = F.when(F.col("backup_frequency") == frequency, days).otherwise(period)
    return plan.agg(
        F.least(F.lit(DEFAULT_RETENTION_DAYS), F.min(period)).alias("retention_days")
    )


def expired(audit: DataFrame, plan: DataFrame, as_of: AsOf) -> DataFrame:
    """Versions older than their retention, with their age.

    A table's own `retention_days` comes before the general rule, which also covers backups
    of tables no longer planned. A table's newest good version always stays. Copies that
    failed expire by the same age.
    """
    good = published(audit)
    newest = good.groupBy(*TABLE_KEY).agg(F.max("target_version").alias("__newest"))
    candidates = (
        good.join(newest, TABLE_KEY)
        .filter(F.col("target_version") < F.col("__newest"))
        .drop("__newest")
        .unionByName(discarded(audit))
    )
    own = plan.filter("retention_days IS NOT NULL").select(
        *TABLE_KEY, F.col("retention_days").alias("__own")
    )
    general = retention_days(plan).scalar()
    return (
        candidates.join(own, TABLE_KEY, "left")
        .withColumn("age_days", age_days(F.col("timestamp"), as_of))
        .withColumn("retention_days", F.coalesce(F.col("__own"), general))
        .drop("__own")
        .filter(F.col("age_days") > F.col("retention_days"))
    )
