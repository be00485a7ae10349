import datetime as dt

import pytest

from tablevault import expired, retention_days
from tablevault.plans.audit import AUDIT_SCHEMA

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
PLAN = "catalog string, schema string, table string, backup_frequency string, retention_days int"


def plan_of(spark, *rows):
    return spark.createDataFrame([("c", "s", *row) for row in rows], PLAN)


def log_of(spark, *rows):
    """(table, version, age in days, operation, status) rows."""
    columns = AUDIT_SCHEMA.fieldNames()
    made = [
        dict.fromkeys(columns)
        | {"catalog": "c", "schema": "s", "table": t, "target_version": v, "operation": o,
           "status": s, "timestamp": NOW - dt.timedelta(days=age), "storage_location": f"/v={v}"}
        for t, v, age, o, s in rows
    ]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in made], AUDIT_SCHEMA)


def gone(log, plan):
    return sorted((r.table, r.target_version) for r in expired(log, plan, NOW).collect())


@pytest.mark.parametrize(
    ("frequencies", "days"),
    [
        ([], 30), (["daily"], 7), (["weekly"], 30), (["monthly"], 30), (["monthly", "daily"], 7),
        (["monthly", "weekly"], 30), (["hourly"], 30),
    ],
)
def test_general_rule(spark, frequencies, days):
    plan = plan_of(spark, *[(str(i), f, None) for i, f in enumerate(frequencies)])
    assert retention_days(plan).first().retention_days == days


def test_age_equal_to_retention_is_kept(spark):
    log = log_of(
        spark, ("t", 1, 8, "backup", "SUCCESS"), ("t", 2, 7, "backup", "SUCCESS"),
        ("t", 3, 0, "backup", "SUCCESS"),
    )
    assert gone(log, plan_of(spark, ("t", "daily", None))) == [("t", 1)]
    row = expired(log, plan_of(spark, ("t", "daily", None)), NOW).first()
    assert (row.age_days, row.retention_days) == (8, 7)


def test_the_newest_good_version_stays(spark):
    log = log_of(
        spark, ("t", 1, 400, "backup", "SUCCESS"), ("t", 2, 300, "backup", "SUCCESS"),
        ("t", 3, 200, "backup", "FAILED"),
    )
    assert gone(log, plan_of(spark, ("t", "daily", None))) == [("t", 1), ("t", 3)]


def test_a_tables_own_retention_comes_first(spark):
    log = log_of(
        spark,
        *[(t, v, age, "backup", "SUCCESS") for t in "ab" for v, age in ((1, 50), (2, 10), (3, 1))],
        ("unplanned", 1, 50, "backup", "SUCCESS"), ("unplanned", 2, 1, "backup", "SUCCESS"),
    )
    plan = plan_of(spark, ("a", "monthly", 40), ("b", "daily", None))
    assert gone(log, plan) == [("a", 1), ("b", 1), ("b", 2), ("unplanned", 1)]


def test_versions_already_expired_are_not_listed(spark):
    log = log_of(
        spark, ("t", 1, 50, "backup", "SUCCESS"), ("t", 2, 40, "backup", "SUCCESS"),
        ("t", 3, 1, "backup", "SUCCESS"), ("t", 1, 2, "expire", "SUCCESS"),
    )
    assert gone(log, plan_of(spark, ("t", "daily", None))) == [("t", 2)]


def test_empty_log(spark):
    assert gone(log_of(spark), plan_of(spark, ("t", "daily", None))) == []
