import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tablevault import TableName, cleanup, load_plan, run_backup
from tablevault.sources import filesystem

DAY = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def loaded(spark, folder, document):
    path = folder / "plan.json"
    path.write_text(json.dumps(document))
    return load_plan(spark, str(path))


@pytest.fixture
def plan(spark, tmp_path):
    def made(tables, **top):
        document = {
            "backup_catalog": "backup", "backup_schema": "dr",
            "catalogs": {"shop": {"schemas": {"sales": {"tables": {
                name: {"backup_frequency": "daily", "priority": 1} | entry
                for name, entry in tables.items()
            }}}}},
        } | top
        return loaded(spark, tmp_path, document)

    return made


@pytest.fixture
def source(sample):
    return lambda name: sample.filter(F.lit(name.table != "empty"))


def missing_for(*absent):
    def wrap(source):
        def find(name):
            if name.table in absent:
                raise LookupError(f"no such table: {name}")
            return source(name)

        return find

    return wrap


def outcomes(log):
    return {r.table: (r.status, r.verification_status) for r in log.collect()}


@pytest.mark.parametrize("method", ["exact", "fingerprint", "sample"])
def test_due_tables_are_cloned_verified_and_logged(vault, plan, source, sample, method):
    log = run_backup(vault, plan({"a": {}, "empty": {}}), source=source, as_of=DAY, method=method)
    assert outcomes(log) == {"a": ("SUCCESS", "PASSED"), "empty": ("SUCCESS", "PASSED")}
    assert vault.read(TableName("shop", "sales", "a")).count() == 3
    row = log.filter("table = 'a'").first()
    assert row.storage_location == f"{vault.root}/backup/dr/shop/sales/a/v=1"
    details = json.loads(row.verification_details)
    assert details["passed"] is True and details["target_rows"] == 3
    assert vault.spark.catalog.databaseExists("backup_dr")


def test_tables_run_in_priority_order(vault, plan, source):
    seen = []

    def watch(name):
        seen.append(name.table)
        return source(name)

    tables = {"low": {}, "high": {"priority": 9}, "later": {}}
    run_backup(vault, plan(tables), source=watch, as_of=DAY)
    assert seen == ["high", "low", "later"]


def test_a_second_run_waits_for_the_interval(vault, plan, source):
    tables = plan({"a": {}})
    run_backup(vault, tables, source=source, as_of=DAY)
    soon = run_backup(vault, tables, source=source, as_of=DAY + dt.timedelta(hours=23))
    assert soon.count() == 0
    later = run_backup(vault, tables, source=source, as_of=DAY + dt.timedelta(days=1))
    assert [r.target_version for r in later.collect()] == [2]


def test_an_error_stops_a_fail_fast_run(vault, plan, source):
    tables = plan({"bad": {"priority": 2}, "good": {}})
    with pytest.raises(LookupError, match="no such table: shop.sales.bad"):
        run_backup(vault, tables, source=missing_for("bad")(source), as_of=DAY)
    assert outcomes(vault.audit()) == {"bad": ("FAILED", "SKIPPED")}
    assert "no such table" in vault.audit().first().error_message


def test_an_error_does_not_stop_other_runs(vault, plan, source):
    tables = plan({"bad": {"priority": 2, "error_handling": {"fail_fast": False}}, "good": {}})
    log = run_backup(vault, tables, source=missing_for("bad")(source), as_of=DAY)
    assert outcomes(log) == {"bad": ("FAILED", "SKIPPED"), "good": ("SUCCESS", "PASSED")}


def test_an_error_while_copying(vault, plan, sample):
    def broken(name):
        return sample.withColumn("value", F.expr("int(raise_error('disk lost'))"))

    with pytest.raises(Exception, match="disk lost"):
        run_backup(vault, plan({"a": {}}), source=broken, as_of=DAY)
    assert outcomes(vault.audit()) == {"a": ("FAILED", "SKIPPED")}
    assert vault.versions().count() == 0


@pytest.fixture
def damaging(vault, monkeypatch):
    """Copies lose a row after they were written."""
    from tablevault.operators.snapshots import Snapshot

    whole = Snapshot.read
    monkeypatch.setattr(Snapshot, "read", lambda self, spark: whole(self, spark).filter("id <> 2"))


@pytest.mark.parametrize("method", ["exact", "fingerprint", "sample"])
def test_a_failed_check_stops_a_fail_fast_run(vault, plan, source, damaging, method):
    tables = plan({"a": {"priority": 2}, "b": {}})
    with pytest.raises(RuntimeError, match="Verification failed for shop.sales.a"):
        run_backup(vault, tables, source=source, as_of=DAY, method=method)
    row = vault.audit().first()
    assert (row.status, row.verification_status) == ("FAILED", "FAILED")
    assert json.loads(row.verification_details)["target_rows"] == 2
    assert vault.versions().count() == 0


def test_a_failed_check_alone_is_no_error(vault, plan, source, damaging):
    tables = plan({"a": {"error_handling": {"fail_fast": False}}})
    log = run_backup(vault, tables, source=source, as_of=DAY)
    assert outcomes(log) == {"a": ("FAILED", "FAILED")}
    # Not published, so still due.
    again = run_backup(vault, tables, source=source, as_of=DAY)
    assert [r.target_version for r in again.collect()] == [2]


@pytest.mark.parametrize(
    "verification",
    [{"enabled": False}, {"row_count_check": False, "data_sample_check": False}],
)
def test_switched_off_checks_do_not_run(vault, plan, source, damaging, verification):
    log = run_backup(vault, plan({"a": {"verification": verification}}), source=source, as_of=DAY)
    expected = "PASSED" if "row_count_check" in verification else "SKIPPED"
    assert outcomes(log) == {"a": ("SUCCESS", expected)}


def test_row_count_check_alone(vault, plan, source, damaging):
    tables = plan({"a": {"verification": {"data_sample_check": False},
                         "error_handling": {"fail_fast": False}}})
    log = run_backup(vault, tables, source=source, as_of=DAY)
    assert outcomes(log) == {"a": ("FAILED", "FAILED")}


def test_sample_size_is_honoured(vault, plan, source, damaging):
    only_sample = {"row_count_check": False, "sample_size": 1}
    log = run_backup(
        vault, plan({"a": {"verification": only_sample}}), source=source, as_of=DAY,
        method="sample",
    )
    assert outcomes(log) == {"a": ("SUCCESS", "PASSED")}


def test_namespace_failure_fails_the_run(vault, plan, source, monkeypatch):
    def refused(*args):
        raise PermissionError("no rights")

    monkeypatch.setattr(type(vault), "create_namespace", refused)
    with pytest.raises(PermissionError):
        run_backup(vault, plan({"a": {"error_handling": {"fail_fast": False}}}), source=source)


def test_catalog_tables_are_found_by_name(spark, vault, sample, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS sales")
    spark.sql("DROP TABLE IF EXISTS sales.t")
    sample.write.partitionBy("name").saveAsTable("sales.t")
    document = {
        "backup_catalog": "backup", "backup_schema": "dr",
        "catalogs": {"spark_catalog": {"schemas": {"sales": {"tables": {
            "t": {"backup_frequency": "daily", "priority": 1}}}}}},
    }
    plan = loaded(spark, tmp_path, document)
    row = run_backup(vault, plan, as_of=DAY).first()
    assert (row.status, row.verification_status) == ("SUCCESS", "PASSED")
    assert json.loads(row.partition_info)["columns"] == ["name"]
    assert "partition" in row.source_table_properties


def test_unknown_storage_falls_back_to_the_vault(vault, plan, source):
    storage = {"type": "ftp", "container_name": "box", "path_prefix": "", "use_external_location": True}
    row = run_backup(vault, plan({"a": {}}, storage=storage), source=source, as_of=DAY).first()
    assert row.storage_location.startswith(vault.root)


def test_unknown_method(vault, plan):
    with pytest.raises(ValueError):
        run_backup(vault, plan({"a": {}}), method="guess")


def test_cleanup_removes_what_expired(spark, vault, plan, source):
    tables = plan({"a": {}})
    for day in (0, 1, 9):
        run_backup(vault, tables, source=source, as_of=DAY + dt.timedelta(days=day))
    paths = {r.target_version: r.storage_location for r in vault.versions().collect()}
    assert cleanup(vault, tables, as_of=DAY + dt.timedelta(days=8)) == 1
    assert not filesystem.exists(spark, paths[1]) and filesystem.exists(spark, paths[2])
    assert cleanup(vault, tables, as_of=DAY + dt.timedelta(days=400)) == 1
    assert [r.target_version for r in vault.versions().collect()] == [3]
    operations = [r.operation for r in vault.audit().collect()]
    assert operations.count("expire") == operations.count("drop") == 2


def test_cleanup_removes_failed_copies(spark, vault, plan, source, damaging):
    tables = plan({"a": {"error_handling": {"fail_fast": False}}})
    path = run_backup(vault, tables, source=source, as_of=DAY).first().storage_location
    assert cleanup(vault, tables, as_of=DAY + dt.timedelta(days=7)) == 0
    assert cleanup(vault, tables, as_of=DAY + dt.timedelta(days=8)) == 1
    assert not filesystem.exists(spark, path)


def test_sql_reads_the_newest_passed_backup(vault, plan, source, spark):
    tables = plan({"a": {}}, backup_schema="seen")
    run_backup(vault, tables, source=source, as_of=DAY)
    assert spark.sql("SELECT count(*) FROM backup_seen.shop_sales_a").first()[0] == 3
    later = lambda name: source(name).limit(1)
    run_backup(vault, tables, source=later, as_of=DAY + dt.timedelta(days=2))
    assert spark.sql("SELECT count(*) FROM backup_seen.shop_sales_a").first()[0] == 1
    spark.sql("DROP SCHEMA backup_seen CASCADE")


def test_the_namespace_is_made_even_if_nothing_is_due(vault, plan, source, spark):
    tables = plan({"a": {"backup_frequency": "daily"}}, backup_schema="idle")
    run_backup(vault, tables, source=source, as_of=DAY)
    spark.sql("DROP SCHEMA backup_idle CASCADE")
    run_backup(vault, tables, source=source, as_of=DAY)
    assert spark.catalog.databaseExists("backup_idle")
    spark.sql("DROP SCHEMA backup_idle CASCADE")


def test_tables_of_one_name_get_folders_of_their_own(vault, spark):
    from tablevault.jobs.backup import _location

    row = {"storage_location": "s3://c/p/orders", "use_external_location": True}
    shared, name = {"s3://c/p/orders"}, TableName("shop", "sales", "orders")
    assert _location(vault, row, name, shared) == "s3://c/p/shop/sales/orders"
    assert _location(vault, row, name, set()) == "s3://c/p/orders"


def test_an_address_without_account_is_an_error(vault, plan, source):
    storage = {
        "type": "abfss", "container_name": "box", "path_prefix": "p",
        "use_external_location": True,
    }
    log = run_backup(
        vault, plan({"a": {"error_handling": {"fail_fast": False}}}, storage=storage), source=source,
        as_of=DAY,
    )
    row = log.first()
    assert row.status == "FAILED" and "lacks an account" in row.error_message


def test_tables_side_by_side(vault, plan, source, spark):
    tables = plan({f"t{i}": {"priority": i} for i in range(9)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = run_backup(vault, tables, source=source, as_of=DAY, side_by_side=4)
    assert outcomes(log) == {f"t{i}": ("SUCCESS", "PASSED") for i in range(9)}
    assert all(vault.read(TableName("shop", "sales", f"t{i}")).count() == 3 for i in range(9))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert run_backup(vault, tables, source=source, as_of=DAY, side_by_side=4).count() == 0


def test_tables_side_by_side_begin_in_order(vault, plan, source):
    begun = []

    def noting(name):
        begun.append(name.table)
        return source(name)

    run_backup(vault, plan({f"t{i}": {"priority": i} for i in range(6)}), source=noting, side_by_side=2)
    places = {t: i for i, t in enumerate(begun)}
    assert all(abs(places[f"t{i}"] - (5 - i)) <= 2 for i in range(6))


def test_an_error_side_by_side_begins_no_other(vault, plan, source):
    tables = plan({"a": {"priority": 9}, **{f"t{i}": {"priority": i} for i in range(6)}})
    with pytest.raises(LookupError, match="no such table"):
        run_backup(vault, tables, source=missing_for("a")(source), as_of=DAY, side_by_side=2)
    seen = outcomes(vault.audit().where("operation = 'backup'"))
    assert seen.pop("a") == ("FAILED", "SKIPPED")
    assert "t5" in seen and "t0" not in seen
    assert set(seen.values()) == {("SUCCESS", "PASSED")}


def test_an_error_alone_side_by_side(vault, plan, source):
    tables = {"a": {"priority": 9, "error_handling": {"fail_fast": False}}, "b": {}, "c": {}}
    log = run_backup(vault, plan(tables), source=missing_for("a")(source), as_of=DAY, side_by_side=3)
    assert outcomes(log) == {
        "a": ("FAILED", "SKIPPED"), "b": ("SUCCESS", "PASSED"), "c": ("SUCCESS", "PASSED"),
    }
