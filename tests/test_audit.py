"""The audit log by table: lookups, appends, compaction, and names that cannot clash."""

from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablevault import TableName, cleanup, registered_name, registered_table
from tablevault.plans import audit as log


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "_audit")


def entry(table, **more):
    return {
        "operation": log.BACKUP, "catalog": "shop", "schema": "sales", "table": table,
        "status": log.SUCCESS, "target_version": 1,
    } | more


def name(table):
    return {"catalog": "shop", "schema": "sales", "table": table}


def files(path, table, generation=None):
    folder = Path(path) / f"table_key={log.table_key('shop', 'sales', table)}"
    return sorted(folder.glob(f"gen={'*' if generation is None else generation}/part-*.parquet"))


def content(rows):
    return sorted(map(str, rows.collect()))


def test_one_table_is_read_from_its_own_folder(spark, path):
    for table in ("a", "b"):
        for version in (1, 2):
            log.append_row(spark, path, entry(table, target_version=version))
    rows = log.read_table_audit(spark, path, name("a"))
    assert sorted(r.target_version for r in rows.collect()) == [1, 2]
    assert rows.columns == list(log.AUDIT_COLUMNS) == log.read_audit(spark, path).columns
    assert {Path(f).parent.parent.name for f in rows.inputFiles()} == {
        f"table_key={log.table_key('shop', 'sales', 'a')}"
    }
    assert log.read_audit(spark, path).count() == 4


def test_a_log_that_is_not_there(spark, path):
    assert log.read_audit(spark, path).count() == 0
    assert log.read_table_audit(spark, path, name("a")).count() == 0
    assert log.compact(spark, path) == 0


def test_rows_of_many_tables_go_to_their_folders(spark, path):
    log.append_row(spark, path, entry("a"))
    rows = spark.createDataFrame(
        [("shop", "sales", t, "expire") for t in ("a", "b", "ü/x")],
        "catalog string, schema string, table string, operation string",
    )
    log.append(rows, path)
    assert [r.operation for r in log.read_table_audit(spark, path, name("ü/x")).collect()] == ["expire"]
    assert len(files(path, "a")) == 2 and len(files(path, "b")) == 1


def test_compaction_changes_no_row(spark, path):
    for version in range(5):
        log.append_row(spark, path, entry("busy", target_version=version))
    log.append_row(spark, path, entry("calm"))
    before = content(log.read_audit(spark, path))
    assert log.compact(spark, path, least_files=5) == 1
    assert content(log.read_audit(spark, path)) == before
    assert len(files(path, "busy", 1)) == 1 and len(files(path, "calm")) == 1
    # Appending goes on in the new generation, and the old one goes with the next.
    log.append_row(spark, path, entry("busy", target_version=9))
    log.append(spark.createDataFrame([tuple(name("busy").values())], "catalog string, schema string, table string"), path)
    assert len(files(path, "busy", 1)) == 3
    assert log.compact(spark, path, least_files=3) == 1
    assert not files(path, "busy", 0) and len(files(path, "busy", 2)) == 1
    versions = [r.target_version for r in log.read_table_audit(spark, path, name("busy")).collect()]
    assert sorted(v for v in versions if v is not None) == [0, 1, 2, 3, 4, 9]
    assert log.compact(spark, path, least_files=2) == 0


def test_a_compaction_that_stopped_is_seen_whole_or_not(spark, path):
    for version in range(3):
        log.append_row(spark, path, entry("a", target_version=version))
    before = content(log.read_audit(spark, path))
    folder = files(path, "a")[0].parent.parent
    (folder / "gen=1" / "_temporary").mkdir(parents=True)
    (folder / "gen=1" / "_temporary" / "part-0.parquet").write_bytes(b"half")
    assert content(log.read_audit(spark, path)) == before
    assert content(log.read_table_audit(spark, path, name("a"))) == before
    log.append_row(spark, path, entry("a", target_version=7))
    assert len(files(path, "a", 0)) == 4


def test_clean_up_compacts(spark, vault, sample, name):
    vault.clone(sample, name)
    for version in range(log.MOST_FILES):
        log.append_row(spark, vault.audit_path, name.key | {"operation": "note"})
    plan = spark.createDataFrame([("daily",)], "backup_frequency string").select(
        "*", *[F.lit(v).alias(k) for k, v in name.key.items()], F.lit(None).cast("int").alias("retention_days")
    )
    cleanup(vault, plan)
    assert len(vault._history(name).inputFiles()) == 1
    assert vault.read(name).count() == 3


def test_lookups_do_not_grow_with_other_tables(spark, vault, sample, name):
    vault.clone(sample, name)
    others = spark.range(200).select(
        F.lit("shop").alias("catalog"), F.lit("other").alias("schema"),
        F.concat(F.lit("t"), "id").alias("table"), F.lit("backup").alias("operation"),
    )
    log.append(others, vault.audit_path)
    assert vault.audit().count() == 201
    assert len(vault._history(name).inputFiles()) == 1
    assert vault.clone(sample, name).version == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.text("ab_5f-.é A", min_size=1, max_size=5)] * 3), min_size=1, max_size=6))
def test_registered_names_can_be_undone(names):
    for parts in names:
        full = registered_name("ns", TableName(*parts))
        assert registered_table(full.removeprefix("ns.").strip("`")) == TableName(*parts)


def test_registered_names_do_not_clash():
    tables = [("a", "b_c", "t"), ("a_b", "c", "t"), ("a", "b", "c_t"), ("a", "b", "t")]
    found = {registered_name("ns", TableName(*t)) for t in tables}
    assert len(found) == 4 and "ns.`a_b_t`" in found


def test_a_failed_registration_is_logged(vault, plan_of, spark, sample):
    from tablevault import run_backup

    plan = plan_of("a")
    namespace = vault.create_namespace("backup", "taken")
    spark.sql(f"CREATE TABLE {namespace}.`shop_sales_a` AS SELECT 1 AS id")
    assert [r.status for r in run_backup(vault, plan, source=lambda _: sample).collect()] == ["SUCCESS"]
    rows = vault.audit().collect()
    assert {r.operation: r.status for r in rows} == {"backup": "SUCCESS", "register": "FAILED"}
    assert "no registered version" in [r.error_message for r in rows if r.operation == "register"][0]
    assert vault.read(TableName("shop", "sales", "a")).count() == 3
    spark.sql(f"DROP TABLE {namespace}.`shop_sales_a`")


@pytest.fixture
def plan_of(spark):
    def made(table):
        return spark.sql(
            f"""SELECT 0L ordinal, 'shop' catalog, 'sales' schema, '{table}' `table`, 1 priority,
            'daily' backup_frequency, true verify_enabled, true row_count_check,
            true data_sample_check, 10 sample_size, true fail_fast, 'backup' backup_catalog,
            'taken' backup_schema, false use_external_location, string(NULL) storage_type,
            string(NULL) account, string(NULL) container_name, string(NULL) path_prefix"""
        )

    return made
