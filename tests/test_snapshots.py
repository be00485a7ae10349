import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablevault import (
    Checks,
    TableName,
    deep_clone,
    describe,
    diff_rows,
    fingerprint,
    read_delta_table,
    verify_clone,
    write_delta_table,
)
from tablevault.plans import audit as log
from tablevault.sources import filesystem


def same(a, b):
    return diff_rows(a, b).count() == 0


def test_clone_is_an_independent_full_copy(vault, sample, name):
    snapshot = vault.clone(sample, name)
    assert (snapshot.version, snapshot.row_count) == (1, 3)
    assert snapshot.path == f"{vault.root}/shop/sales/orders/v=1"
    back = vault.read(name)
    assert back.schema.simpleString() == sample.schema.simpleString()
    assert same(sample, back)


def test_versions_add_up_or_stay(vault, sample, name):
    vault.clone(sample, name)
    again = vault.clone(sample.limit(0), name, mode="if_not_exists")
    assert (again.version, again.row_count) == (1, 3)
    assert vault.clone(sample.filter("id = 1"), name).version == 2
    assert vault.read(name).count() == 1
    assert vault.read(name, version=1).count() == 3
    assert vault.versions().count() == 2
    with pytest.raises(ValueError):
        vault.clone(sample, name, mode="replace")


def test_version_as_of(vault, sample, name):
    vault.clone(sample, name, as_of="2024-01-01 00:00:00")
    vault.clone(sample.limit(0), name, as_of=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert vault.read(name, as_of="2024-01-31 23:59:59").count() == 3
    assert vault.read(name, as_of=dt.datetime(2024, 2, 1)).count() == 0
    for missing in ({"as_of": "2023-12-31"}, {"version": 9}):
        with pytest.raises(LookupError, match="shop.sales.orders"):
            vault.read(name, **missing)


def test_same_table_name_in_another_schema(vault, sample):
    a, b = TableName("c", "s1", "t"), TableName("c", "s2", "t")
    vault.clone(sample, a)
    vault.clone(sample.limit(0), b)
    assert vault.read(a).count() == 3 and vault.read(b).count() == 0


def test_names_that_would_break_a_path(vault, sample):
    odd, plain = TableName("c/d", "s", "t=1"), TableName("c", "d/s", "t=1")
    assert odd.path != plain.path
    vault.clone(sample, odd)
    assert same(sample, vault.read(odd))
    assert vault._find(plain) is None


def test_a_copy_that_was_not_published_does_not_exist(vault, sample, name):
    vault.clone(sample.filter("id = 1"), name)
    left = vault.copy(sample.limit(0), name)
    assert filesystem.exists(vault.spark, left.path)
    assert vault.read(name).count() == 1
    assert vault.versions().count() == 1
    # The next copy takes the same place and replaces what was left there.
    assert vault.clone(sample, name).version == left.version
    assert same(sample, vault.read(name))


def test_a_failing_copy_keeps_the_previous_version(vault, sample, name):
    vault.clone(sample, name)
    broken = sample.withColumn("value", F.expr("int(raise_error('disk lost'))"))
    with pytest.raises(Exception, match="disk lost"):
        vault.clone(broken, name)
    assert same(sample, vault.read(name))


def test_failed_versions_keep_their_number(vault, sample, name):
    vault.publish(vault.copy(sample, name), status=log.FAILED)
    assert vault.versions().count() == 0
    assert vault.clone(sample, name).version == 2


def test_partitions_keep_types_nulls_and_column_order(spark, vault, name):
    df = spark.createDataFrame(
        [("007", 1, dt.date(2024, 1, 1)), ("08", 2, None), (None, 3, dt.date(2024, 1, 2))],
        "code string, id int, day date",
    )
    vault.clone(df, name, partition_by=["code", "day"])
    back = vault.read(name)
    assert back.columns == ["code", "id", "day"]
    assert same(df, back)
    info = json.loads(vault.versions().first().partition_info)
    assert info == {"columns": ["code", "day"], "partitions": 3}


def test_every_kind_of_column_survives(spark, vault, name):
    df = spark.sql(
        """SELECT 1 AS `a b`, map('k', array(1, NULL)) m, named_struct('x', 1.5BD, 'y', NULL) s,
        X'00FF' bin, timestamp_ntz'2024-01-01 00:00:00.123456' n, timestamp'2024-01-01' z,
        date'2024-01-01' d, float('NaN') f, array(named_struct('q', 'r')) l"""
    ).drop("s").withColumn("s", F.expr("named_struct('x', 1.5BD, 'y', int(NULL))"))
    vault.clone(df, name)
    assert same(df, vault.read(name))


def test_empty_table(vault, sample, name):
    assert vault.clone(sample.filter("id > 9"), name).row_count == 0
    assert vault.read(name).count() == 0
    assert vault.clone(sample.filter("id > 9"), name, partition_by=["name"]).version == 2
    assert vault.read(name).columns == sample.columns


def test_copy_job_takes_the_fingerprint(vault, sample, name):
    copy = vault.copy(sample, name, with_fingerprint=True)
    seen = fingerprint(copy.read(vault.spark)).first()
    assert copy.fingerprint == (seen.row_count, int(seen.checksum))


def test_audit_row(vault, sample, name):
    vault.clone(sample, name, as_of="2024-01-01 00:00:00")
    row = vault.audit().first()
    assert list(row.asDict()) == list(log.AUDIT_COLUMNS)
    assert (row.operation, row.status, row.verification_status) == ("backup", "SUCCESS", "SKIPPED")
    assert (row.row_count, row.target_version, row.source_version) == (3, 1, None)
    assert row.file_count >= 1 and row.total_size_bytes > 0 and row.last_modified is not None
    assert row.timestamp == dt.datetime(2024, 1, 1)
    files = [p for p in Path(row.storage_location).rglob("*.parquet")]
    assert row.file_count == len(files)
    assert row.total_size_bytes == sum(p.stat().st_size for p in files)


def test_restore_to_a_new_place(spark, vault, sample, name, tmp_path):
    vault.clone(sample, name)
    target = str(tmp_path / "back")
    vault.restore(name, target)
    assert same(sample, spark.read.parquet(target))
    row = vault.audit().filter("operation = 'restore'").first()
    assert (row.source_version, row.row_count, row.verification_status) == (1, 3, "PASSED")
    with pytest.raises(FileExistsError):
        vault.restore(name, target)


def test_restore_over_a_live_table(spark, vault, sample, name, tmp_path):
    target = tmp_path / "live"
    sample.limit(0).write.parquet(str(target))
    vault.clone(sample.filter("id < 3"), name)
    vault.clone(sample, name)
    vault.restore(name, str(target), version=1, overwrite=True)
    assert sorted(r.id for r in spark.read.parquet(str(target)).collect()) == [1, 2]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("live")] == ["live"]


def test_a_bad_restore_leaves_the_live_table(spark, vault, sample, name, tmp_path, monkeypatch):
    target = tmp_path / "live"
    sample.write.parquet(str(target))
    vault.clone(sample.limit(0), name)
    monkeypatch.setattr("tablevault.operators.snapshots.verify_clone", lambda *a: False)
    with pytest.raises(RuntimeError, match="does not match"):
        vault.restore(name, str(target), overwrite=True)
    assert same(sample, spark.read.parquet(str(target)))
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("live")] == ["live"]


def test_restore_keeps_partitions(spark, vault, sample, name, tmp_path):
    vault.clone(sample, name, partition_by=["name"])
    vault.restore(name, str(tmp_path / "back"), checks=Checks(fingerprint=True))
    assert (tmp_path / "back" / "name=test1").is_dir()


def test_table_metadata_comes_back(spark, vault, name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS live")
    spark.sql("DROP TABLE IF EXISTS live.orders")
    spark.sql(
        "CREATE TABLE live.orders (id INT COMMENT 'the id', day STRING) USING parquet "
        "PARTITIONED BY (day) COMMENT 'it''s all \\\\ orders' TBLPROPERTIES ('team' = 'a''b')"
    )
    spark.sql("INSERT INTO live.orders VALUES (1, '007'), (2, NULL)")
    before = spark.table("live.orders").collect()
    vault.clone("live.orders", name)
    spark.sql("TRUNCATE TABLE live.orders")
    with pytest.raises(FileExistsError):
        vault.restore_table(name, "live.orders")
    vault.restore_table(name, "live.orders", overwrite=True)
    assert sorted(spark.table("live.orders").collect(), key=str) == sorted(before, key=str)
    rows = {(r.section, r.key): r.value for r in describe(spark, "live.orders").collect()}
    assert rows["comment", "id"] == "the id"
    assert rows["partition", "0"] == "day"
    assert rows["property", "team"] == "a'b"
    assert rows["detail", "comment"] == "it's all \\ orders"
    assert spark.sql("SHOW TABLES IN live").count() == 1


def test_restore_to_a_new_table(spark, vault, sample, name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS live")
    spark.sql("DROP TABLE IF EXISTS live.fresh")
    vault.clone(sample, name)
    vault.restore_table(name, "live.fresh")
    assert same(sample, spark.table("live.fresh"))


def test_register(spark, vault, sample, name):
    namespace = vault.create_namespace("backup", "dr")
    assert namespace == "`backup_dr`"
    assert vault.create_namespace("backup", "dr") == namespace
    vault.clone(sample.selectExpr("id", "concat('00', id) AS code"), name, partition_by=["code"])
    vault.clone(sample, name)
    vault.register(name, f"{namespace}.orders", version=1)
    assert {r.code for r in spark.table("backup_dr.orders").collect()} == {"001", "002", "003"}
    vault.register(name, f"{namespace}.orders")
    assert same(sample, spark.table("backup_dr.orders"))
    assert vault.read(name, version=1).count() == 3


def test_namespace_in_a_known_catalog(vault):
    assert vault.create_namespace("spark_catalog", "kept") == "`spark_catalog`.`kept`"
    assert vault.spark.catalog.databaseExists("kept")


def test_deep_clone(spark, vault, sample):
    parts = dict(
        source_catalog="spark_catalog", source_schema="src", source_table="t",
        target_catalog="backup", target_schema="dr", target_table="t",
    )
    spark.sql("CREATE SCHEMA IF NOT EXISTS src")
    spark.sql("DROP TABLE IF EXISTS src.t")
    sample.write.saveAsTable("src.t")
    with pytest.raises(TypeError):
        deep_clone(vault, *parts.values())
    assert deep_clone(vault, **parts).version == 1
    assert deep_clone(vault, **parts).version == 1
    assert same(sample, vault.read(TableName("backup", "dr", "t")))
    with pytest.raises(Exception):
        deep_clone(vault, **(parts | {"source_table": "absent", "target_table": "absent"}))


def test_clone_to_an_external_location(vault, sample, name, tmp_path):
    place = str(tmp_path / "elsewhere")
    assert vault.clone(sample, name, location=place).path == f"{place}/v=1"
    assert same(sample, vault.read(name))


def test_dropped_versions_are_gone_and_numbers_are_not_reused(spark, vault, sample, name):
    first = vault.clone(sample, name)
    vault.clone(sample.limit(0), name)
    assert vault.drop_versions(vault.versions().filter("target_version = 1")) == 1
    assert not filesystem.exists(spark, first.path)
    assert [r.target_version for r in vault.versions().collect()] == [2]
    assert vault.clone(sample, name).version == 3


def test_an_interrupted_removal_is_finished_later(spark, vault, sample, name, monkeypatch):
    first = vault.clone(sample, name)
    vault.clone(sample, name)

    def lost(*args):
        raise OSError("store not reachable")

    monkeypatch.setattr(filesystem, "delete", lost)
    with pytest.raises(OSError):
        vault.drop_versions(vault.versions().filter("target_version = 1"))
    monkeypatch.undo()
    # Unpublished before its files went, so no reader meets a half-deleted version.
    assert [r.target_version for r in vault.versions().collect()] == [2]
    assert filesystem.exists(spark, first.path)
    assert vault.drop_versions(vault.versions().limit(0)) == 1
    assert not filesystem.exists(spark, first.path)
    assert vault.drop_versions(vault.versions().limit(0)) == 0


def test_versioned_path(spark, sample, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(Exception):
        read_delta_table(spark, path)
    write_delta_table(sample, path)
    write_delta_table(read_delta_table(spark, path).filter("id > 1"), path)
    assert read_delta_table(spark, path).count() == 2
    assert read_delta_table(spark, path, version=1).count() == 3


def test_an_empty_text_as_partition_value_is_reported(spark, vault, name):
    df = spark.sql("SELECT * FROM VALUES ('', 1), ('x', 2) AS t(code, id)")
    vault.clone(df, name, partition_by=["code"])
    assert not verify_clone(df, vault.read(name))
    vault.clone(df, name)
    assert verify_clone(df, vault.read(name))


def test_restore_of_a_damaged_snapshot_fails(spark, vault, name, tmp_path):
    rows = spark.range(1000).repartition(4)
    path = vault.clone(rows, name).path
    next(Path(path).glob("part-*.parquet")).unlink()
    target = str(tmp_path / "target")
    with pytest.raises(RuntimeError, match="damaged"):
        vault.restore(name, target)
    assert not Path(target).exists() and not list(tmp_path.glob("target*"))


def test_restore_sees_changed_rows(spark, vault, name, tmp_path):
    path = vault.clone(spark.range(10), name).path
    spark.range(10, 20).write.mode("overwrite").parquet(path)
    with pytest.raises(RuntimeError, match="not those"):
        vault.restore(name, str(tmp_path / "target"))


def test_restored_table_with_quoted_nested_names(spark, vault, name):
    rows = spark.sql("SELECT 1 AS id, named_struct('a b', 2, 'c', array(named_struct('d.e', 3))) AS s")
    vault.clone(rows, name)
    spark.sql("CREATE TABLE quoted_live AS SELECT 7 AS id")
    vault.restore_table(name, "quoted_live", overwrite=True)
    assert spark.table("quoted_live").collect() == rows.collect()
    spark.sql("DROP TABLE quoted_live")


def test_a_failing_definition_leaves_the_live_table(spark, vault, name, sample, monkeypatch):
    vault.clone(sample, name)
    spark.sql("CREATE TABLE still_live AS SELECT 7 AS id")

    def fail(*_):
        raise ValueError("cannot define")

    monkeypatch.setattr(vault, "_define", fail)
    with pytest.raises(ValueError, match="cannot define"):
        vault.restore_table(name, "still_live", overwrite=True)
    assert spark.table("still_live").collect()[0].id == 7
    spark.sql("DROP TABLE still_live")


def test_register_replaces_nothing_but_its_own(spark, vault, name, sample):
    vault.clone(sample, name)
    spark.sql("CREATE TABLE managed_live AS SELECT id FROM range(100)")
    with pytest.raises(ValueError, match="no registered version"):
        vault.register(name, "managed_live")
    assert spark.table("managed_live").count() == 100
    vault.register(name, "own_view")
    vault.clone(sample.limit(1), name)
    vault.register(name, "own_view")
    assert spark.table("own_view").count() == 1
    spark.sql("DROP TABLE managed_live")
    spark.sql("DROP TABLE own_view")
