"""The recorded proof of a snapshot: what was damaged is named, and not restored."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablevault import run_backup
from tablevault.operators import manifest as proof


def files(path):
    return sorted(p for p in Path(path).rglob("*.parquet"))


@pytest.fixture
def snapshot(spark, vault, name):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("seven")).repartition(4, "id")
    return vault.clone(rows, name)


def damage(vault, name, **kwargs):
    return {r.file: r.problem for r in vault.damage(name, **kwargs).collect()}


def test_an_untouched_snapshot_has_no_damage(spark, vault, name, snapshot):
    assert damage(vault, name) == {}
    lines = spark.read.parquet(snapshot.manifest_path).collect()
    assert {r.file: r.bytes for r in lines} == {
        p.name: p.stat().st_size for p in files(snapshot.path)
    }
    assert sum(r.row_count for r in lines) == 1000 == snapshot.manifest["rows"]
    assert int(snapshot.manifest["checksum"]) == snapshot.fingerprint[1]


def test_every_kind_of_damage_is_named(spark, vault, name, snapshot, tmp_path):
    lost, swapped, other, cut = files(snapshot.path)
    lost.unlink()
    first, second = swapped.read_bytes(), other.read_bytes()
    swapped.write_bytes(second)
    other.write_bytes(first)
    cut.write_bytes(cut.read_bytes()[:-40])
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "other"))
    added = files(tmp_path / "other")[0]
    (Path(snapshot.path) / "more.parquet").write_bytes(added.read_bytes())
    assert damage(vault, name) == {
        lost.name: proof.MISSING, swapped.name: proof.CHANGED, other.name: proof.CHANGED,
        cut.name: proof.CHANGED, "more.parquet": proof.EXTRA,
    }
    target = tmp_path / "target"
    with pytest.raises(RuntimeError, match=f"damaged.*missing {lost.name}"):
        vault.restore(name, str(target))
    assert not target.exists() and not list(tmp_path.glob("target*"))


def test_a_file_of_the_same_rows_and_size_count_is_named(spark, vault, name, snapshot, tmp_path):
    """What a count of rows does not see."""
    one = files(snapshot.path)[0]
    rows = spark.read.parquet(str(one)).withColumn("seven", F.col("seven") + 1)
    rows.coalesce(1).write.parquet(str(tmp_path / "altered"))
    one.write_bytes(files(tmp_path / "altered")[0].read_bytes())
    assert damage(vault, name) == {one.name: proof.CHANGED}
    with pytest.raises(RuntimeError, match=f"changed {one.name}"):
        vault.restore_table(name, "manifest_target")
    assert not spark.catalog.tableExists("manifest_target")


def test_sizes_alone(vault, name, snapshot):
    lost, cut, *_ = files(snapshot.path)
    lost.unlink()
    cut.write_bytes(cut.read_bytes() + b" ")
    assert damage(vault, name, content=False) == {
        lost.name: proof.MISSING, cut.name: proof.RESIZED,
    }


def test_a_snapshot_that_is_gone(vault, name, snapshot, tmp_path):
    names = {p.name for p in files(snapshot.path)}
    Path(snapshot.path).rename(tmp_path / "away")
    assert damage(vault, name) == dict.fromkeys(names, proof.MISSING)
    with pytest.raises(RuntimeError, match="damaged"):
        vault.restore(name, str(tmp_path / "target"))


def test_a_changed_manifest_is_refused(spark, vault, name, snapshot):
    lines = spark.read.parquet(snapshot.manifest_path).limit(3).collect()
    spark.createDataFrame(lines, proof.MANIFEST).write.mode("overwrite").parquet(
        snapshot.manifest_path
    )
    with pytest.raises(RuntimeError, match="manifest is not the one"):
        vault.damage(name)


def test_partitions_and_odd_names(spark, vault, tmp_path):
    from tablevault import TableName

    name = TableName("a b", "ü/x", "100%")
    rows = spark.sql("SELECT * FROM VALUES ('x y', 1), ('50%', 2), ('ä=b', 3), (NULL, 4) AS t(p, id)")
    snapshot = vault.clone(rows, name, partition_by=["p"])
    assert damage(vault, name) == {} and snapshot.manifest["files"] == 4
    vault.restore(name, str(tmp_path / "back"))
    moved = files(snapshot.path)[0]
    moved.rename(moved.with_name("renamed.parquet"))
    assert sorted(damage(vault, name).values()) == [proof.EXTRA, proof.MISSING]


def test_files_without_rows(spark, vault, name):
    snapshot = vault.clone(spark.range(0), name)
    assert snapshot.manifest["rows"] == 0 and damage(vault, name) == {}


@pytest.mark.parametrize("method", ["exact", "fingerprint", "sample"])
def test_every_method_records_the_proof(spark, vault, name, tmp_path, method):
    plan = spark.sql(
        """SELECT 0L ordinal, 'shop' catalog, 'sales' schema, 'orders' `table`, 1 priority,
        'daily' backup_frequency, true verify_enabled, true row_count_check,
        true data_sample_check, 10 sample_size, true fail_fast, 'backup' backup_catalog,
        'dr' backup_schema, false use_external_location, string(NULL) storage_type,
        string(NULL) account, string(NULL) container_name, string(NULL) path_prefix"""
    )
    run_backup(vault, plan, source=lambda _: spark.range(100).repartition(2), method=method)
    found = vault.snapshot(name)
    one, two = files(found.path)
    first, second = one.read_bytes(), two.read_bytes()
    one.write_bytes(second)
    two.write_bytes(first)
    assert set(damage(vault, name).values()) == {proof.CHANGED}
    with pytest.raises(RuntimeError, match="damaged"):
        vault.restore(name, str(tmp_path / "target"))


def test_versions_without_a_manifest_are_compared(spark, vault, name, tmp_path):
    copy = vault.copy(spark.range(10), name, with_fingerprint=False)
    vault.publish(copy)
    vault.restore(name, str(tmp_path / "back"))
    assert spark.read.parquet(str(tmp_path / "back")).count() == 10
    with pytest.raises(LookupError, match="no manifest"):
        vault.damage(name)


def test_manifests_go_with_their_version(vault, name, snapshot):
    vault.drop_versions(vault.versions())
    assert not Path(snapshot.manifest_path).exists()


def test_restore_shuffles_no_rows(spark, vault, name, snapshot, tmp_path):
    """The proof is a row per file and task, never the table."""
    lines = spark.read.parquet(snapshot.manifest_path)
    frame = proof.damage(lines, snapshot.read_what_can_be(spark), snapshot.path)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "seven" not in plan.split("Exchange")[0]
    assert "partial_sum" in plan or "partial_count" in plan
