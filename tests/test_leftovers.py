"""What killed or replaced work leaves behind, and tables that are never without data."""

import datetime as dt
import threading
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tablevault import Checks, TableName, Vault, cleanup, describe
from tablevault.plans import audit as log

LATER = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)


def found(vault, **kwargs):
    return {(r.kind, Path(r.path).name) for r in vault.leftovers(as_of=LATER, **kwargs).collect()}


def test_nothing_is_left_of_good_work(vault, sample, name, tmp_path):
    vault.clone(sample, name)
    vault.clone(sample, TableName("a b", "ü", "100%"), partition_by=["name"])
    vault.restore(name, str(tmp_path / "back"))
    assert found(vault) == set()
    vault.drop_versions(vault.versions())
    assert found(vault) == set()


def test_copies_that_no_row_names(spark, vault, sample, name, tmp_path):
    vault.clone(sample, name)
    vault.copy(sample, name)  # ended before it was published
    failed = vault.copy(sample, TableName("shop", "sales", "failed"))
    vault.publish(failed, status=log.FAILED)
    killed = Path(vault.root) / "shop" / "sales" / "never" / "v=1" / "_temporary" / "0"
    killed.mkdir(parents=True)
    outside = str(tmp_path / "outside" / "orders")
    other = TableName("shop", "sales", "far")
    vault.clone(sample, other, location=outside)
    vault.copy(sample, other, location=outside)
    assert found(vault) == {("copy", "v=2"), ("manifest", "v=2"), ("copy", "v=1")}
    assert vault.leftovers(as_of=LATER).count() == 5
    assert vault.leftovers(24).count() == 0  # too young
    plan = spark.createDataFrame([("daily",)], "backup_frequency string").select(
        "*", *[F.lit(v).alias(k) for k, v in name.key.items()], F.lit(10**6).alias("retention_days")
    )
    cleanup(vault, plan, leftovers_after=24)
    assert vault.leftovers(as_of=LATER).count() == 5
    assert vault.remove_leftovers(as_of=LATER) == 5
    assert vault.read(name).count() == 3 and vault.read(other).count() == 3
    assert Path(failed.path).exists()  # failed copies expire by their log rows
    assert found(vault) == set()


def test_restores_that_were_killed(vault, sample, name, tmp_path):
    target = tmp_path / "live"
    vault.clone(sample, name)
    vault.restore(name, str(target))
    for label in ("restored", "replaced"):
        (tmp_path / f"live.{label}-0123").mkdir()
    (tmp_path / "live.related-0").mkdir()
    assert found(vault) == {("restore", "live.restored-0123"), ("restore", "live.replaced-0123")}
    # Without a target, what was moved aside may be the only data.
    target.rename(tmp_path / "away")
    assert found(vault) == set()


def test_a_root_with_special_characters(spark, sample, name, tmp_path):
    vault = Vault(spark, str(tmp_path / "a b, ü & 100%"))
    vault.clone(sample, name)
    vault.copy(sample, name)
    assert found(vault) == {("copy", "v=2"), ("manifest", "v=2")}


@pytest.fixture
def live(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS live")
    table = f"live.steady_{uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (id INT COMMENT 'the id', name STRING, value INT) USING parquet "
        "COMMENT 'as it was' TBLPROPERTIES ('team' = 'a')"
    )
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_live_table_can_be_read_throughout_a_restore(spark, vault, sample, name, live):
    sample.write.insertInto(live)
    vault.clone(live, name)
    before = vault._location_of(live)
    spark.sql(f"INSERT INTO {live} VALUES (9, 'late', 9)")
    spark.sql(f"ALTER TABLE {live} SET TBLPROPERTIES ('team' = 'b', 'more' = 'x')")
    spark.sql(f"COMMENT ON TABLE {live} IS 'changed'")
    spark.sql(f"ALTER TABLE {live} ALTER COLUMN name COMMENT 'new note'")
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(live).count())
            except Exception as error:
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        vault.restore_table(name, live, overwrite=True)
    finally:
        stop.set()
        reader.join()
    assert set(seen) <= {3, 4} and len(seen) > 1
    assert spark.table(live).count() == 3 and vault._location_of(live) != before
    rows = {(r.section, r.key): r.value for r in describe(spark, live).collect()}
    assert rows["detail", "comment"] == "as it was" and rows["comment", "id"] == "the id"
    assert rows["property", "team"] == "a" and ("property", "more") not in rows
    assert ("comment", "name") not in rows
    assert found(vault) == {("replaced", live.removeprefix("live."))}
    assert vault.remove_leftovers(as_of=LATER) == 1
    assert spark.table(live).count() == 3


def test_replaced_data_that_is_live_again_is_kept(spark, vault, sample, name, live):
    sample.write.insertInto(live)
    vault.clone(live, name)
    before = vault._location_of(live)
    vault.restore_table(name, live, overwrite=True, checks=Checks())
    spark.sql(f"ALTER TABLE {live} SET LOCATION '{before}'")
    assert found(vault) == set()
