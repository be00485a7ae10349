import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from tablevault import created_time, describe, file_stats


@pytest.fixture
def table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS described")
    spark.sql("DROP TABLE IF EXISTS described.t")
    spark.sql(
        "CREATE TABLE described.t (provider DECIMAL(10,2) COMMENT 'c', day STRING) USING parquet "
        "PARTITIONED BY (day) TBLPROPERTIES ('day' = 'x')"
    )
    return "described.t"


def test_repeated_names_are_kept_apart(spark, table):
    rows = {(r.section, r.key): r.value for r in describe(spark, table).collect()}
    assert rows["column", "provider"] == "decimal(10,2)"
    assert rows["column", "day"] == "string"
    assert rows["comment", "provider"] == "c"
    assert rows["partition", "0"] == "day"
    assert rows["property", "day"] == "x"
    assert rows["detail", "provider"].lower() == "parquet"


def test_missing_table(spark):
    with pytest.raises(AnalysisException):
        describe(spark, "described_absent.t")
    assert describe(spark, "described_absent.t", on_error="empty").count() == 0


def test_created_time(spark, table):
    made = created_time(spark, table)
    assert abs(dt.datetime.now(dt.timezone.utc) - made) < dt.timedelta(minutes=10)


def test_file_stats(spark, sample, tmp_path):
    path = tmp_path / "data"
    sample.repartition(2).write.partitionBy("name").parquet(str(path))
    (path / "notes.txt").write_text("not data")
    row = file_stats(spark, str(path)).first()
    files = list(Path(path).rglob("*.parquet"))
    assert row.file_count == len(files)
    assert row.total_size_bytes == sum(f.stat().st_size for f in files)
    assert row.partition_count == 3
    assert row.last_modified is not None
