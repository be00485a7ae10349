import csv
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablevault import diff_rows, object_store_path, read_files, read_or_none, write_files
from tablevault.sources import filesystem
from tablevault.sources.files import csv_dialect

AWKWARD = [
    "", None, " lead", "trail ", "\ttab", "a\nb", "a\r\nb", "a\rb", 'q"q', '""', '"', "\\",
    '\\"', "a,b", "#c", "é x", "'", "\n", "\r", " ", "NULL", '"a"b","c', "007",
    '"\0', '\0"', "\0",
]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_every_format_brings_rows_back_exactly(spark, tmp_path, fmt):
    moment = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    df = spark.createDataFrame(
        [(i, text, moment, 1.5, True, dt.date(2024, 2, 29)) for i, text in enumerate(AWKWARD)],
        "id bigint, `the text` string, t timestamp_ntz, d double, f boolean, day date",
    ).withColumn("tz", F.col("t").cast("timestamp")).withColumn(
        "dec", F.lit("1.50").cast("decimal(10,2)")
    )
    path = str(tmp_path / "data")
    write_files(df, path, fmt)
    back = read_files(spark, path, fmt, df.schema)
    assert back.count() == len(AWKWARD)
    assert diff_rows(df, back).count() == 0


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.one_of(st.none(), st.text(st.characters(codec="utf-8"), max_size=12)), max_size=30
    ).filter(lambda texts: "\\N" not in texts)
)
def test_csv_keeps_any_text(spark, tmp_path_factory, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    path = str(tmp_path_factory.mktemp("csv") / "data")
    write_files(df, path, "csv")
    back = read_files(spark, path, "csv", df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_refuses_a_text_that_means_null(spark, tmp_path):
    df = spark.createDataFrame([("\\N",)], "text string")
    with pytest.raises(Exception, match="stands for NULL"):
        write_files(df, str(tmp_path / "a"), "csv")
    write_files(df, str(tmp_path / "b"), "csv", csv_null="<null>")
    back = read_files(spark, str(tmp_path / "b"), "csv", df.schema, csv_null="<null>")
    assert back.first()[0] == "\\N"


def test_csv_from_other_writers(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,name\n1,\n2,x\n")
    path = str(tmp_path / "in.csv")
    assert read_files(spark, path, "csv", csv_null="").collect() == [(1, None), (2, "x")]
    split = read_files(spark, path, "csv", csv_null="", multi_line=False)
    assert split.collect() == [(1, None), (2, "x")]


def test_schema_is_inferred_unless_given(spark, tmp_path, sample):
    path = str(tmp_path / "data")
    write_files(sample.selectExpr("concat('00', id) AS code"), path, "csv")
    assert read_files(spark, path, "csv").schema["code"].dataType.simpleString() == "int"
    given = read_files(spark, path, "csv", "code string")
    assert {r.code for r in given.collect()} == {"001", "002", "003"}


def test_write_replaces_and_reads_back(spark, tmp_path, sample):
    path = str(tmp_path / "data")
    write_files(sample, path)
    write_files(sample.filter("id = 1"), path)
    assert [tuple(r) for r in read_files(spark, path).collect()] == [(1, "test1", 100)]


def test_write_partitioned(spark, tmp_path, sample):
    path = str(tmp_path / "data")
    write_files(sample, path, partition_by=["name"])
    assert (tmp_path / "data" / "name=test1").is_dir()
    assert read_files(spark, path).count() == 3


def test_unreadable_raises_or_gives_none(spark, tmp_path):
    missing = str(tmp_path / "missing")
    with pytest.raises(AnalysisException):
        read_files(spark, missing)
    assert read_or_none(spark, missing) is None
    assert read_or_none(spark, missing, "no-such-format") is None


def test_overwriting_its_own_source_is_refused(spark, tmp_path, sample):
    path = str(tmp_path / "my data")
    write_files(sample, path)
    for target in (path, str(tmp_path)):
        with pytest.raises(ValueError, match="refusing to overwrite"):
            write_files(read_files(spark, path).filter("id > 1"), target)
    assert read_files(spark, path).count() == 3


def test_a_neighbour_with_a_longer_name_is_no_overlap(spark, tmp_path, sample):
    write_files(sample, str(tmp_path / "data2"))
    write_files(sample, str(tmp_path / "data"))
    write_files(read_files(spark, str(tmp_path / "data2")), str(tmp_path / "data"))
    assert read_files(spark, str(tmp_path / "data")).count() == 3


def test_object_store_path():
    assert (
        object_store_path("box", "acct", "in/source_table")
        == "abfss://box@acct.dfs.core.windows.net/in/source_table"
    )


def test_filesystem(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    filesystem.make_directory(spark, a)
    filesystem.rename(spark, a, b)
    assert not filesystem.exists(spark, a)
    assert filesystem.delete(spark, b)
    assert not filesystem.delete(spark, b)
    with pytest.raises(Exception):
        filesystem.rename(spark, a, b)


RFC = 'id,text\n1,"say ""hi"", ok"\n2,"x, ""y"" z"\n3,"""all"""\n4,\n5,""\n6,"two\nlines"\n7,C:\\dir\\\n'
RFC_ROWS = [
    (1, 'say "hi", ok'), (2, 'x, "y" z'), (3, '"all"'), (4, None), (5, None), (6, "two\nlines"),
    (7, "C:\\dir\\"),
]
BACKSLASHED = 'id,text\n1,"say \\"hi\\", ok"\n2,"\\"all\\" of it"\n3,""\n4,\n'


def test_doubled_quotes_keep_every_character(spark, tmp_path):
    (tmp_path / "in.csv").write_text(RFC)
    path = str(tmp_path / "in.csv")
    for dialect in ("rfc4180", "detect"):
        rows = read_files(spark, path, "csv", "id int, text string", dialect=dialect)
        assert sorted(map(tuple, rows.collect())) == RFC_ROWS
    with pytest.raises(ValueError, match="unknown CSV dialect"):
        read_files(spark, path, "csv", dialect="other")


def test_the_dialect_is_told_by_its_quotes(spark, tmp_path):
    def told(text):
        (tmp_path / "in.csv").write_text(text)
        return csv_dialect(spark, str(tmp_path / "in.csv"))

    assert told(RFC) == "rfc4180"
    assert told(BACKSLASHED) == "foreign"
    assert told("id,text\n1,plain\n2,\"\"\n") == "foreign"
    assert told('id,text\n1,"a ""path\\"\n2,"C:\\"\n') == "rfc4180"
    assert told("") == "foreign"
    with pytest.raises(ValueError, match="name its dialect"):
        told(RFC + BACKSLASHED)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.text(st.sampled_from('a",\\\n é'), min_size=1, max_size=12), min_size=1, max_size=30
    )
)
def test_csv_of_python_comes_back(spark, tmp_path_factory, texts):
    path = tmp_path_factory.mktemp("python") / "in.csv"
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerows([("text", "id"), *[(t, i) for i, t in enumerate(texts)]])
    rows = read_files(
        spark, str(path), "csv", "id int, text string", dialect="rfc4180", by_name=True,
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    assert [r.text for r in sorted(rows.collect())] == texts


def test_columns_by_header(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Value,more,ID\n7,x,1\n8,y,2\n")
    path = str(tmp_path / "in.csv")
    rows = read_files(spark, path, "csv", "id bigint, value int", dialect="rfc4180", by_name=True)
    assert rows.dtypes == [("id", "bigint"), ("value", "int")]
    assert sorted(map(tuple, rows.collect())) == [(1, 7), (2, 8)]
    with pytest.raises(ValueError, match="lacks other"):
        read_files(spark, path, "csv", "id int, other int", by_name=True)
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "a.csv").write_text("value,id\n7,1\n")
    (tmp_path / "many" / "b.csv").write_text("id,value\n2,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_files(spark, str(tmp_path / "many"), "csv", "id int, value int", by_name=True).collect()


def test_rescued_records(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text\n1,fine\n2,a,b\n3\nx,bad id\n4,"two\nlines",more\n')
    path = str(tmp_path / "in.csv")
    rows = read_files(
        spark, path, "csv", "id int, text string", dialect="rfc4180", rescue="record"
    )
    found = {r.record.strip() for r in rows.where("record IS NOT NULL").collect()}
    assert found == {"2,a,b", "3", "x,bad id", '4,"two\nlines",more'}
    assert rows.select("id").where("id = 1").count() == 1
    inferred = read_files(spark, path, "csv", dialect="rfc4180", rescue="record")
    assert inferred.columns == ["id", "text", "record"]
    assert inferred.where("record IS NOT NULL").count() == 3  # ids are text here


def test_files_without_text_are_split(spark, tmp_path):
    numbers = spark.range(40_000).select("id", (F.col("id") * 2).alias("twice"))
    write_files(numbers.coalesce(1), str(tmp_path / "n"), "csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = read_files(spark, str(tmp_path / "n"), "csv", numbers.schema)
        assert rows.rdd.getNumPartitions() > 3
        assert rows.agg(F.sum("twice")).first()[0] == 2 * sum(range(40_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture
def no_names(monkeypatch, spark):
    """Fail where the names of files are asked for."""
    def fail(*_):
        raise AssertionError("the names of files came to the driver")

    return lambda: monkeypatch.setattr(filesystem, "_names", fail)


def test_overlap_is_told_without_the_names_of_files(spark, tmp_path, no_names):
    source, other = str(tmp_path / "a b" / "many"), str(tmp_path / "other")
    spark.range(3000).repartition(300).write.parquet(source)
    rows = spark.read.parquet(source).where("id > 1").join(spark.range(9), "id")
    no_names()
    assert filesystem.reads_under(rows, source) and filesystem.reads_under(rows, str(tmp_path))
    assert filesystem.reads_under(rows, source + "/")
    assert not filesystem.reads_under(rows, other)
    assert not filesystem.reads_under(rows, source + "x")
    write_files(rows, other)
    with pytest.raises(AssertionError, match="names of files"):
        filesystem.reads_under(rows, f"{source}/part")


def test_overlap_inside_of_what_is_read(spark, tmp_path):
    path = tmp_path / "table"
    spark.range(20).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(str(path))
    rows = spark.read.parquet(str(path))
    assert filesystem.reads_under(rows, str(path / "p=1"))
    assert not filesystem.reads_under(rows, str(path / "p=7"))
    assert filesystem.reads_under(spark.read.parquet(str(path / "p=1")), str(path))
    spark.range(3).createOrReplaceTempView("memory_alone")
    assert not filesystem.reads_under(spark.table("memory_alone"), str(path))
    cached = rows.cache()
    assert filesystem.reads_under(cached.where("id > 1"), str(path))
    cached.unpersist()
