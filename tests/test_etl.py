import pytest

from tablevault import read_files, run_etl


def test_positive_ids_are_written(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,value\n1,test1\n0,zero\n-4,minus\n,none\n3,test3\n")
    out = str(tmp_path / "out")
    result = run_etl(spark, str(tmp_path / "in.csv"), out)
    assert (result.rows_read, result.rows_written) == (5, 2)
    rows = read_files(spark, out, "csv").collect()
    assert sorted((r.id, r.value) for r in rows) == [(1, "test1"), (3, "test3")]


def test_ids_that_are_no_number_drop(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,value\n1,a\nx,b\n")
    result = run_etl(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    assert (result.rows_read, result.rows_written) == (2, 1)


def test_with_a_schema_and_another_format(spark, tmp_path, sample):
    sample.write.parquet(str(tmp_path / "in"))
    result = run_etl(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), fmt="parquet", schema=sample.schema
    )
    assert (result.rows_read, result.rows_written) == (3, 3)


def test_nothing_to_write(spark, tmp_path, sample):
    sample.limit(0).write.parquet(str(tmp_path / "in"))
    result = run_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), fmt="parquet")
    assert (result.rows_read, result.rows_written) == (0, 0)


def test_unreadable_source_ends_quietly(spark, tmp_path):
    assert run_etl(spark, str(tmp_path / "absent"), str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def test_other_failures_are_raised(spark, tmp_path):
    (tmp_path / "in.csv").write_text("key,value\n1,a\n")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        run_etl(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))


def test_writing_over_the_source_is_refused(spark, tmp_path, sample):
    path = str(tmp_path / "data")
    sample.write.parquet(path)
    with pytest.raises(ValueError, match="refusing"):
        run_etl(spark, path, path, fmt="parquet")
    assert spark.read.parquet(path).count() == 3


def test_line_ends_of_other_systems(spark, tmp_path):
    (tmp_path / "in.csv").write_bytes(b"name,id\r\na,1\r\nb,0\r\nc,3\r\n")
    for schema in (None, "name string, id int"):
        out = str(tmp_path / f"out-{schema is None}")
        result = run_etl(spark, str(tmp_path / "in.csv"), out, schema=schema)
        assert (result.rows_read, result.rows_written, result.rows_malformed) == (3, 2, 0)
        rows = read_files(spark, out, "csv", "name string, id int").collect()
        assert sorted((r.name, r.id) for r in rows) == [("a", 1), ("c", 3)]


def test_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "in.csv").write_text("value,id\n7,-1\n")
    with pytest.raises(Exception, match="(?i)header"):
        run_etl(
            spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), schema="id int, value int"
        )


def test_escapes_of_other_writers(spark, tmp_path):
    text = 'say "hi", ok\nand \\ more'
    rows = spark.createDataFrame([(1, text), (2, None)], "id int, text string")
    rows.write.option("header", "true").csv(str(tmp_path / "in"))
    run_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema=rows.schema)
    got = read_files(spark, str(tmp_path / "out"), "csv", rows.schema).collect()
    assert sorted((r.id, r.text) for r in got) == [(1, text), (2, None)]


def test_malformed_rows_are_counted(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,value\n1,5\n2x,6\n0,7\n3,y\n")
    result = run_etl(
        spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), schema="id int, value int"
    )
    assert (result.rows_read, result.rows_written, result.rows_malformed) == (4, 2, 2)
    result = run_etl(spark, str(tmp_path / "in.csv"), str(tmp_path / "text"))
    assert (result.rows_read, result.rows_written, result.rows_malformed) == (4, 2, 1)


DOUBLED = 'id,text\n1,"say ""hi"", ok"\n2,"x, ""y"" z"\n0,gone\n3,"two\nlines"\n'


def test_doubled_quotes_lose_nothing(spark, tmp_path):
    (tmp_path / "in.csv").write_text(DOUBLED)
    for schema in (None, "id int, text string"):
        out = str(tmp_path / f"out-{schema is None}")
        result = run_etl(spark, str(tmp_path / "in.csv"), out, schema=schema)
        assert (result.rows_read, result.rows_written, result.rows_malformed) == (4, 3, 0)
        assert result.dialect == "rfc4180"
        rows = read_files(spark, out, "csv", "id int, text string").collect()
        assert sorted(map(tuple, rows)) == [
            (1, 'say "hi", ok'), (2, 'x, "y" z'), (3, "two\nlines"),
        ]


@pytest.mark.parametrize("schema", [None, "id int, text string"])
def test_a_wrong_dialect_does_not_go_unseen(spark, tmp_path, schema):
    (tmp_path / "in.csv").write_text('id,text\n1,"say ""hi"", ok"\n')
    result = run_etl(
        spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), schema=schema, dialect="foreign"
    )
    assert result.rows_malformed == 1


def test_header_in_another_order_by_name(spark, tmp_path):
    (tmp_path / "in.csv").write_text("value,note,id\n7,x,1\n8,y,-1\n")
    out = str(tmp_path / "out")
    result = run_etl(
        spark, str(tmp_path / "in.csv"), out, schema="id int, value int", by_name=True
    )
    assert (result.rows_read, result.rows_written, result.rows_malformed) == (2, 1, 0)
    assert read_files(spark, out, "csv", "id int, value int").collect() == [(1, 7)]


def test_rejected_records_are_kept_whole(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text\n1,a\n2,b,"more ""of"" it"\n-3,c,d\n4\n5,e\n')
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    result = run_etl(
        spark, str(tmp_path / "in.csv"), out, schema="id int, text string", rejects=bad
    )
    assert (result.rows_read, result.rows_written, result.rows_malformed) == (5, 2, 3)
    assert sorted(r.id for r in read_files(spark, out, "csv", "id int, text string").collect()) == [1, 5]
    found = spark.read.parquet(bad).collect()
    assert sorted(r.record.strip() for r in found) == ['-3,c,d', '2,b,"more ""of"" it"', "4"]
    assert all(r.file.endswith("in.csv") for r in found)
    with pytest.raises(ValueError, match="only records of CSV"):
        run_etl(spark, out, bad, fmt="parquet", rejects=bad)
