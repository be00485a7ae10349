from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablevault import (
    Checks,
    diff_rows,
    diff_rows_in_suspect_buckets,
    fingerprint,
    sample_diff,
    verify,
    verify_clone,
)
from tablevault.operators.diff import same_schema
from tablevault.operators.diff import diff_counts, same_schema

ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from(["", "a"]))
    ),
    max_size=25,
)
SETTINGS = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string").repartition(3)


def as_counter(diff, side):
    return Counter(
        {(r.k, r.v): r._copies for r in diff.collect() if r._side == side}
    )


@SETTINGS
@given(ROWS, ROWS)
def test_diff_agrees_with_counting(spark, a, b):
    left, right = frame(spark, a), frame(spark, b)
    missing, extra = Counter(a) - Counter(b), Counter(b) - Counter(a)
    for diff in (diff_rows(left, right), diff_rows_in_suspect_buckets(left, right, 16)):
        assert as_counter(diff, "missing") == missing
        assert as_counter(diff, "extra") == extra
    counts = diff_counts(left, right).first()
    assert counts == (len(a), len(b), missing.total(), extra.total())
    same = fingerprint(left).first() == fingerprint(right).first()
    assert same == (Counter(a) == Counter(b))


NULL_SHIFTS = [
    ("SELECT string(NULL) a, 'x' b", "SELECT 'x' a, string(NULL) b"),
    ("SELECT array('x', NULL) a", "SELECT array(NULL, 'x') a"),
    ("SELECT array(array('x'), array()) a", "SELECT array(array(), array('x')) a"),
    ("SELECT array(CAST(NULL AS string)) a", "SELECT CAST(array() AS array<string>) a"),
    ("SELECT named_struct('p', string(NULL), 'q', 'x') a",
     "SELECT named_struct('p', 'x', 'q', string(NULL)) a"),
    ("SELECT map('k', string(NULL), 'l', 'x') a", "SELECT map('k', 'x', 'l', string(NULL)) a"),
    ("SELECT map('k', array('x', NULL)) a", "SELECT map('k', array(NULL, 'x')) a"),
    ("SELECT CAST(NULL AS map<string,string>) a", "SELECT CAST(map() AS map<string,string>) a"),
    ("SELECT CAST(NULL AS struct<p:int>) a", "SELECT named_struct('p', int(NULL)) a"),
]


@pytest.mark.parametrize(("a", "b"), NULL_SHIFTS)
def test_shifted_nulls_are_seen(spark, a, b):
    left, right = spark.sql(a), spark.sql(b)
    assert diff_rows(left, right).count() == 2
    assert fingerprint(left).first() != fingerprint(right).first()
    assert diff_rows_in_suspect_buckets(left, right).count() == 2
    assert sample_diff(left, right, 10).count() == 2
    assert diff_rows(left, left).count() == 0
    assert fingerprint(left).first() == fingerprint(spark.sql(a)).first()


def test_maps_are_equal_in_any_entry_order(spark):
    a = spark.sql("SELECT map('a', 1, 'b', 2) m, array(map(1, map('x', 1, 'y', 2))) n")
    b = spark.sql("SELECT map('b', 2, 'a', 1) m, array(map(1, map('y', 2, 'x', 1))) n")
    c = spark.sql("SELECT map('b', 1, 'a', 2) m, array(map(1, map('y', 2, 'x', 1))) n")
    assert diff_rows(a, b).count() == 0
    assert fingerprint(a).first() == fingerprint(b).first()
    assert sample_diff(a, b, 5).count() == 0
    assert diff_rows(a, c).count() == 2
    assert fingerprint(a).first() != fingerprint(c).first()
    assert diff_rows(a, c).schema["m"].dataType == a.schema["m"].dataType


def test_variants(spark):
    a = spark.sql("""SELECT parse_json('{"k": 1, "l": null}') v, array(parse_json('2')) n""")
    b = spark.sql("""SELECT parse_json('{"k": 2, "l": null}') v, array(parse_json('2')) n""")
    assert diff_rows(a, a).count() == 0
    assert diff_rows(a, b).count() == 2
    assert fingerprint(a).first() != fingerprint(b).first()
    assert sample_diff(a, b, 3).count() == 2


def test_odd_column_names(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 2 AS `c d`, 3 AS `e``f`")
    other = spark.sql("SELECT 1 AS `a.b`, 2 AS `c d`, 4 AS `e``f`")
    assert diff_rows(df, other).count() == 2
    assert diff_rows_in_suspect_buckets(df, other).count() == 2
    assert diff_rows(df, df).count() == 0


def test_different_schemas_are_not_compared(spark):
    a, b = spark.sql("SELECT 1 AS k"), spark.sql("SELECT bigint(1) AS k")
    assert not same_schema(a, b)
    assert not same_schema(spark.sql("SELECT 1 a, 2 b"), spark.sql("SELECT 2 b, 1 a"))
    for compare in (diff_rows, diff_rows_in_suspect_buckets):
        with pytest.raises(ValueError, match="differ in schema"):
            compare(a, b)


def test_a_row_that_is_a_third_of_the_table(spark):
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k")
    less = spark.range(30_000).filter("id <> 3").selectExpr("if(id % 3 = 0, 0, id) AS k")
    assert diff_rows(hot, less).collect() == [("missing", 1, 0)]
    assert diff_rows_in_suspect_buckets(hot, less).collect() == [("missing", 1, 0)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "k int")
    assert diff_counts(empty, empty).first() == (0, 0, 0, 0)
    assert fingerprint(empty).first() == (0, 0)
    assert diff_rows_in_suspect_buckets(empty, empty).count() == 0


def test_large_embedding_arrays(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert diff_rows(vectors, vectors.repartition(5)).count() == 0
    assert fingerprint(vectors).first() == fingerprint(vectors.repartition(5)).first()


def test_bucket_number_is_bounded(spark, sample):
    with pytest.raises(ValueError, match="buckets"):
        diff_rows_in_suspect_buckets(sample, sample, 1 << 30)


def test_spread_sample_sees_what_the_first_rows_hide(spark):
    a = spark.range(20_000).toDF("id")
    b = a.where("id < 10000")
    assert sample_diff(a, b, 100).count() == 0
    assert sample_diff(a, b, 100, "spread").count() > 0
    assert sample_diff(a, a.repartition(3), 100, "spread").count() == 0
    with pytest.raises(ValueError, match="unknown sample method"):
        sample_diff(a, b, 100, "other")


def test_collated_text_is_compared_byte_by_byte(spark):
    a = spark.sql(
        """SELECT collate('A', 'UTF8_LCASE') t, array(named_struct('x', collate('B', 'UNICODE_CI'))) n,
        map(collate('K', 'UTF8_LCASE'), 1) m"""
    )
    for other in ("'a' t", "array(named_struct('x', 'b')) n", "map('k', 1) m"):
        name = other.split()[-1]
        low = spark.sql(f"SELECT {other}").select(F.col(name).cast(a.schema[name].dataType))
        b = a.select(*[F.col(c) for c in a.columns if c != name]).crossJoin(low).select(a.columns)
        assert same_schema(a, b)
        assert diff_rows(a, b).count() == 2 and diff_rows(a, a.select("*")).count() == 0
        assert fingerprint(a).first() != fingerprint(b).first()
        assert not verify_clone(a, b)
        assert not verify_clone(a, b, Checks(full_diff=False))


def test_tables_with_columns_named_like_the_marks(spark):
    names = "_side string, _copies int, __weight int, __in_source int, __IN_target int"
    a = spark.createDataFrame([("missing", 7, 1, 2, 3), ("x", 1, 1, 1, 1)], names)
    b = a.where("_copies = 1")
    assert diff_rows(a, b).columns == ["__side", "__copies", *a.columns]
    assert tuple(diff_rows(a, b).first())[:3] == ("missing", 1, "missing")
    for checks in (Checks(), Checks(full_diff=False), Checks(full_diff=False, sample_method="spread")):
        assert verify_clone(a, a.select("*"), checks) and not verify_clone(a, b, checks)
        assert verify(a, b, checks).first().missing_rows == 1
    assert diff_rows_in_suspect_buckets(a, b).count() == 1
