import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablevault import positive_ids, row_count, sample_rows
from tablevault.operators.diff import fingerprint
from tablevault.operators.rows import numbered, spread_sample


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_only_positive_ids_stay(spark):
    df = spark.createDataFrame([(1,), (2,), (0,), (-5,), (None,)], "id bigint")
    assert ids(positive_ids(df)) == [1, 2]


def test_text_ids_that_are_no_number_drop(spark):
    df = spark.createDataFrame(
        [("1",), ("x",), ("99999999999",), ("0",), ("-3",), (None,), (" 7 ",), ("",)], "id string"
    )
    assert ids(positive_ids(df)) == [" 7 ", "1", "99999999999"]


def test_another_id_column(spark):
    df = spark.createDataFrame([(1, -1), (-1, 1)], "`my.id` int, id int")
    assert positive_ids(df, "my.id").collect() == [(1, -1)]


def test_missing_id_column_is_an_error(spark):
    with pytest.raises(AnalysisException) as error:
        positive_ids(spark.range(3).toDF("key"))
    assert error.value.getCondition().startswith("UNRESOLVED_COLUMN")


def test_row_count(spark, sample):
    assert row_count(sample, "t").collect() == [("t", 3)]
    assert row_count(sample.limit(0), "t").collect() == [("t", 0)]


def test_sample_does_not_depend_on_layout(spark, orders):
    one = sample_rows(orders, 100).collect()
    other = sample_rows(orders.repartition(7, "o_totalprice"), 100).collect()
    assert one == other
    assert len(one) == 100


def test_sample_of_complex_rows(spark):
    a = spark.sql("SELECT map('b', 1, 'a', 2) m, named_struct('x', map(1, 2)) s, array(NULL, 1) l")
    b = spark.sql("SELECT map('a', 2, 'b', 1) m, named_struct('x', map(1, 2)) s, array(NULL, 1) l")
    assert sample_rows(a.union(a), 1).collect() == sample_rows(b, 1).collect()


def test_sample_takes_all_of_a_small_table(sample):
    assert sample_rows(sample, 1000).count() == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_numbering_agrees_with_a_global_sort(spark, seed):
    rng = random.Random(seed)
    rows = [
        # A third of all rows share one level.
        (7 if rng.random() < 0.34 else rng.randint(-3, 9), rng.randint(-50, 400), str(i))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "priority int, ordinal bigint, name string").repartition(5)
    got = numbered(df, "rank", "priority", "ordinal", ties=["name"])
    whole = Window.orderBy(F.desc("priority"), "ordinal", "name")
    want = df.withColumn("rank", F.row_number().over(whole).cast("bigint"))
    assert sorted(got.select("name", "rank").collect()) == sorted(
        want.select("name", "rank").collect()
    )


def test_numbering_refuses_a_missing_level(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "priority int, ordinal bigint")
    with pytest.raises(Exception, match="priority must not be NULL"):
        numbered(df, "rank", "priority", "ordinal").collect()


def test_spread_sample_does_not_depend_on_layout(spark, orders):
    one = spread_sample(orders, 100).collect()
    assert one == spread_sample(orders.repartition(7, "o_totalprice"), 100).collect()
    assert len(one) == 100
    assert spark.createDataFrame(one, orders.schema).exceptAll(orders).count() == 0


def test_spread_sample_is_spread(spark):
    rows = spark.range(100_000).select("id", F.lit("x").alias("x"))
    tenths = spread_sample(rows, 1000).groupBy((F.col("id") / 10_000).cast("int")).count().collect()
    assert len(tenths) == 10 and all(60 < r["count"] < 150 for r in tenths)


def test_spread_sample_of_copies_and_small_tables(spark, sample):
    same = spark.range(5000).select(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    assert spread_sample(same, 10).collect() == [(1, None)] * 10
    assert spread_sample(sample, 1000).count() == 3
    assert spread_sample(sample.limit(0), 5).collect() == []
    maps = spark.sql("SELECT map('b', 1, 'a', 2) m UNION ALL SELECT map('a', 2, 'b', 1)")
    assert spread_sample(maps, 1).count() == 1


def test_spread_sample_merges_hashes_and_not_rows(spark, orders):
    plan = spread_sample(orders, 100)._jdf.queryExecution().executedPlan().toString()
    merges = [line for line in plan.splitlines() if "TakeOrderedAndProject" in line]
    hashes = [line for line in merges if "orderBy=[hash#" in line]
    assert "Subquery" in plan and 0 < len(hashes) < len(merges)
    assert not any("o_orderstatus" in line for line in hashes)


def test_equal_rows_have_equal_fingerprints_and_nulls_count(spark):
    def seen(sql):
        return tuple(fingerprint(spark.sql(sql)).first())

    wide = ", ".join(f"{'NULL' if i == 64 else i} AS c{i}" for i in range(70))
    moved = ", ".join(f"{'NULL' if i == 65 else i} AS c{i}" for i in range(70))
    assert seen(f"SELECT {wide}") == seen(f"SELECT {wide}") != seen(f"SELECT {moved}")
    assert seen("SELECT int(NULL) a, 1 b") != seen("SELECT 1 a, int(NULL) b")


@pytest.mark.parametrize("level", ["id", "0L", "id % 3", "pmod(id, 2) * 1000000007"])
@pytest.mark.parametrize("ordinal", ["id", "id * 1000003", "0L"])
def test_numbering_of_any_shape(spark, level, ordinal):
    """Distinct levels, one level, sparse ordinals, and no ordinal at all."""
    df = spark.range(3000).selectExpr("id", f"{level} AS level", f"{ordinal} AS ordinal").repartition(6)
    got = numbered(df, "rank", "level", "ordinal", ties=["id"]).collect()
    rows = sorted(df.collect(), key=lambda r: (-r.level, r.ordinal, r.id))
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == [r.id for r in rows]
    assert sorted(r["rank"] for r in got) == list(range(1, 3001))


def test_numbering_sums_counts_of_ranges_alone(spark):
    df = spark.range(10_000).selectExpr("id AS level", "id AS ordinal")
    plan = numbered(df, "rank", "level", "ordinal")._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Exchange SinglePartition")[1:]
    assert single and all("HashAggregate" in below.splitlines()[1] for below in single)
    assert numbered(df.limit(0), "rank", "level", "ordinal").collect() == []
