from decimal import Decimal

from tablevault import profile, profile_diff


def rows(df):
    return {r.column_name: (r.row_count, r.non_null, r.total, r.average) for r in df.collect()}


def test_counts_sums_and_averages(spark):
    df = spark.createDataFrame(
        [(1, 0.1, "a", 10**18), (2, 0.2, None, 10**18), (None, None, "c", -5)],
        "i int, d double, s string, b bigint",
    )
    got = rows(profile(df))
    assert got["i"] == (3, 2, Decimal("3.000000"), 1.5)
    assert got["d"] == (3, 2, Decimal("0.300000"), 0.15)
    assert got["s"] == (3, 2, None, None)
    assert got["b"][2] == Decimal(2 * 10**18 - 5)


def test_values_no_decimal_can_hold_are_left_out_and_counted(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (double('NaN')), (double('inf')), (1.5D), (-2.25D), (3e13D), (1e300D) t(d)"
    )
    assert rows(profile(df))["d"][:3] == (6, 6, Decimal("29999999999999.250000"))
    assert profile(df).first().left_out == 3
    only = spark.sql("SELECT double('NaN') AS d")
    assert rows(profile(only))["d"] == (1, 1, None, None)
    some = spark.sql("SELECT * FROM VALUES (1D), (3D), (double('NaN')) t(d)")
    assert rows(profile(some))["d"] == (3, 3, Decimal("4.000000"), 2.0)


def test_totals_that_do_not_fit_are_null_and_differences_show(spark):
    def table(*values):
        return spark.createDataFrame([(v,) for v in values], "d double")

    full = table(1.0, 9e31, 9e31)
    assert rows(profile(full))["d"] == (3, 3, None, None)
    assert not profile_diff(full, table(1.0, 9e31, 8e31)).first().equal
    assert profile_diff(full, full.repartition(3)).first().equal
    nan = table(1.0, float("nan"))
    assert profile_diff(nan, nan).first().equal
    assert not profile_diff(nan, table(1.0, float("inf"))).first().equal


def test_decimals_count_at_their_own_scale(spark):
    fine = [spark.sql(f"SELECT CAST('1.000000000{i}' AS DECIMAL(20,10)) AS d") for i in (1, 2)]
    assert not profile_diff(*fine).first().equal
    large = spark.sql(f"SELECT CAST(v AS DECIMAL(38,0)) AS d FROM VALUES ('{'9' * 35}'), ('5') t(v)")
    assert rows(profile(large))["d"] == (2, 2, None, None)


def test_sums_of_extremes_do_not_overflow(spark):
    df = spark.sql("SELECT 9223372036854775807 AS b FROM range(100)")
    assert rows(profile(df))["b"][2] == Decimal(9223372036854775807 * 100)
    low = spark.sql("SELECT bigint('-9223372036854775808') AS b FROM range(100)")
    assert rows(profile(low))["b"][2] == Decimal(-9223372036854775808 * 100)


def test_decimals_and_small_integers(spark):
    df = spark.sql("SELECT tinyint(-3) t, smallint(4) s, 1.25BD d, float(0.5) f, true b")
    got = rows(profile(df))
    assert [got[c][2] for c in "tsdf"] == [Decimal(x) for x in ("-3", "4", "1.25", "0.5")]
    assert got["b"][2] is None


def test_empty_table(spark):
    got = rows(profile(spark.createDataFrame([], "i int, s string")))
    assert got == {"i": (0, 0, None, None), "s": (0, 0, None, None)}


def test_order_of_rows_does_not_matter(spark, orders):
    assert rows(profile(orders)) == rows(profile(orders.repartition(9)))


def test_comparison(spark, sample):
    same = profile_diff(sample, sample.repartition(2))
    assert all(r.equal for r in same.collect())
    other = {r.column_name: r.equal for r in profile_diff(sample, sample.filter("id > 1")).collect()}
    assert other == {"id": False, "name": False, "value": False}
    shifted = sample.selectExpr("id", "name", "value + 1 AS value")
    assert {r.column_name: r.equal for r in profile_diff(sample, shifted).collect()} == {
        "id": True, "name": True, "value": False,
    }
