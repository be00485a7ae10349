"""Per-column statistics of a table, and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column, limb_sums, limb_total

_SUM_TYPE = "decimal(38,6)"
_SCALE = 1_000_000
# Up to here a double scaled to millionths fits a bigint; larger ones are summed as decimals.
_LARGEST_SCALED = 9e12


def profile(df: DataFrame) -> DataFrame:
    """One row per column: row count, non-NULL count, total, average, left_out and checksum.

    Doubles are rounded to six decimals and then summed exactly, decimals are summed at their
    own scale, so totals do not depend on the order in which rows arrive. NaN, infinities
    and values beyond 32 digits are left out of total and average, and counted in
    `left_out`; a total that does not fit is NULL, and so is its average. Columns that are
    not numbers have none of these. `checksum` is the sum of the hashes of all values as they
    are, so two numeric columns with equal measures but other values differ in it. All columns come
    out of one scan.
    """
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, field in enumerate(df.schema.fields):
        value = column(field.name)
        metrics.append(F.count(value).alias(f"n{i}"))
        parts, total, summed = _exact_sum(field, f"s{i}", f"n{i}")
        metrics += parts
        checksum = F.lit(None).cast("decimal(38,0)")
        if isinstance(field.dataType, T.NumericType):
            hashed = F.when(value.isNotNull(), F.xxhash64(value))
            metrics += limb_sums(hashed, f"h{i}")
            checksum = limb_total(f"h{i}")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"n{i}").alias("non_null"),
                total.cast(_SUM_TYPE).alias("total"),
                (F.col(f"n{i}") - summed).alias("left_out"),
                checksum.alias("checksum"),
            )
        )
    summed = F.col("non_null") - F.col("left_out")
    average = F.when(summed > 0, F.col("total").cast("double") / summed)
    return (
        df.agg(*metrics)
        .select(F.inline(F.array(*entries)))
        .select(
            "column_name", "row_count", "non_null", "total", average.alias("average"),
            "left_out", "checksum",
        )
    )


def _exact_sum(
    field: T.StructField, prefix: str, count: str
) -> tuple[list[Column], Column, Column]:
    """Aggregates for the exact sum of a column, the sum, and how many values are in it."""
    value = column(field.name)
    everything = F.col(count)
    if isinstance(field.dataType, T.IntegralType):
        return limb_sums(value.cast("bigint"), prefix), limb_total(prefix), everything
    if isinstance(field.dataType, T.DecimalType):
        whole = f"decimal(38,{field.dataType.scale})"
        total = F.try_sum(value.try_cast(whole)).alias(prefix)
        return [total], F.col(prefix).try_cast(_SUM_TYPE), everything
    if isinstance(field.dataType, T.FractionalType):
        value = value.cast("double")
        small = F.abs(value) < _LARGEST_SCALED
        millionths = F.when(small, F.floor(value * _SCALE + 0.5))
        decimals = F.when(~small, value.try_cast(_SUM_TYPE))
        parts = [
            *limb_sums(millionths, prefix),
            F.count(millionths).alias(f"{prefix}_few"),
            F.try_sum(decimals).alias(f"{prefix}_large"),
            F.count(decimals).alias(f"{prefix}_many"),
        ]
        unit = F.lit("0.000001").cast("decimal(7,6)")
        few, many = F.col(f"{prefix}_few"), F.col(f"{prefix}_many")
        nothing = F.lit(0).cast(_SUM_TYPE)
        # A sum of large values that overflowed is NULL, and makes the total NULL.
        total = F.try_add(
            F.when(few > 0, (limb_total(prefix) * unit).cast(_SUM_TYPE)).otherwise(nothing),
            F.when(many > 0, F.col(f"{prefix}_large")).otherwise(nothing),
        )
        return parts, F.when(few + many > 0, total), few + many
    return [], F.lit(None), everything


def profile_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both tables' profiles side by side, one row per column, and whether they agree."""
    measures = ("row_count", "non_null", "total", "average", "left_out", "checksum")
    left = profile(source).select(
        "column_name", *[F.col(m).alias(f"source_{m}") for m in measures]
    )
    right = profile(target).select(
        "column_name", *[F.col(m).alias(f"target_{m}") for m in measures]
    )
    agree = F.lit(True)
    for m in measures:
        agree = agree & F.col(f"source_{m}").eqNullSafe(F.col(f"target_{m}"))
    return left.join(right, "column_name", "full_outer").withColumn("equal", agree)
