"""Exact and fast comparison of two tables as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import (
    collated,
    column,
    columns,
    comparable,
    free_name,
    holds,
    limb_sums,
    limb_total,
    row_hash,
)
from tablevault.operators.rows import sample_rows, spread_sample, whole_row_order

# Bounds the broadcast list of suspect slices: at most this many bigints.
MAX_BUCKETS = 1 << 20

SIDE, COPIES = "_side", "_copies"


def mark_names(names: list[str]) -> tuple[str, str]:
    """What `diff_rows` calls its two marks: `_side` and `_copies`, unless a table has such columns."""
    return free_name(SIDE, names), free_name(COPIES, names)


def _count_names(names: list[str]) -> tuple[str, str]:
    return free_name("__in_source", names), free_name("__in_target", names)


def same_schema(source: DataFrame, target: DataFrame) -> bool:
    """Equal names, types and order. Nullability is left out: file reads do not keep it."""
    return _shape(source.schema) == _shape(target.schema)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _require_same_schema(source: DataFrame, target: DataFrame) -> None:
    if not same_schema(source, target):
        raise ValueError(
            "tables differ in schema: "
            f"{source.schema.simpleString()} and {target.schema.simpleString()}"
        )


def signed_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies in each table.

    One shuffle serves both directions. Copies of a row are added up before the shuffle, so
    a row that makes up much of a table costs one record per task.
    """
    _require_same_schema(source, target)
    names = source.columns
    weight, (in_source, in_target) = free_name("__weight", names), _count_names(names)
    tagged = _groupable(source).withColumn(weight, F.lit(1)).union(
        _groupable(target).withColumn(weight, F.lit(-1))
    )
    return tagged.groupBy(*columns(source)).agg(
        F.count(F.when(F.col(weight) > 0, 1)).alias(in_source),
        F.count(F.when(F.col(weight) < 0, 1)).alias(in_target),
    )


def _groupable(df: DataFrame) -> DataFrame:
    """Columns as they are grouped: variants as JSON text, text with a collation as plain text."""
    return df.select(
        *[
            comparable(column(f.name), f.dataType).alias(f.name)
            if holds(f.dataType, T.VariantType) or collated(f.dataType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def diff_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that the tables do not share, with multiset semantics.

    `_side` is 'missing' for rows the target lacks and 'extra' for rows only it has;
    `_copies` says how many; `mark_names` tells their names for tables with such columns.
    The tables are equal exactly when the result is empty. Texts are compared byte by byte,
    whatever their collation. Variants show as JSON text.
    """
    (side, copies), (in_source, in_target) = mark_names(source.columns), _count_names(source.columns)
    net = F.col(in_source) - F.col(in_target)
    return (
        signed_counts(source, target)
        .filter(F.col(in_source) != F.col(in_target))
        .select(
            F.when(net > 0, "missing").otherwise("extra").alias(side),
            F.abs(net).alias(copies),
            *columns(source),
        )
    )


def diff_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows on each side, rows missing from the target, and extra rows in it."""
    in_source, in_target = _count_names(source.columns)
    net = F.col(in_source) - F.col(in_target)
    return signed_counts(source, target).agg(
        _total(F.col(in_source)).alias("source_rows"),
        _total(F.col(in_target)).alias("target_rows"),
        _total(F.greatest(net, F.lit(0))).alias("missing_rows"),
        _total(F.greatest(-net, F.lit(0))).alias("extra_rows"),
    )


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


# How a sample is drawn: the first rows in content order, or rows spread over the table.
FIRST, SPREAD = "first", "spread"


def sample_diff(source: DataFrame, target: DataFrame, n: int, method: str = FIRST) -> DataFrame:
    """`diff_rows` of the two samples, compared on the cluster.

    'first' takes the first rows in content order, 'spread' those of the least row hashes,
    so a difference anywhere in the tables has the same chance to be seen.
    """
    _require_same_schema(source, target)
    if method == SPREAD:
        return diff_rows(spread_sample(source, n), spread_sample(target, n))
    if method != FIRST:
        raise ValueError(f"unknown sample method: {method}")
    order = whole_row_order(source.schema)
    return diff_rows(sample_rows(source, n, order), sample_rows(target, n, order))


def fingerprint_metrics(schema: T.StructType) -> list[Column]:
    """Aggregates that `fingerprint` needs; a copy job can observe them as it writes."""
    return [F.count(F.lit(1)).alias("row_count"), *limb_sums(row_hash(schema), "checksum")]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: the row count and the sum of all row hashes, whatever the row order.

    Needs one scan and no shuffle of rows. Unequal fingerprints prove the tables unequal;
    equal ones leave a chance of about 2^-64 that accidental damage went unseen.
    """
    return df.agg(*fingerprint_metrics(df.schema)).select("row_count", _checksum())


def _checksum() -> Column:
    return F.coalesce(limb_total("checksum"), F.lit(0)).cast("decimal(38,0)").alias("checksum")


def bucket_fingerprints(df: DataFrame, buckets: int) -> DataFrame:
    """Row count and hash sum for each of `buckets` slices of the rows, by row hash."""
    hashed = df.select(row_hash(df.schema).alias("__hash"))
    return (
        hashed.groupBy(F.pmod("__hash", F.lit(buckets)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("row_count"), *limb_sums(F.col("__hash"), "checksum"))
        .select("bucket", "row_count", _checksum())
    )


def diff_rows_in_suspect_buckets(
    source: DataFrame, target: DataFrame, buckets: int = 4096
) -> DataFrame:
    """`diff_rows` that shuffles only the slices whose fingerprints disagree.

    For large tables with little damage: two scans per side, and a shuffle of about one
    `buckets`-th of the data for each damaged row. The suspect list has at most `buckets`
    rows. Differences that leave a slice's fingerprint equal are not seen, so use
    `diff_rows` where proof is needed.
    """
    _require_same_schema(source, target)
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    sides = [
        bucket_fingerprints(df, buckets).withColumn("side", F.lit(side))
        for side, df in enumerate((source, target))
    ]
    # A slice is clean when both sides report it and report it alike.
    suspects = (
        sides[0]
        .union(sides[1])
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("sides"),
            F.countDistinct("row_count", "checksum").alias("states"),
        )
        .filter((F.col("sides") < 2) | (F.col("states") > 1))
        .select(F.col("bucket").alias("__suspect"))
    )

    def suspect_rows(df: DataFrame) -> DataFrame:
        bucket = F.pmod(row_hash(df.schema), F.lit(buckets))
        return df.join(F.broadcast(suspects), bucket == F.col("__suspect"), "left_semi")

    return diff_rows(suspect_rows(source), suspect_rows(target))

