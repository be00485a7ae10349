"""Row-level operators: filter, count, sample, and numbering of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column, comparable, quoted, row_hash
from tablevault.sources.scratch import scratch_path


def positive_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is above zero; NULL, zero and negative ids drop.

    Text ids are read as bigint, and those that are no whole number drop instead of
    failing the job. Other ids are compared as they are, so the filter reaches the scan.
    """
    ids = df[quoted(id_col)]
    if isinstance(df.select(ids).schema[0].dataType, T.StringType):
        ids = ids.try_cast("bigint")
    return df.filter(ids > 0)


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row: the table's name and its number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count"
    )


def whole_row_order(schema: T.StructType) -> list[Column]:
    """An order that depends on nothing but row content, maps included."""
    return [comparable(column(f.name), f.dataType).asc_nulls_first() for f in schema.fields]


# Each sampling task hands its `n` first rows to the one that merges them. A table with more
# input splits than this is read by fewer, longer tasks, so the merge stays small.
SAMPLE_TASKS = 8192


def sample_rows(df: DataFrame, n: int, order_by: list[Column] | None = None) -> DataFrame:
    """The first `n` rows in content order: equal tables give equal samples.

    Ties are whole-row duplicates, so it does not matter which of them is taken. No row is
    sorted that does not make it into some task's first `n`.
    """
    order = order_by or whole_row_order(df.schema)
    return df.coalesce(SAMPLE_TASKS).orderBy(*order).limit(n)


def spread_sample(df: DataFrame, n: int) -> DataFrame:
    """`n` rows spread evenly over the table, the same for equal tables.

    Taken are the rows of the least row hashes. First the hashes alone are merged, at most
    `n` of 8 bytes from each task; the rows at or below the last of them are then fetched by
    a filter. Copies of a row share a hash, so each task hands on `n` of them at most.
    """
    hashed = df.select(row_hash(df.schema).alias("hash"))
    last = hashed.orderBy("hash").limit(n).agg(F.max("hash"))
    order = [row_hash(df.schema), *whole_row_order(df.schema)]
    return df.where(row_hash(df.schema) <= last.scalar()).orderBy(*order).limit(n)


# `monotonically_increasing_id` is a partition number and, below it, a row number of 33 bits.
_ROW_BITS = 33


def numbered(
    df: DataFrame, rank: str, level: str, ordinal: str, *, ties: list[str] | None = None
) -> DataFrame:
    """Number rows from 1 by `level` descending, then `ordinal`, then `ties`.

    A plain `row_number()` over the whole order would send every row to one task. Here Spark
    deals rows out by ranges of the order, by splitters it samples, so hot levels, distinct
    levels and sparse ordinals all make ranges of like size. The rows are written in order,
    and each range starts behind the rows of those before it: the only thing that is summed
    in one task is a count per range. Rows that are alike in the whole order share a range.
    NULL levels are an error.
    """
    top, at, part, before = "__level", "__at", "__range", "__before"
    level_type = df.select(column(level)).schema[0].dataType
    missing = F.raise_error(F.lit(f"{level} must not be NULL")).cast(level_type)
    order = [F.col(top).desc(), column(ordinal).asc(), *[column(t).asc() for t in ties or []]]
    leveled = df.withColumn(top, F.coalesce(column(level), missing))
    placed = leveled.repartitionByRange(*order).sortWithinPartitions(*order).drop(top)
    placed = placed.withColumn(at, F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "numbered")
    placed.write.parquet(path)
    # Ranges are dealt out by samples, so the rows that were counted must be the rows numbered.
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    placed = placed.withColumn(part, F.shiftright(at, _ROW_BITS))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select(part, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(before))
    inside = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(starts, part)
        .withColumn(rank, F.col(before) + inside + 1)
        .select(*[column(c) for c in df.columns if c != rank], column(rank))
    )
