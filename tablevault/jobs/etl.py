"""The filter-and-write job."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column, quoted
from tablevault.operators.rows import positive_ids
from tablevault.sources.files import DETECT, csv_dialect, read_or_none, write_files

logger = logging.getLogger(__name__)


_CORRUPT = "__corrupt_record"


@dataclass(frozen=True)
class EtlResult:
    rows_read: int
    rows_written: int
    # Rows with too many or too few fields, or of which a value, or a text id, could not be
    # read as its type.
    rows_malformed: int = 0
    # How the CSV files were read.
    dialect: str | None = None


def run_etl(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    id_col: str = "id",
    dialect: str = DETECT,
    rejects: str | None = None,
    **read_options,
) -> EtlResult | None:
    """Read a dataset, keep rows with a positive id, write them, and say how many.

    All counts are taken by the write job, so with a `schema` and a `dialect` the source is
    scanned once. By default the files tell the dialect, which is one more scan of the text
    (see `csv_dialect`); pass "foreign" or "rfc4180" for files of other writers, "own" for
    those of this library. `by_name=True` maps the schema by the header.
    Malformed rows are counted, not hidden: records that have too many or too few fields, or
    a value that is not of its column's type (read as NULL), and rows whose text id is no
    whole number. With `rejects`, rows that are malformed as records do not go to `target`;
    their whole text goes to that path instead, as Parquet (`record`, `file`).
    A source that cannot be opened ends the job without output and without an error; any
    other failure is logged and raised.
    """
    csv = fmt.lower() == "csv"
    if csv:
        try:
            dialect = csv_dialect(spark, source) if dialect == DETECT else dialect
        except AnalysisException as error:
            logger.error("Cannot read %s: %s", source, error)
            return None
        read_options |= {"dialect": dialect, "rescue": _CORRUPT}
    elif rejects is not None:
        raise ValueError("only records of CSV files can be rejected")
    rows = read_or_none(spark, source, fmt, schema=schema, **read_options)
    if rows is None:
        return None
    try:
        read, written = Observation(), Observation()
        one = F.count(F.lit(1)).alias("rows")
        malformed = F.count(F.when(_malformed(rows, id_col), 1)).alias("malformed")
        observed = rows.observe(read, one, malformed)
        if rejects is not None:
            observed = observed.where(column(_CORRUPT).isNull())
        kept = positive_ids(observed.drop(_CORRUPT), id_col).observe(written, one)
        write_files(kept, target, fmt)
        if rejects is not None:
            # Never more than a scan, and the rows of it that were refused.
            write_files(_records(rows), rejects)
        result = EtlResult(
            read.get["rows"], written.get["rows"], read.get["malformed"], dialect if csv else None
        )
    except Exception as error:
        logger.error("Filtering %s into %s failed: %s", source, target, error)
        raise
    logger.info("Read %d rows and wrote %d to %s", result.rows_read, result.rows_written, target)
    return result


def _records(rows: DataFrame) -> DataFrame:
    bad = rows.withColumn("__file", rows["_metadata.file_path"])
    bad = bad.where(column(_CORRUPT).isNotNull())
    return bad.select(column(_CORRUPT).alias("record"), F.col("__file").alias("file"))


def _malformed(rows: DataFrame, id_col: str) -> Column:
    bad = column(_CORRUPT).isNotNull() if _CORRUPT in rows.columns else F.lit(False)
    ids = rows[quoted(id_col)]
    if isinstance(rows.select(ids).schema[0].dataType, T.StringType):
        bad = bad | (ids.isNotNull() & ids.try_cast("bigint").isNull())
    return bad
