"""Reading and writing file datasets."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column
from tablevault.sources import filesystem

logger = logging.getLogger(__name__)

# Stands for NULL in CSV files, so that NULL and the empty string stay apart.
CSV_NULL = "\\N"

# Quote everything, double inner quotes, keep blanks and line breaks, keep microseconds. The
# character that escapes an escape is NUL unless named, which would take NULs out of texts.
_CSV_COMMON = {
    "escape": '"',
    "charToEscapeQuoteEscaping": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# How to read CSV files: as this library writes them; as Spark and other programs do that put a
# backslash before quotes; or as spreadsheets, databases and pandas do, which double them. The
# last two mean NULL by an empty field, quoted or not.
CSV_DIALECTS = {
    "own": {**_CSV_COMMON, "nullValue": CSV_NULL},
    "foreign": {"escape": "\\", "nullValue": ""},
    "rfc4180": {"escape": '"', "charToEscapeQuoteEscaping": '"', "nullValue": ""},
}
DETECT = "detect"

# Signs of a dialect in a line. Where a quote stands beside a delimiter or ends a line it may
# begin or end a value, and a backslash may be part of the text, so those say nothing.
_DOUBLED = r'[^,\\]""[^,]'
_BACKSLASHED = r'\\"(?!["\s,]|$)'


def csv_dialect(spark: SparkSession, path: str) -> str:
    """'rfc4180' or 'foreign', by how quotes inside values are written in the files.

    Reads all lines once, as text. Files without such quotes are 'foreign'; files with both
    kinds are refused, since neither way of reading them can be right for all.
    """
    line = F.col("value")
    signs = spark.read.text(path).agg(
        F.coalesce(F.bool_or(line.rlike(_DOUBLED)), F.lit(False)).alias("doubled"),
        F.coalesce(F.bool_or(line.rlike(_BACKSLASHED)), F.lit(False)).alias("backslashed"),
    ).first()
    if signs["doubled"] and signs["backslashed"]:
        raise ValueError(f"{path} has doubled quotes and backslashes before quotes; name its dialect")
    return "rfc4180" if signs["doubled"] else "foreign"


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    *,
    csv_null: str | None = None,
    multi_line: bool | None = None,
    dialect: str = "own",
    by_name: bool = False,
    rescue: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a dataset of any registered format; a missing path or format raises.

    Without `schema`, CSV and JSON types are inferred, which costs an extra pass over the
    files and can change types, so pass one where it is known.

    CSV: `dialect` is one of `CSV_DIALECTS`, or 'detect' for `csv_dialect`. Values may hold
    line breaks, which makes each file one task; a schema without text columns has no such
    values, so its files are split, and `multi_line=False` says so of others. `by_name`
    maps a schema's columns by the header instead of by position: the header is read once,
    columns the schema lacks are left out, and columns the header lacks are an error.
    `rescue` adds a text column that holds the whole record where it has too many or too few
    fields or a value that is not of its type, and NULL where all is well.
    `csv_null=""` reads empty CSV fields as NULL in the dialect 'own', too.
    """
    reader = spark.read.format(fmt).option("header", "true")
    if fmt.lower() != "csv":
        reader = reader.options(**options)
        if schema is None:
            return reader.option("inferSchema", "true").load(path)
        return reader.schema(schema).load(path)

    if dialect == DETECT:
        dialect = csv_dialect(spark, path)
    if dialect not in CSV_DIALECTS:
        raise ValueError(f"unknown CSV dialect: {dialect}")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if multi_line is None:
        multi_line = fields is None or any(
            isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in fields
        )
    reader = reader.options(
        **CSV_DIALECTS[dialect], multiLine=str(multi_line).lower(), enforceSchema="false"
    )
    if csv_null is not None:
        reader = reader.option("nullValue", csv_null)
    reader = reader.options(**options)
    if fields is None:
        frame = reader.option("inferSchema", "true").load(path)
        if rescue is None:
            return frame
        fields = frame.schema
    wanted = [column(f.name) for f in fields]
    if by_name:
        fields = _by_header(reader.option("inferSchema", "false").load(path).columns, fields)
    if rescue is not None:
        # Without pruning, records are judged by all their fields, whichever are used later.
        reader = reader.options(columnNameOfCorruptRecord=rescue, columnPruning="false")
        fields = T.StructType([*fields, T.StructField(rescue, T.StringType())])
        # The same as the column alone, which Spark does not read without any other.
        nothing = column(rescue).isNull() & wanted[0].isNull()
        wanted.append(F.when(~nothing, column(rescue)).alias(rescue))
    return reader.schema(fields).load(path).select(*wanted)


def _by_header(header: list[str], fields: T.StructType) -> T.StructType:
    """The schema in the order of a header; names differ in more than case."""
    known = {f.name.lower(): f for f in fields}
    missing = [f.name for f in fields if f.name.lower() not in {h.lower() for h in header}]
    if missing:
        raise ValueError(f"the CSV header lacks {', '.join(missing)}: it has {', '.join(header)}")
    return T.StructType(
        [known.get(h.lower(), T.StructField(h, T.StringType())) for h in header]
    )


def read_or_none(
    spark: SparkSession, path: str, fmt: str = "parquet", **kwargs
) -> DataFrame | None:
    """`read_files`, with None instead of an error when the dataset cannot be opened."""
    try:
        return read_files(spark, path, fmt, **kwargs)
    except Exception as error:
        logger.error("Cannot read %s as %s: %s", path, fmt, error)
        return None


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    csv_null: str = CSV_NULL,
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """Write `df`, replacing what is at `path`; errors propagate.

    Replacing files that `df` itself reads would lose them, so that is refused before
    anything is touched.
    """
    spark = df.sparkSession
    if filesystem.exists(spark, path) and filesystem.reads_under(df, path):
        raise ValueError(f"refusing to overwrite {path}: the data being written is read from it")
    writer_options = {"header": "true"}
    if fmt.lower() in ("csv", "json"):
        writer_options |= _MICROSECONDS
    if fmt.lower() == "csv":
        writer_options |= {
            **_CSV_COMMON, "quoteAll": "true", "nullValue": csv_null, "lineSep": "\n",
        }
        df = df.select(*[_without_marker(f, csv_null) for f in df.schema.fields])
    writer = df.write.format(fmt).options(**(writer_options | options)).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _without_marker(field: T.StructField, marker: str) -> Column:
    """Fail on a text that equals the NULL marker, which would otherwise come back as NULL."""
    value = column(field.name)
    if not isinstance(field.dataType, T.StringType) or marker == "":
        return value
    message = f"column {field.name} holds the text that stands for NULL; pass another csv_null"
    return F.when(value == marker, F.raise_error(F.lit(message))).otherwise(value).alias(field.name)


def object_store_path(container: str, account: str, path: str) -> str:
    """The address of `path` in a storage account's container."""
    return f"abfss://{container}@{account}.dfs.core.windows.net/{path}"
